"""Operators for training-data pipelines over tables of documents.

Thirteen operators, one module each. Every operator takes DataFrames, names the
columns it reads (other columns, whatever they are called, are ignored) and
returns a DataFrame. ``queries`` registers the checked queries.
"""
