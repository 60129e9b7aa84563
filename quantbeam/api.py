"""Read-side functions over the exported snapshots (the reference's API
handlers, minus the HTTP server): each returns a DataFrame whose filters
are pushed into the Parquet scan. A snapshot that does not exist yet reads as
an empty frame with its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quantbeam.operators import filters as flt
from quantbeam.schemas import MARKET_SUMMARY, TECHNICAL_INDICATORS_SUMMARY
from quantbeam.sources import sinks


def get_market_summary(spark: SparkSession, snapshot: str, symbol: str | None = None) -> DataFrame:
    """All rows, or those whose symbol or name contains ``symbol``
    (case-insensitive, literal)."""
    return flt.search_symbol_ci(sinks.read_snapshot(spark, snapshot, MARKET_SUMMARY), symbol)


def filter_market_summary(spark: SparkSession, snapshot: str, min_ltp=None, max_ltp=None,
                          min_percent_change=None, max_percent_change=None) -> DataFrame:
    return flt.filter_price_range(sinks.read_snapshot(spark, snapshot, MARKET_SUMMARY), min_ltp, max_ltp,
                                  min_percent_change, max_percent_change)


def filter_market_by_technicals(spark: SparkSession, snapshot: str, sma_position=None, crossover_status=None,
                                min_rsi=None, max_rsi=None, min_volatility=None,
                                max_volatility=None) -> DataFrame:
    return flt.filter_technical(sinks.read_snapshot(spark, snapshot, MARKET_SUMMARY), sma_position, crossover_status,
                                min_rsi, max_rsi, min_volatility, max_volatility)


def get_market_summary_for_symbol(spark: SparkSession, snapshot: str, symbol: str) -> DataFrame:
    return flt.lookup_symbol_exact(sinks.read_snapshot(spark, snapshot, MARKET_SUMMARY), symbol)


def get_technical_indicators_summary(spark: SparkSession, wide_table: str, token: str | None = None,
                                     symbol: str | None = None) -> DataFrame:
    return flt.search_indicator_summary(sinks.read_snapshot(spark, wide_table, TECHNICAL_INDICATORS_SUMMARY), token, symbol)


def market_summary_records(df: DataFrame) -> DataFrame:
    """Rows as JSON records (the response body form)."""
    return flt.rows_as_json(df)
