"""Licence scan: exact set-similarity join of text blocks with templates.

A block is a stretch of as many consecutive words as the template has, wherever
lines end. It meets the template if it holds at least ``threshold`` of the
template's distinct words (containment). The join is exact and does not compare
all pairs. Texts are split once; the template words that each holds are kept
with their places, in spans that overlap so that every block lies in one whole,
and all else reads these:

- words are put in one global order, rarest first, by their counts over the
  spans (ties by the word);
- *prefix filter*: a block that shares ``need = ceil(threshold * n)`` of a
  template's ``n`` words shares one of its ``n - need + 1`` rarest;
- *length filter*: a span has ``need`` distinct template words at least;
- *positional filter*: if the rarest word that both have is the template's
  ``p``-th and the ``q``-th of the span's ``m`` template words, they share at
  most ``min(n - p, m - q)`` words, which must be ``need`` at least;
- what is left is verified block by block of the span, by intersecting words.

Templates are a parameter: as many rows as the caller lists, so they are
literals of the plan. ``phrases`` are found word for word, beside the join.

Null and empty texts have no words and no labels. Very long texts have more
spans, each a row of its own with a few words. Repeated rows are scanned each;
rows are told apart by id and text, and equal rows have equal results. Of blocks
that meet a template equally well any gives the same label and score. Columns
other than the id and the text are not read, so their names cannot clash. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantbeam.llm.base import LOWER, NOT_WORD, UPPER, pick, words
from quantbeam.llm.decontamination import document_key
from quantbeam.session import materialize

# Phrases of the base scan and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

FOLD = str.maketrans(UPPER, LOWER)
WORD = re.compile("[^" + NOT_WORD[1:-2] + "]+")

#: Default templates, (label, text).
TEMPLATES = (
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("mpl", "subject to the terms of the mozilla public license version 2.0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
)


def phrase_places(w: Column, phrases: Sequence[str]) -> Column:
    """Places (from 0) where any phrase's words stand consecutively, one for
    each phrase and place."""
    def starts(phrase: str) -> Column:
        parts = phrase.split()
        every = F.sequence(F.lit(0), F.size(w) - len(parts))
        same = lambda i: F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = (lambda f, k, part: lambda i: f(i) & (F.get(w, i + k) == part))(same, k, part)
        return F.when(F.size(w) >= len(parts), F.filter(every, same)).otherwise(F.array().cast("array<int>"))
    return F.concat(*[starts(p) for p in phrases])


def scan_phrases(rows: DataFrame, phrases: Mapping[str, str]) -> DataFrame:
    """Add ``n_base``, ``first_word``, ``last_word`` and ``base``, the sorted
    labels. Places are listed only for texts that hold a phrase."""
    spaced = F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" "))
    rows = rows.withColumn("_t", spaced)
    holds = {p: F.col("_t").contains(f" {p} ") for p in phrases}
    any_phrase = F.lit(False)
    for h in holds.values():
        any_phrase = any_phrase | h
    none = F.array().cast("array<int>")
    rows = rows.withColumn("_places", F.when(any_phrase, phrase_places(F.col("w"), list(phrases))).otherwise(none))
    labels = F.array_compact(F.array(*[F.when(h, F.lit(phrases[p])) for p, h in holds.items()]))
    return (rows.withColumn("n_base", F.size("_places").cast("long"))
            .withColumn("first_word", F.array_min("_places").cast("long"))
            .withColumn("last_word", F.array_max("_places").cast("long"))
            .withColumn("base", F.sort_array(F.array_distinct(labels))).drop("_t", "_places"))


def template_words(text: str) -> list[str]:
    """The words of a template in order."""
    return WORD.findall(text.translate(FOLD))


def need_of(n: int, threshold: float) -> int:
    """How many of ``n`` distinct words a block must hold."""
    return max(1, math.ceil(n * threshold - 1e-9))


def spans(w: Column, vocabulary: Sequence[str], longest: int, need: int) -> Column:
    """Array of ``(at, word)`` arrays: the words among ``vocabulary`` in spans
    of ``2 * longest`` words, one beginning every ``longest`` words, of those
    spans that hold ``need`` distinct ones."""
    def listed(first: Column) -> Column:
        last = F.least(first + (2 * longest - 1), F.size(w) - 1)
        places = F.filter(F.sequence(first, last), lambda k: F.get(w, k).isin(list(vocabulary)))
        return F.transform(places, lambda k: F.struct(k.alias("at"), F.get(w, k).alias("word")))

    firsts = F.sequence(F.lit(0), F.size(w) - 1, F.lit(longest))
    every = F.when(F.size(w) > 0, F.transform(firsts, listed))
    return F.filter(every, lambda s: F.size(F.array_distinct(s["word"])) >= need)


def word_order(held: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """The template words, rarest in the spans first, ties by word."""
    counts = held.select(F.explode("span.word").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    n = {r["word"]: r["n"] for r in counts.collect()}  # template words alone
    return sorted(vocabulary, key=lambda v: (n.get(v, 0), v))


def similarity_join(held: DataFrame, templates: Sequence[tuple[str, str]], threshold: float) -> DataFrame:
    """``(doc, template, label, containment)`` of all spans (``doc, span``) and
    templates with a block of a containment of ``threshold`` at least; the
    containment is the best block's."""
    spark = held.sparkSession
    lengths = [len(template_words(text)) for _, text in templates]
    sets = [set(template_words(text)) for _, text in templates]
    order = word_order(held, sorted(set().union(*sets)))
    rank = {v: k for k, v in enumerate(order)}
    prefix, seeds = [], set()
    for k, ((label, _), of) in enumerate(zip(templates, sets)):
        ordered = sorted(of, key=rank.__getitem__)
        need = need_of(len(ordered), threshold)
        for p, word in enumerate(ordered[:len(ordered) - need + 1]):
            prefix.append((k, label, len(ordered), need, p, word, ordered, lengths[k]))
            seeds.add(word)
    listed = spark.createDataFrame(
        prefix, "template int, label string, n int, need int, p int, word string, ordered array<string>, length int")

    text_array = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    # ``known``: the span's template words in the global order.
    hit = (held.filter(F.arrays_overlap("span.word", text_array(sorted(seeds))))
           .select("doc", "span", F.array_intersect(text_array(order), F.col("span.word")).alias("known")))
    pairs = (hit.select("doc", "span", "known", F.posexplode("known").alias("q", "word"))
             .join(F.broadcast(listed), "word")
             .filter(F.size("known") >= F.col("need"))
             .filter(F.least(F.col("n") - F.col("p"), F.size("known") - F.col("q")) >= F.col("need"))
             .filter(F.size(F.array_intersect("known", "ordered")) >= F.col("need")))
    # A best block may begin with a template word: the words of the span that
    # stand before it by ``length``.
    mine = F.filter("span", lambda x: F.array_contains("ordered", x["word"]))
    in_block = lambda b: F.size(F.array_distinct(F.transform(
        F.filter("mine", lambda x: (x["at"] >= b["at"]) & (x["at"] < b["at"] + F.col("length"))), lambda x: x["word"])))
    return (pairs.withColumn("mine", mine).withColumn("overlap", F.array_max(F.transform("mine", in_block)))
            .filter(F.col("overlap") >= F.col("need"))
            .groupBy("doc", "template", "label").agg(F.max(F.col("overlap") / F.col("n")).alias("containment")))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.8,
         phrases: Mapping[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score)`` per document; ``score`` is 1 with a phrase, else the best
    containment of a met template, else 0."""
    base = pick(docs, id_col, text_col)
    texts = [template_words(text) for _, text in templates]
    vocabulary, longest = sorted({w for t in texts for w in t}), max(map(len, texts))
    least = min(need_of(len(set(t)), threshold) for t in texts)
    read = scan_phrases(base.select(document_key(F.col("doc_id"), F.col("text")).alias("doc"),
                                    words(F.col("text")).alias("w")), phrases)
    # The one pass over the texts: what is found of each, and its spans.
    facts = materialize(read.select("doc", F.size("w").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
                                    "base", spans(F.col("w"), vocabulary, longest, least).alias("spans")), "license-spans")
    held = facts.select("doc", F.explode("spans").alias("span"))
    met = similarity_join(held, templates, threshold)
    found = met.groupBy("doc").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    out = facts.drop("spans").join(found, "doc", "left")
    every = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    return out.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
