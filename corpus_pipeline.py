"""A training corpus from raw documents: filter, deduplicate, decontaminate, pack.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and
works on all that its predecessor kept; all but the last return the columns of
``docs``. ``run`` writes each stage's result as Parquet and reads it again as
the next one's input. Rows are told apart by ``doc_id`` and text. Each stage
says what it does with nulls, empty texts, repeated rows and empty tables;
columns of ``docs`` beside ``doc_id``, ``text`` and ``lang`` may have any name and
go through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantbeam.llm import decontamination, language, near_duplicates, packing, quality_rules
from quantbeam.llm.queries import tokenizer
from quantbeam.session import materialize
from quantbeam.sources.tables import read_table

def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that ``docs`` has no column of, in any case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def _keep(docs: DataFrame, listed: DataFrame, text: Column, once: bool = False) -> DataFrame:
    """Rows of ``docs`` whose id and ``text`` (an expression that names the
    text) are among the two columns of ``listed``; with ``once``, one of equal
    rows. The columns of ``docs`` may have any name and type."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    keys = _free(docs, "keep_id", "keep_text")
    wanted = listed.select(*[named(F.col(c)).alias(k) for k, c in zip(keys, listed.columns)]).distinct()
    rows = docs.withColumns(dict(zip(keys, (named(F.col("doc_id")), named(text))))).join(wanted, keys, "left_semi")
    return (rows.dropDuplicates(keys) if once else rows).drop(*keys)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects. Null
    and empty texts have no words and go; equal rows stay or go together, very
    long texts are measured whole; nothing is learned without labels."""
    judged = quality_rules.judge(docs, read_table(spark, sf_dir, "labels"))
    return _keep(docs, judged.filter("kept").select("doc_id", "text_hash"), F.xxhash64("text"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in a language that the labelled ones have: their
    n-grams fit the likeliest one as texts of it do, rather than texts of others.
    Texts without letters go, gibberish and other languages too; equal rows stay
    or go together, and very long texts are read whole. Without any language
    labelled none can be told, and all go."""
    model = language.train(docs)
    found = materialize(language.predict(docs, model, evidence=True), "languages")
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                           F.col("lang").cast("string").alias("lang"))
    told = F.lit(False)
    for lang, least in sorted(language.least_fits(found, labelled, model).items()):
        told = told | ((F.col("lang_pred") == lang) & (F.col("fit") >= F.lit(least)))
    return _keep(docs, found.filter(told).select("doc_id", "text_hash"), F.xxhash64("text"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least
    id and, among equal rows of it, any. A null id is a value before all others;
    null texts are equal to one another, empty texts too."""
    found = near_duplicates.near_duplicates(docs)
    heads = found.filter(F.col("heads") & F.col("doc_id").eqNullSafe(F.col("class_id")))
    return _keep(docs, heads.select("doc_id", "text_key"), near_duplicates.text_key(F.col("text")), once=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark. Null, empty and
    wordless texts are clean; equal rows stay or go together; an empty benchmark
    contaminates nothing."""
    found = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    clean = found.filter(~decontamination.contaminated(F.col("n_hit"), F.col("n_words")))
    return _keep(docs, clean.select("doc.doc_id", "doc.text_hash"), F.xxhash64("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens. Null and empty texts
    are their end id alone; each row is packed, repeated ones too; long texts are
    cut into pieces."""
    return packing.pack(docs, tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality), ("language ID", languages), ("near duplicates", deduplicate),
          ("decontamination", decontaminate), ("packing", pack)]

#: The learned stages have no SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
