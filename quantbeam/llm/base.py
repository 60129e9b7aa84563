"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII characters that are not part of a word (everything
# outside ASCII, digits and lower-case letters are).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it by a
    path of its own (``sys.path``) rather than by an installation."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` alone, so that no other column can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is the empty text."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "utf-8")) % folds


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone. ``lower`` does the same for texts without other
    characters (as many bytes as characters) and is several times faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The lower-cased words of a text in order; null has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)
    # Only the first and the last part can be empty.
    return F.array_remove(parts, "")


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``key``. Rows are thinned by
    the hash first, so that tasks do not hand ``most`` rows each on."""
    n, mixed = rows.count(), F.xxhash64(key)
    if n > most:
        rows = rows.filter(F.pmod(mixed, F.lit(1 << 30)) < int((1 << 30) * 0.95 * most / n))
    return rows.orderBy(mixed, key).limit(most)
