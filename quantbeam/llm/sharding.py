"""Weighted rendezvous hashing of stable record keys.

Each (key, shard) pair has a hash u in (0, 1); a record goes to the shard
with the greatest ``weight / -ln(u)``. The score of a shard depends on the key
and that shard alone, so adding a shard moves records into it and nowhere else,
and shards receive records in proportion to their weights.

Native: the scores are column expressions. ``number`` deals out gapless slots
in the order of key, crc and size, without bringing a shard to one task.

Records with equal keys share a shard, whatever their texts; a null key is the
empty text. Of shards with equal scores the greater wins. Equal rows are alike,
so any of them may have any of their slots. A null text has no bytes and the crc
of the empty text; of a very long text only the size and the crc go on. An empty
table gives an empty result. Columns other than the id and the text are not
read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantbeam.llm.base import pick
from quantbeam.session import materialize

#: Bits of the md5 that make u: 52 fit a double exactly.
HEX_DIGITS = 13
#: Rows of one numbering task, about.
ROWS_PER_BLOCK = 200_000


def hash_number(text: Column) -> Column:
    """The first 52 bits of the md5 of ``text``."""
    return F.conv(F.substring(F.md5(F.encode(text, "utf-8")), 1, HEX_DIGITS), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among ``len(weights)`` shards; ties of the score
    (equal hashes) go to the greater shard number."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive, and there must be one at least")
    text = F.coalesce(key.cast("string"), F.lit(""))

    def score(shard: int, weight: float) -> Column:
        u = (hash_number(F.concat(text, F.lit(f":{shard}"))) + F.lit(0.5)) / F.lit(float(16 ** HEX_DIGITS))
        return F.struct((F.lit(float(weight)) / -F.log(u)).alias("score"), F.lit(shard).alias("shard"))

    return F.array_max(F.array(*[score(k, w) for k, w in enumerate(weights)]))["shard"]


def number(rows: DataFrame, group: str, order: Sequence[str], n_rows: int,
           rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``slot``, gapless from 0 within ``group`` and ascending by
    ``order``: rows are dealt into blocks by ranges, numbered there, and blocks
    are offset by the counts of those before them (a table of one row per block
    and group). The row number ends the range key, so that many equal rows are
    dealt into several blocks."""
    blocks = max(1, -(-n_rows // rows_per_block))
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(blocks, group, *order, "_tie")
    dealt = materialize(ranged.withColumn("_block", F.spark_partition_id()), "blocks")
    counts = dealt.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group).orderBy("_block")
    offsets = counts.select(group, "_block", (F.sum("_n").over(w) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy(group, "_block").orderBy(*order, "_tie")
    return (dealt.withColumn("_at", F.row_number().over(inside) - 1)
            .join(offsets, [group, "_block"])
            .withColumn("slot", F.col("_before") + F.col("_at")).drop("_block", "_tie", "_at", "_before"))


def shard(docs: DataFrame, shards: int | Sequence[float] = 24, grown_weight: float = 1.0,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``.

    ``shards`` is a count (equal weights) or the weights. ``size`` is the UTF-8
    bytes of the text plus 8; ``grown_shard`` is the shard with one more shard
    of ``grown_weight``.
    """
    weights = [1.0] * shards if isinstance(shards, int) else list(shards)
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    key = F.col("doc_id")
    facts = pick(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = materialize(facts.select(
        "*", F.lit("key").alias("law"), rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, grown_weight]).alias("grown_shard")), "dealt")
    numbered = number(dealt, "shard", ["doc_id", "text_crc32", "size"], dealt.count())
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
