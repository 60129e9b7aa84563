"""Packing of documents into fixed-length sequences.

A document's ids are cut into whole sequences and one shorter rest. Whole
sequences need no packing and no shuffle. Rests are dealt into random groups
of about ``group_docs`` and each group is packed on its own by first-fit
decreasing: rests by falling length, each into the first bin with room, which
a tournament tree over the bins' room finds in logarithmic time.

Null and empty texts hold the end id alone, so every document has a piece.
Rows with equal ids and texts are packed one by one; of rests of equal length
any may come first. An empty table gives an empty result. Columns other than the id and the text are not read, so their names cannot
clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantbeam.llm import pieces
from quantbeam.llm.base import importable, pick
from quantbeam.session import TEXT_BATCH, materialize

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item. ``room[1]`` is the most room of any bin,
    ``room[k]`` the most below node ``k``; leaves are the bins in order."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        size, node = lengths[item], 1
        if not 0 <= size <= capacity:
            raise ValueError(f"an item of {size} in bins of {capacity}")
        while node < leaves:
            node = 2 * node if room[2 * node] >= size else 2 * node + 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= size
        node //= 2
        while node:
            room[node] = max(room[2 * node], room[2 * node + 1])
            node //= 2
    return bins, offsets


def cut(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int | None = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids: all but a document's last are whole."""
    importable(docs.sparkSession)

    def split(batches):
        encoder = pieces.shared(tokenizer)
        for batch in batches:
            for a, b in pieces.runs(batch.column(1)):
                ids, n = encoder.encode(batch.column(1).slice(a, b - a))
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(n), end_id)
                    n = n + 1
                k = -(-n // capacity)
                doc = np.repeat(np.arange(b - a), k)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)) * capacity
                length = np.minimum(capacity, n[doc] - start)
                raw = ids.astype("<u4").tobytes()
                at = 4 * ((np.cumsum(n) - n)[doc] + start)
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(a, b - a).take(pa.array(doc)), "start": pa.array(start), "length": pa.array(length),
                    "ids": pa.array([raw[i:i + 4 * m] for i, m in zip(at.tolist(), length.tolist())], pa.binary()),
                    "doc_tokens": pa.array(n[doc])})

    return pick(docs).mapInArrow(split, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int | None = 0,
         group_docs: int = 2048) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit), its
    sequence and its place there. Sequence ids are unique, odd for whole
    pieces and even for packed ones."""
    cuts = materialize(cut(docs, tokenizer, capacity, end_id), "pieces", compression="zstd", batch_bytes=TEXT_BATCH)
    whole = cuts.filter(F.col("length") == capacity).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = cuts.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group_docs))

    def first_fit(table: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        group = table.column("group_no")[0].as_py()
        sequence = (np.array(bins, np.int64) * groups + group) * 2
        return table.drop_columns(["group_no"]).append_column("sequence_id", pa.array(sequence)) \
            .append_column("offset", pa.array(np.array(offsets, np.int64)))

    # The row number keeps equal rows from meeting in one group.
    salt = F.xxhash64("doc_id", F.crc32("ids"), F.monotonically_increasing_id())
    packed = (rests.withColumn("group_no", F.pmod(salt, F.lit(groups)))
              .groupBy("group_no").applyInArrow(first_fit, PACKED))
    return whole.unionByName(packed)
