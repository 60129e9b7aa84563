"""Token-ID files: frequency-ranked ids, variable-length bytes, control bytes apart.

``write_token_files`` encodes documents, ranks ids by how often the corpus
uses them (rank 0 is the commonest) and stores ranks in 1 to 4 bytes each. The
byte counts, 2 bits an id, stand in a stream of their own (four ids to a
control byte), so that a reader finds all lengths by table lookup and never
branches on data bytes.

A file set is a folder with two Parquet tables, which any store and a lost
executor's retry can write safely:

- ``ranks``: ``(rank, id, n)``, one row per id that occurs,
- ``blocks``: ``(part, seq, first, n, doc_ids, counts, control, data)``.
  Documents ascend by id through the parts and the blocks of a part;
  ``first`` counts the ids of the part before the block.

Null and empty texts hold the end id alone. Very long texts are encoded whole;
their ids fill blocks of their own. Documents with the same id stand next to each
other, null ids first; ids that are equally frequent rank by their number. An
empty table gives empty files. Columns other than the id and the text are not read, so their names cannot
clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantbeam.llm import pieces
from quantbeam.llm.base import importable, pick
from quantbeam.session import materialize

#: Bytes of each of the four ids behind a control byte.
LENGTHS = (((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1).astype(np.int64)

TOKENS = "doc_id long, n_tokens long, ids binary"
BLOCKS = ("part int, seq int, first long, n long, doc_ids array<long>, counts array<long>, "
          "control binary, data binary")


def binaries(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The octets of numbers as a column of so many numbers a row, uncopied;
    below the 2 GB that such a column holds."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * numbers.itemsize
    if ends[-1] >= 1 << 31:
        raise ValueError("more than 2 GB of ids in a step")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)),
                                                            pa.py_buffer(np.ascontiguousarray(numbers))])


def tokenise(docs: DataFrame, tokenizer: str, end_id: int | None = 0) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: ids as little-endian unsigned integers of
    two bytes if the vocabulary allows it, else of four."""
    importable(docs.sparkSession)

    def encode(batches):
        encoder = pieces.shared(tokenizer)
        kind = id_type(encoder.vocab_size)
        for batch in batches:
            for a, b in pieces.runs(batch.column(1), 1 << 23):
                ids, n = encoder.encode(batch.column(1).slice(a, b - a))
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(n), end_id)
                    n = n + 1
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(a, b - a), "n_tokens": pa.array(n),
                    "ids": binaries(ids.astype(kind), n)})

    return pick(docs).mapInArrow(encode, TOKENS)


def id_type(vocab_size: int) -> np.dtype:
    return np.dtype("<u2" if vocab_size <= 1 << 16 else "<u4")


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[:len(ranks)] = length - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Inverse of ``encode_ranks``: lengths by table lookup, then one gather
    for each byte place."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(length) - length
    raw = np.frombuffer(data, np.uint8)
    out = raw[start].astype(np.uint32) if n else np.empty(0, np.uint32)
    for place in range(1, 4):
        has = np.flatnonzero(length > place)
        if len(has):
            out[has] |= raw[start[has] + place].astype(np.uint32) << (8 * place)
    return out


def count_ids(tokens: DataFrame, width: int) -> DataFrame:
    """``(id, n)`` over all documents: each task adds up its own ids first."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            rows = batch.column(0).cast(pa.large_binary())
            _, offsets, data = rows.buffers()
            if data is None:
                continue
            ends = np.frombuffer(offsets, np.int64)[rows.offset:rows.offset + len(rows) + 1]
            ids = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(f"<u{width}")
            for k in range(0, len(ids), 1 << 20):
                seen = np.bincount(ids[k:k + (1 << 20)], minlength=len(total))
                seen[:len(total)] += total
                total = seen
        ids = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(ids), "n": pa.array(total[ids])})

    return tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0,
                      block_ids: int = 1 << 20) -> None:
    """Write the file set of ``docs`` (``doc_id``, ``text``) under ``path``.

    Passes: encode and store; count ids (at most one row per vocabulary entry
    reaches the driver); deal documents out by id range, sort, code blocks of
    about ``block_ids`` ids (one document at least).
    """
    spark = docs.sparkSession
    kind = id_type(pieces.load(tokenizer).get_vocab_size(with_added_tokens=True))
    width = kind.itemsize
    tokens = materialize(tokenise(docs, tokenizer, end_id), "tokens", compression="zstd")

    counted = count_ids(tokens, width).toPandas().sort_values(["n", "id"], ascending=[False, True])
    ids = counted["id"].to_numpy(np.int64)
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
    spark.createDataFrame(
        [(k, int(i), int(n)) for k, (i, n) in enumerate(zip(ids, counted["n"]))], "rank int, id long, n long",
    ).coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(rank_of)

    def code(batches):
        part, table = TaskContext.get().partitionId(), shared.value
        seq = first = 0
        doc_ids, counts, raws, size = [], [], [], 0

        def block():
            control, data = encode_ranks(table[np.frombuffer(b"".join(raws), kind)])
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "first": pa.array([first]), "n": pa.array([size]),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "counts": pa.array([counts], pa.list_(pa.int64())),
                "control": pa.array([control], pa.binary()), "data": pa.array([data], pa.binary())})

        for batch in batches:
            for doc_id, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                doc_ids.append(doc_id)
                counts.append(n)
                raws.append(raw)
                size += n
                if size >= block_ids:
                    yield block()
                    seq, first = seq + 1, first + size
                    doc_ids, counts, raws, size = [], [], [], 0
        if doc_ids:
            yield block()

    # The row number of the stored tokens: rows of one id are dealt into several parts.
    order = ["doc_id", "_tie"]
    (tokens.withColumn("_tie", F.monotonically_increasing_id())
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids")
     .mapInArrow(code, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` decoded from a file set; ``start``
    counts the ids of all documents before, ``ids`` are little-endian unsigned
    32-bit integers."""
    importable(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    vocabulary = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(vocabulary)

    def decode(batches):
        id_of = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[decode_ranks(row["control"], row["data"], row["n"])].astype("<u4")
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                yield pa.record_batch({
                    "part": pa.array([row["part"]] * len(counts), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "offset": pa.array(row["first"] + ends - counts),
                    "n_tokens": pa.array(counts),
                    "ids": binaries(ids, counts)})

    # One row per written part: a bound that the writer set, not the data.
    parts = blocks.groupBy("part").agg(F.max(F.col("first") + F.col("n")).alias("size"))
    before = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    docs = blocks.mapInArrow(decode, "part int, doc_id long, offset long, n_tokens long, ids binary")
    return (docs.join(F.broadcast(before), "part")
            .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids"))

