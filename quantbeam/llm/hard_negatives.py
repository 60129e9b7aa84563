"""Hard negatives: rows of another label that score close below a positive.

Vectors are read as integers (``floor(scale * x)``), so that scores, the inner
products with an anchor, are exact. An anchor's positives are its ``positives``
best other rows of the same label; for each positive the ``negatives`` best rows
of other labels are taken whose score lies in a window given by the positive's
(``low`` to ``high`` hundredths of it). Ties go to the smaller id.

Method. A cell is one block of anchors against one chunk of all rows; cells are
spread over tasks by a shuffle, and a task reads the chunk's rows block after
block beside its anchors. A tile of scores is the product of two int64 matrices by Strassen's
recursion: halves are added and subtracted exactly, odd sides are padded with
zeros, and seven products replace eight until a side is ``LEAF`` at most.
Integers wrap on the way without harm, as long as the scores themselves fit.
From the tile each anchor keeps its best few in a heap; heaps merge over the
tiles of a cell in the task, then over cells by a shuffle of a few rows per
anchor and cell. First the positives' heaps are merged; then the windows are
known, the tiles are multiplied again, and the windows' heaps are merged.

Every row is compared with every anchor, no matter how large a label is;
nothing is grouped by label. The work is anchors times rows, as asked.

Rows without an id, label or vector and rows with a null, NaN or infinite
component take no part. Vectors shorter than others are padded with zeros. Each
row stands for itself: a repeated row is another row (so a copy of the anchor
can be its positive), and a repeated anchor has its results again. An empty
table, or one without anchors, gives an empty result. A window of a negative
score is empty. Components of a size at which a score might not fit into a long
are refused with an error. Columns other than the three named are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantbeam.llm.base import importable
from quantbeam.session import materialize

#: Sides of matrices that are multiplied directly.
LEAF = 16
#: Anchors of a cell and rows of a tile; tiles of a cell.
BLOCK_ROWS = 1024
CHUNK_BLOCKS = 4

POSITIVES = "anchor long, vec_id long, score long"
NEGATIVES = "anchor long, slot int, vec_id long, score long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, exact modulo 2**64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    c = np.empty((2 * m, 2 * n), np.int64)
    c11, c12, c21, c22 = c[:m, :n], c[:m, n:], c[m:, :n], c[m:, n:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:] = p
    c22[:] = p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return c


def best_of_tile(scores: np.ndarray, allowed: np.ndarray, most: int):
    """``(rows, columns)`` of the ``most`` greatest allowed scores of each row,
    the earlier column first among equals."""
    least = np.iinfo(np.int64).min
    left = np.where(allowed, scores, least)
    open_ = allowed.copy()
    every = np.arange(len(scores))
    for _ in range(min(most, scores.shape[1])):
        some = open_.any(axis=1)
        if not some.any():
            return
        at = left.argmax(axis=1)
        # A score may itself be the least integer: then the first open column.
        dull = some & ~open_[every, at]
        at[dull] = open_[dull].argmax(axis=1)
        rows = every[some]
        yield rows, at[some]
        left[rows, at[some]] = least
        open_[rows, at[some]] = False


class Heaps:
    """The greatest ``most`` entries (score, then smaller id) of each key."""

    def __init__(self, most: int):
        self.most, self.of = most, {}

    def add(self, key, score: int, vec_id: int) -> None:
        heap = self.of.setdefault(key, [])
        if len(heap) < self.most:
            heapq.heappush(heap, (score, -vec_id))
        elif (score, -vec_id) > heap[0]:
            heapq.heapreplace(heap, (score, -vec_id))

    def rows(self):
        """``(key, id, score)`` of all entries."""
        return ((key, -v, s) for key, heap in self.of.items() for s, v in heap)


def integer_rows(embeddings: DataFrame, label: Column | None = None, scale: int = 256, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(row, vec_id, label, codes)`` of the rows that take part, written
    once so that row numbers stay as they are."""
    vector = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    taken = (embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                               (F.col(label_col) if label is None else label).cast("long").alias("label"),
                               vector.alias("v"))
             .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
             .filter(F.forall("v", finite)))
    # A component beyond long would not fit: doubles are compared first.
    inside = lambda x: F.abs(x * scale) < float(1 << 62)
    codes = F.transform("v", lambda x: F.when(inside(x), F.floor(x * scale)).otherwise(
        F.raise_error(F.lit("a component is too large for exact scores"))).cast("long"))
    return materialize(taken.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                                    codes.alias("codes")), "integer-vectors")


def measure(rows: DataFrame, is_anchor: Column) -> tuple[int, int]:
    """How many rows and anchors there are. Refuses vectors whose scores
    might not fit into a long."""
    size = F.array_max(F.transform("codes", lambda x: F.abs(x)))
    found = rows.agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors"), F.max(size).alias("size"),
                     F.max(F.size("codes")).alias("width")).first()
    if found.size and found.size ** 2 * found.width >= 1 << 63:
        raise ValueError("components are too large for exact scores")
    return found.rows, found.anchors


def cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, block_rows: int, chunk_blocks: int) -> DataFrame:
    """Anchors (``kind`` 0) and rows (``kind`` 1), dealt by (block of anchors,
    chunk of rows): each anchor goes to all chunks, each row to all blocks of
    anchors. Of a cell the anchors come first, then the rows by id."""
    n_cells = max(1, -(-n_anchors // block_rows))
    n_chunks = max(1, -(-n_rows // (block_rows * chunk_blocks)))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["row", "vec_id", "label", "codes"]
    left = anchors.select(deal(n_cells).alias("cell"), spread(n_chunks).alias("chunk"), F.lit(0).alias("kind"), *columns,
                          "positives")
    right = rows.select(spread(n_cells).alias("cell"), deal(n_chunks).alias("chunk"), F.lit(1).alias("kind"), *columns,
                        F.lit(None).cast("array<long>").alias("positives"))
    return (left.unionByName(right).repartition(n_cells * n_chunks, "cell", "chunk")
            .sortWithinPartitions("cell", "chunk", "kind", "vec_id"))


def _matrix(codes: pa.ListArray) -> np.ndarray:
    """The vectors of a column as rows, padded with zeros."""
    sizes = np.diff(codes.offsets.to_numpy())
    flat = codes.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    if len(flat) == width * len(sizes):
        return flat.reshape(len(sizes), width)
    made = np.zeros((len(sizes), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = flat
    return made


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    width = max(anchors.shape[1], rows.shape[1])
    wide = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
    return strassen(wide(anchors), np.ascontiguousarray(wide(rows).T))


class Cell:
    """A cell's anchors and what is kept of its tiles."""

    def __init__(self, batches: list[pa.RecordBatch], most: int):
        held = pa.Table.from_batches(batches)
        column = lambda name: held.column(name).combine_chunks()
        self.row, self.vec_id, self.label = (column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.codes = _matrix(column("codes"))
        self.positives = column("positives").to_pylist()
        self.heaps = Heaps(most)

    def tile(self, rows: pa.RecordBatch):
        """Scores with a block of rows, where labels agree, and their ids."""
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        return _scores(self.codes, _matrix(rows.column("codes"))), self.label[:, None] == labels, ids


def _cells_of(batches, block_rows: int, most: int):
    """``(cell, block of rows)`` in the order of the rows; ``(cell, None)`` at
    a cell's end. A cell without anchors is passed over."""
    cell, key, anchors = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy() for c in ("cell", "chunk", "kind")])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            *here, kind = marks[:, a].tolist()
            if here != key:
                if cell:
                    yield cell, None
                cell, key, anchors = None, here, []
            if kind == 0:
                anchors.append(batch.slice(a, b - a))
                continue
            if anchors:
                cell, anchors = Cell(anchors, most), []
            for at in range(a, b, block_rows) if cell else ():
                yield cell, batch.slice(at, min(block_rows, b - at))
    if cell:
        yield cell, None


def _table(schema: str, columns: list) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.record_batch([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names=list(names))


def positives_of_cells(dealt: DataFrame, positives: int, block_rows: int) -> DataFrame:
    """The heaps of each anchor's positives, one per cell."""

    def run(batches):
        for cell, rows in _cells_of(batches, block_rows, positives):
            if rows is None:
                found = list(cell.heaps.rows())
                if found:
                    yield _table(POSITIVES, [[int(cell.row[k]) for k, _, _ in found], [v for _, v, _ in found],
                                             [s for _, _, s in found]])
                continue
            scores, same, ids = cell.tile(rows)
            allowed = same & (cell.row[:, None] != rows.column("row").to_numpy())
            for at, columns in best_of_tile(scores, allowed, positives):
                for k, s, v in zip(at.tolist(), scores[at, columns].tolist(), ids[columns].tolist()):
                    cell.heaps.add(k, s, v)

    return dealt.mapInArrow(run, POSITIVES)


def negatives_of_cells(dealt: DataFrame, negatives: int, low: int, high: int, block_rows: int) -> DataFrame:
    """The heaps of each positive's window, one per cell. ``positives`` of an
    anchor are its positives' scores by rank."""

    def run(batches):
        for cell, rows in _cells_of(batches, block_rows, negatives):
            if rows is None:
                found = list(cell.heaps.rows())
                if found:
                    yield _table(NEGATIVES, [[int(cell.row[k]) for (k, _), _, _ in found],
                                             [slot for (_, slot), _, _ in found], [v for _, v, _ in found],
                                             [s for _, _, s in found]])
                continue
            scores, same, ids = cell.tile(rows)
            for slot in range(max(map(len, cell.positives), default=0)):
                # Integers of Python, which do not overflow; an empty window where there is no such positive.
                of_slot = [p[slot] if slot < len(p) else None for p in cell.positives]
                floor = np.array([1 if p is None else -(-low * p // 100) for p in of_slot], np.int64)[:, None]
                ceiling = np.array([0 if p is None else high * p // 100 for p in of_slot], np.int64)[:, None]
                for at, columns in best_of_tile(scores, ~same & (scores >= floor) & (scores <= ceiling), negatives):
                    for k, s, v in zip(at.tolist(), scores[at, columns].tolist(), ids[columns].tolist()):
                        cell.heaps.add((k, slot + 1), s, v)

    return dealt.mapInArrow(run, NEGATIVES)


def merge(heaps: DataFrame, keys: list[str], most: int, rank: str) -> DataFrame:
    """The first ``most`` of each key over all cells."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return heaps.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= most)


def mine(embeddings: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: int = 256, block_rows: int = BLOCK_ROWS,
         chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``. ``is_anchor`` is a condition on ``vec_id``; ``label``
    an expression on the columns of ``embeddings`` that replaces its label."""
    importable(embeddings.sparkSession)
    rows = integer_rows(embeddings, label, scale)
    n_rows, n_anchors = measure(rows, is_anchor)
    anchors = rows.filter(is_anchor)
    none = F.lit(None).cast("array<long>").alias("positives")
    deal = lambda chosen: cells(rows, chosen, n_rows, n_anchors, block_rows, chunk_blocks)
    heaps = positives_of_cells(deal(anchors.select("*", none)), positives, block_rows)
    best = materialize(merge(heaps, ["anchor"], positives, "slot"), "positives")
    by_rank = F.transform(F.sort_array(F.collect_list(F.struct("slot", "score"))), lambda x: x["score"])
    windows = best.groupBy(F.col("anchor").alias("row")).agg(by_rank.alias("positives"))
    heaps = negatives_of_cells(deal(anchors.join(windows, "row")), negatives, low, high, block_rows)
    found = merge(heaps, ["anchor", "slot"], negatives, "rank")
    chosen = best.select("anchor", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (found.join(chosen, ["anchor", "slot"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
