"""Periodic runs of words: stretches that repeat themselves with a period.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are equal), of at least ``max(min_words, min_exponent * q)`` words, that
no neighbouring word extends. Periods may be as long as the text allows.

Method, by scale. Periods are taken by octaves, ``2**k <= q < 2**(k+1)``. For
each octave a text is covered by overlapping tiles with a boundary every
``S = 2**(k+1)`` words, each reaching S back and 3 S ahead:

1. ``tiles``: those whose boundary can lie in a run of the octave: its next
   words stand again fewer than S words later, its first word a third time fewer
   than 2 S words later, and the tile has no period below the octave. Tiles that
   follow one another make a strip, a row of bounded size.
2. ``fragments``: each tile by itself. Z-functions from its boundary, of the
   words after it and, reversed, of those before it, give for every period of
   the octave how far to both sides words q apart are equal. Stretches that end
   inside the tile are long enough or dropped; those that reach its edges go on
   in the next tile. A stretch that has a divisor of q as period too belongs
   to that one.
3. ``stitch``: fragments meet by document and period, where those that touch are
   one run.

Why none is lost: words q apart are equal at ``(min_exponent - 1) * q`` places
of a run, at least 3 q. So a boundary lies among the first S of them, with more
than q of them after it, and is live; so is every later boundary that has more
than ``max(q, GRAM)`` of them after it. Tiles reach S back, to the boundary
before, and are read for ``S + max(q, GRAM)`` ahead, beyond the one after it; so
the fragments of one run touch. Why a divisor can be seen in a tile: a fragment
spans at least 2 q words, and if those have a period that divides q, so has all
that q goes on in. A tile that has a period d below the octave has no fragment
of its own: of 2 q words with periods d and q the common divisor is a period.

Strips are spread by document, octave and boundary, so that a very long text is solved by many tasks. A text gives O(n log n) words of tiles
at most, and next to none if nothing repeats; a text without a live tile has no
run and takes no part in the shuffles.

Null and empty texts have no words and no runs. Rows are told apart by id (null
is a value like others) and text; equal rows have equal results, each its own
row. Runs that overlap are all listed; a word is dropped if any run has it after
its first q words. An empty table gives an empty table. Columns other than the
id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantbeam.llm import pieces
from quantbeam.llm.base import importable, pick
from quantbeam.session import materialize

#: Words after a boundary that must stand again for its tile to be made; fewer
#: in octaves of shorter periods.
GRAM = 8
#: Words that the tiles of a strip advance over at most, if more than one.
STRIP_WORDS = 1 << 14
#: Bytes of tiles that are handed on at once.
TILE_BYTES = 1 << 22

KEY = ["doc_id", "text_hash"]
#: Tiles, and with no octave the texts that have some.
TILES = "doc_id long, text_hash long, octave int, boundary long, n_tiles int, back int, words binary, text string"
FRAGMENTS = "doc_id long, text_hash long, period long, first long, beyond long"
COLLAPSED = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
             "top struct<start:long,length:long,period:long>, collapsed string")


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or "").encode().split()


def _next_same(names: np.ndarray) -> np.ndarray:
    """The next place with the same name, or a place beyond all."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    following = np.full(n, 2 * n + 1, np.int64)
    following[order[:-1][same]] = order[1:][same]
    return following


def live_boundaries(codes: np.ndarray, min_exponent: int):
    """``(octave, boundaries)``: places at multiples of S whose next words,
    ``min(2**octave, GRAM)`` of them, stand again fewer than S words later,
    whose first word stands a third time fewer than 2 S words later, and whose
    tile has no shorter period that its first word shows."""
    n, grams, names = len(codes), 1, codes.astype(np.int64)
    ahead = _next_same(names)
    beyond = np.append(ahead, 2 * n + 1)
    third, again = beyond[np.minimum(ahead, n)], ahead
    octave = 0
    while min_exponent << octave <= n:
        if grams < min(1 << octave, GRAM):
            # Names of twice the words: the first place of each pair of names.
            pairs = names[:-grams] * (n + 1) + names[grams:]
            _, first, number = np.unique(pairs, return_index=True, return_inverse=True)
            names, grams = first[number], 2 * grams
            ahead = _next_same(names)
        span = 2 << octave
        at = np.arange(0, len(ahead), span)
        at = at[(ahead[at] - at < span) & (third[at] - at < 2 * span)]
        at = at[~_has_shorter_period(codes, at, again[at] - at, span)]
        if len(at):
            yield octave, at
        elif not (ahead <= n).any():
            return
        octave += 1


def _has_shorter_period(codes: np.ndarray, at: np.ndarray, apart: np.ndarray, span: int) -> np.ndarray:
    """Whether the whole tile of each boundary has the period ``apart``, and
    that is below the octave."""
    low, high = np.maximum(at - span, 0), np.minimum(at + 3 * span, len(codes))
    found = np.zeros(len(at), bool)
    for d in np.unique(apart[apart < span // 2]).tolist():
        here = np.flatnonzero(apart == d)
        equal = np.concatenate([[0], np.cumsum(codes[:-d] == codes[d:])])
        last = np.maximum(high[here] - d, low[here])
        found[here] = equal[last] - equal[low[here]] == last - low[here]
    return found


def strips(boundaries: np.ndarray, span: int):
    """``(first boundary, number)`` of boundaries that follow one another."""
    most = max(1, STRIP_WORDS // span)
    for part in np.split(boundaries, np.flatnonzero(np.diff(boundaries) != span) + 1):
        for k in range(0, len(part), most):
            yield int(part[k]), min(most, len(part) - k)


def z_function(words: list[int], upto: int) -> list[int]:
    """For each place below ``upto``, how many words from there on equal
    those from the beginning on."""
    n = len(words)
    z = [0] * upto
    if upto:
        z[0] = n
    left = right = 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@functools.lru_cache(maxsize=1 << 16)
def prime_divisors(q: int) -> tuple[int, ...]:
    found, f = [], 2
    while f * f <= q:
        if q % f == 0:
            found.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return (*found, q) if q > 1 else tuple(found)


def solve(words: list[int], back: int, octave: int, min_exponent: int):
    """``(period, before, after)`` of a tile: how many places before and from
    the boundary on hold a word equal to that ``period`` later. Stretches that
    end in the tile are given if long enough, others always."""
    span = 2 << octave
    least = min(span // 2, GRAM)
    after, before = words[back:], words[:back][::-1]
    right = z_function(after, min(span, len(after)))
    # Backwards: the words before the boundary, then all up to S after it.
    upper = words[:back + span][::-1]
    ahead = len(upper) - back
    left = z_function(before + [-1] + upper, len(before) + 1 + ahead)
    found = []
    for q in range(span // 2, len(right)):
        reach = span + max(q, least)
        r = min(right[q], reach)
        # Equal words to the left are as many as the two reversed ends share.
        l = left[len(before) + 1 + ahead - q] if q <= ahead else 0
        if l + r < (min_exponent - 1) * q and l < span and r < reach:
            continue
        divided = False
        for f in prime_divisors(q):
            p = q // f
            if right[p] >= r + q - p and (p <= ahead and left[len(before) + 1 + ahead - p] >= l):
                divided = True
                break
        if not divided:
            found.append((q, l, r))
    return found


def _keyed(docs: DataFrame) -> DataFrame:
    return pick(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def tiles(docs: DataFrame, min_exponent: int = 4) -> DataFrame:
    """A row for each strip of tiles that can hold part of a run; ``words`` are
    numbers that are equal where the words are. And a row for each text with tiles."""
    importable(docs.sparkSession)

    def run(batches):
        made, size = [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                codes, any_tile = numbered(split_words(text)), False
                for octave, boundaries in live_boundaries(codes, min_exponent):
                    span = 2 << octave
                    for b, n in strips(boundaries, span):
                        low = max(0, b - span)
                        part = codes[low:b + (n + 2) * span].tobytes()
                        made.append((doc_id, text_hash, octave, b, n, b - low, part, None))
                        size += len(part) + 64
                        any_tile = True
                        if size >= TILE_BYTES:
                            yield _rows(made, TILES)
                            made, size = [], 0
                if any_tile:
                    made.append((doc_id, text_hash, None, None, None, None, None, text))
                    size += len(text)
        if made:
            yield _rows(made, TILES)

    return _keyed(docs).mapInArrow(run, TILES)


def numbered(words: list[bytes]) -> np.ndarray:
    """Numbers that are equal where the words are."""
    return np.fromiter(map({}.setdefault, words, itertools.count()), np.int32, len(words))


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.record_batch([pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def fragments(tiled: DataFrame, min_exponent: int = 4) -> DataFrame:
    """Stretches of places with equal words ``period`` apart, by tile; those
    of tiles that follow each other in a batch are joined already."""
    importable(tiled.sparkSession)

    def run(batches):
        for batch in batches:
            ongoing, done = {}, []
            for doc_id, text_hash, octave, first, n, back, words in zip(*(batch.column(k).to_pylist() for k in range(7))):
                words, span = np.frombuffer(words, np.int32).tolist(), 2 << octave
                for b in range(first, first + n * span, span):
                    at = b - first + back
                    low = max(0, at - span)
                    for q, l, r in solve(words[low:at + 3 * span], at - low, octave, min_exponent):
                        key = (doc_id, text_hash, q)
                        have = ongoing.get(key)
                        if have and have[0] <= b - l <= have[1]:
                            ongoing[key] = (have[0], max(have[1], b + r))
                            continue
                        if have:
                            done.append((*key, *have))
                        ongoing[key] = (b - l, b + r)
            done += [(*key, *have) for key, have in ongoing.items()]
            if done:
                yield _rows(done, FRAGMENTS)

    return tiled.mapInArrow(run, FRAGMENTS)


def stitch(found: DataFrame, min_words: int = 6, min_exponent: int = 4) -> DataFrame:
    """``(doc_id, text_hash, start, length, period)`` of the runs: fragments
    of one document and period that touch are one."""
    by_period = Window.partitionBy(*KEY, "period")
    earlier = by_period.orderBy("first", "beyond").rowsBetween(Window.unboundedPreceding, -1)
    upto_here = by_period.orderBy("first", "beyond").rowsBetween(Window.unboundedPreceding, 0)
    begins = (F.col("first") > F.coalesce(F.max("beyond").over(earlier), F.lit(-1))).cast("int")
    merged = (found.distinct().withColumn("begins", begins).withColumn("stretch", F.sum("begins").over(upto_here))
              .groupBy(*KEY, "period", "stretch").agg(F.min("first").alias("start"), F.max("beyond").alias("beyond")))
    length = F.col("beyond") - F.col("start") + F.col("period")
    return (merged.select(*KEY, "start", length.alias("length"), "period")
            .filter(length >= F.greatest(F.lit(min_words), min_exponent * F.col("period"))))


def runs_of(tiled: DataFrame, min_words: int = 6, min_exponent: int = 4) -> DataFrame:
    """All runs from the tiles of all texts. Equal rows share one set of runs."""
    spread = tiled.filter("octave is not null").drop("text").repartition(F.xxhash64(*KEY, "octave", "boundary"))
    return stitch(fragments(spread, min_exponent), min_words, min_exponent)


def _collapse(words: list[bytes], runs: list[dict]) -> str:
    keep = np.ones(len(words), bool)
    for r in runs:
        keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
    return b" ".join(itertools.compress(words, keep.tolist())).decode()


def _greater(a: dict, b: dict) -> bool:
    """Whether ``a`` has the greater exponent, exactly; ties go to the
    smaller start, then the smaller period."""
    x, y = a["length"] * b["period"], b["length"] * a["period"]
    return x > y or x == y and (a["start"], a["period"]) < (b["start"], b["period"])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapsed(ids: pa.Array, texts: list, runs: list) -> pa.RecordBatch:
    n, tops, kept = [], [], []
    for text, found in zip(texts, runs):
        words, top = split_words(text), None
        for r in found:
            top = r if top is None or _greater(r, top) else top
        n.append(len(words))
        tops.append(top)
        kept.append(_collapse(words, found) if found else b" ".join(words).decode())
    return pa.record_batch([ids, pa.array(n, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(tops, RUN),
                            pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "top", "collapsed"])


def without_tiles(docs: DataFrame, min_exponent: int) -> DataFrame:
    """The results of the texts that have no live tile, and so no run."""
    importable(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b in pieces.runs(batch.column(2)):
                rows = batch.slice(a, b - a)
                texts = rows.column(2).to_pylist()
                plain = [next(live_boundaries(numbered(split_words(t)), min_exponent), None) is None for t in texts]
                chosen = [t for t, p in zip(texts, plain) if p]
                if chosen:
                    yield _collapsed(rows.column(0).filter(pa.array(plain)), chosen, [[]] * len(chosen))

    return _keyed(docs).mapInArrow(run, COLLAPSED)


def collapse(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """The results of ``(doc_id, text_hash, text)`` rows by their runs."""
    importable(texts.sparkSession)
    listed = runs.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    listed = listed.withColumn("runs", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"r.{k}")) for k in KEY]
    # Runs grow with the documents: one plan at every size, no broadcast.
    joined = texts.alias("d").join(listed.alias("r").hint("merge"), same[0] & same[1], "left").select(
        "d.doc_id", "d.text", "r.runs")

    def run(batches):
        for batch in batches:
            for a, b in pieces.runs(batch.column(1)):
                rows = batch.slice(a, b - a)
                yield _collapsed(rows.column(0), rows.column(1).to_pylist(), [r or [] for r in rows.column(2).to_pylist()])

    return joined.mapInArrow(run, COLLAPSED)


def collapse_runs(docs: DataFrame, min_words: int = 6, min_exponent: int = 4) -> DataFrame:
    """A row per document: its words, its runs by start and period, the run
    of the greatest exponent, and the text with each run cut to its first
    period."""
    if min_exponent < 4:
        raise ValueError("tiles are made for runs of four periods and more")
    tiled = materialize(tiles(docs, min_exponent), "run-tiles")
    runs = materialize(runs_of(tiled, min_words, min_exponent), "periodic-runs")
    texts = tiled.filter("octave is null").select(*KEY, "text")
    return without_tiles(docs, min_exponent).unionByName(collapse(texts, runs))
