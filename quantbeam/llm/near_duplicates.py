"""Near duplicates by weighted Jaccard similarity of word-shingle multisets.

*Signatures* (BagMinHash). A shingle that occurs ``w`` times covers the unit
levels 0 to ``w - 1`` of a weight axis. Over each (shingle, level) runs a
Poisson process of rate 1, and each of its points falls on one of ``m``
signature places at random; place ``i`` keeps the earliest point that falls on
it. Two multisets have the same earliest point at a place with a probability
equal to their weighted Jaccard similarity: the estimate is unbiased. The
processes are not run level by level: the axis is halved into the intervals
[0,1), [1,2), [2,4), [4,8) ..., one process with the summed rate runs over
each interval that the weight reaches, and each point descends the halves of
its interval by bits of its own hash to its level; it counts if that is below
``w``. Only points up to a time by which all places are filled are drawn; if
some place is still empty, the time is doubled and the processes go on.

*Candidates*. The signature is cut into ``bands``; texts that agree on a whole
band share a bucket. With 32 bands of 4 places, a pair at the threshold of 0.8
misses every bucket with a probability of 5e-8.

*Verification*, exact, on the texts, without all the pairs of a bucket:

1. every member of a bucket is compared with the bucket's least member;
   members that are similar enough are linked, links are closed to groups;
2. buckets that still hold several groups are compared again across groups.
   A bucket of at most ``small_bucket`` members gives its pairs across groups. A
   larger one is dealt into blocks of about ``block`` members, or of about
   ``block_shingles`` shingles if that is less; each task holds two
   blocks, gets all overlaps there from products of count matrices, and gives
   out only links that join groups it has not joined yet: never the pairs;
3. links of both rounds are closed to the result.

Pairs within a group need no comparison, so a group of any size costs a few
comparisons per member. Equal texts are one node from the start.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters.
A text of fewer words than a shingle has is one shingle. Null and wordless
texts are like their equals only. Very long texts are compared whole: of
shingles by the million, blocks hold few members. Rows with equal ids are told
apart by text, repeated rows have one class. An empty table gives an empty
result. Columns other than the id and the text are not read, so their names cannot
clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantbeam.llm.base import importable, pick
from quantbeam.session import TEXT_BATCH, materialize

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3
MASK = (1 << 64) - 1

_OCTETS = np.arange(256, dtype=np.uint8)
LOWERED = np.where((_OCTETS >= 65) & (_OCTETS <= 90), _OCTETS + 32, _OCTETS).astype(np.uint64) + np.uint64(1)
IN_WORD = ((_OCTETS >= 48) & (_OCTETS <= 57)) | ((_OCTETS >= 65) & (_OCTETS <= 90)) | \
    ((_OCTETS >= 97) & (_OCTETS <= 122)) | (_OCTETS >= 128)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with well spread bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown at need."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -k, 1 << 64))])
        return self.up[:n], self.down[:n]


POWERS = Powers()


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, in order: sums of octets times powers of
    the base between the word's ends, shifted to the word's start."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = IN_WORD[raw]
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = POWERS.get(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(LOWERED[raw] * up, out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def shingles(text: str | None, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending, and their counts."""
    w = word_hashes(text)
    if not len(w):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = min(size, len(w))
    h = np.zeros(len(w) - size + 1, np.uint64)
    for k in range(size):
        h = mix(h + STEP) + w[k:len(w) - size + 1 + k]
    return np.unique(mix(h), return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, m: int = 128) -> np.ndarray:
    """The BagMinHash signature: the time of the earliest point at each place."""
    out = np.full(m, np.inf)
    seeds, limits, first = [], [], []
    low, j = 0, 0
    while True:
        reach = weights > low
        if not reach.any():
            break
        seeds.append(mix(elements[reach] + np.uint64(((j + 1) * int(STEP)) & MASK)))
        limits.append(weights[reach])
        first.append(np.full(int(reach.sum()), low, np.int64))
        low, j = (1 if j == 0 else 2 * low), j + 1
    seed, limit, lowest = map(np.concatenate, (seeds, limits, first))
    rate = np.maximum(lowest, 1).astype(float)         # an interval [a, 2a) is as wide as it starts
    span = np.maximum(lowest, 1).astype(np.uint64)
    clock, drawn = np.zeros(len(seed)), np.zeros(len(seed), np.uint64)
    until = m * (math.log(m) + 3) / float(weights.sum())
    while True:
        live = np.flatnonzero(clock <= until)
        while len(live):
            # A few points of each process at a time, as many as it will need.
            ahead = int(min(256, max(1, np.max((until - clock[live]) * rate[live]) / 2, 1))) if len(live) < 512 else 1
            step = drawn[live][:, None] + np.arange(1, ahead + 1, dtype=np.uint64)
            draw = mix(seed[live][:, None] + step * STEP)
            wait = -np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / rate[live][:, None]
            time = clock[live][:, None] + np.cumsum(wait, axis=1)
            other = mix(draw ^ MIX2)
            place = ((other >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            level = lowest[live][:, None] + ((other & np.uint64(0xFFFFFFFF)) % span[live][:, None]).astype(np.int64)
            counts = (time <= until) & (level < limit[live][:, None])
            np.minimum.at(out, place[counts], time[counts])
            # Points beyond ``until`` are drawn again when the time is doubled.
            done = (time <= until).sum(axis=1)
            ended = done < ahead
            clock[live] = np.where(done > 0, time[np.arange(len(live)), np.maximum(done - 1, 0)], clock[live])
            drawn[live] += done.astype(np.uint64)
            live = live[~ended]
        if np.isfinite(out).all():
            return out
        until *= 2


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit bucket key for each band of the signature."""
    bits = sig.view(np.uint64).reshape(bands, -1)
    key = mix(np.arange(1, bands + 1, dtype=np.uint64) * STEP)
    for k in range(bits.shape[1]):
        key = mix(key + STEP) + bits[:, k]
    return mix(key).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: summed least over summed greatest counts."""
    both, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][at], b[1][bt]).sum())
    total = int(a[1].sum() + b[1].sum()) - least
    return least / total if total else 0.0


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, text_key, weight, keys)``: an md5 of the text, the number
    of its shingles and its bucket keys (none without words)."""
    importable(docs.sparkSession)

    def apply(batches):
        for batch in batches:
            weight, keys = [], []
            for text in batch.column(2).to_pylist():
                elements, weights = shingles(text, size)
                weight.append(int(weights.sum()))
                keys.append(band_keys(signature(elements, weights, bands * rows), bands).tolist() if len(elements) else [])
            yield pa.record_batch({"doc_id": batch.column(0), "text_key": batch.column(1),
                                   "weight": pa.array(weight, pa.int64()), "keys": pa.array(keys, pa.list_(pa.int64()))})

    return (pick(docs).select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
            .mapInArrow(apply, "doc_id long, text_key string, weight long, keys array<long>"))


def text_key(text: Column) -> Column:
    """The identity of a text; null is a text of its own."""
    return F.coalesce(F.md5(F.encode(text, "utf-8")), F.lit("null"))


def verify(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose texts are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def apply(batches):
        recent: dict[int, tuple] = {}

        def of(node, text):
            found = recent.get(node)
            if found is None:
                if len(recent) >= 64:
                    recent.clear()
                found = recent[node] = shingles(text, size)
            return found

        for batch in batches:
            a, b, ta, tb = (batch.column(k).to_pylist() for k in range(4))
            held = [similarity(of(a[k], ta[k]), shingles(tb[k], size)) >= threshold for k in range(len(a))]
            yield pa.record_batch({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(held, pa.bool_()))

    return (pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(apply, "a long, b long"))


def groups(links: DataFrame, label: str = "groups") -> DataFrame:
    """``(node, root)``: the least node of each connected group of the links
    ``(a, b)``. Each round takes the least root among neighbours and then that
    root's root, so roots travel twice as far every round."""
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), f"{label}-links")
    roots = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("node"), F.least("a", "m").alias("root")), label)
    while True:
        near = (both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m")))
        closer = (roots.join(near.withColumnRenamed("a", "node"), "node")
                  .select("node", F.col("root").alias("was"), F.least("root", "m").alias("next")))
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        following = materialize(closer.join(jump, "next", "left").select(
            "node", "was", F.least("next", F.coalesce("beyond", "next")).alias("root")), label)
        changed = following.filter("root < was").limit(1).count()
        roots = following.select("node", "root")
        if not changed:
            return roots


def block_links(members: DataFrame, texts: DataFrame, size: int, threshold: float, block: int,
                block_shingles: int) -> DataFrame:
    """Links ``(a, b)`` that join the groups of ``members`` ``(key, node,
    root, n, load)`` within each key, found block against block. A task holds
    the texts of two blocks and their matrix of overlaps; ``load``, the shingles
    of the whole key, keeps blocks of long texts small."""
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(block), F.col("load") / F.lit(block_shingles))).cast("long")
    own = F.pmod(F.xxhash64("node", "key"), blocks)
    met = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    rows = (members.select("key", "node", "root", own.alias("own"), met.alias("other"))
            .select("key", "node", "root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
            .join(texts, "node"))

    def compare(table: pa.Table) -> pa.Table:
        node, root = (table.column(c).to_numpy() for c in ("node", "root"))
        held = [shingles(t, size) for t in table.column("text").to_pylist()]
        weight = np.array([w.sum() for _, w in held], np.int64)
        # A shingle that occurs w times is w features: overlaps are products.
        feature = np.concatenate([np.repeat(e, w) + _levels(w) * STEP for e, w in held])
        owner = np.repeat(np.arange(len(held)), weight)
        values, column, often = np.unique(mix(feature), return_inverse=True, return_counts=True)
        shared = often[column] > 1
        renumber = np.cumsum(often > 1) - 1
        owner, column = owner[shared], renumber[column[shared]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        overlap = np.zeros((len(held), len(held)), np.float32)
        width = 2048
        for first in range(0, int((often > 1).sum()), width):
            a, b = np.searchsorted(column, [first, first + width])
            part = np.zeros((len(held), width), np.float32)
            part[owner[a:b], column[a:b] - first] = 1
            overlap += part @ part.T
        close = overlap >= threshold * (weight[:, None] + weight[None, :] - overlap) - 1e-4
        a, b = np.nonzero(np.triu(close, 1) & (root[:, None] != root[None, :]))
        joined: dict[int, int] = {}

        def top(r: int) -> int:
            while joined.get(r, r) != r:
                r = joined[r]
            return r

        links = []
        for i, j in zip(a.tolist(), b.tolist()):
            r, s = top(int(root[i])), top(int(root[j]))
            # The product is exact in single precision; the quotient is decided here.
            if r != s and overlap[i, j] / float(weight[i] + weight[j] - overlap[i, j]) >= threshold:
                joined[max(r, s)] = min(r, s)
                links.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return rows.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def _levels(weights: np.ndarray) -> np.ndarray:
    """0 to w - 1 for each weight w, one after another."""
    ends = np.cumsum(weights)
    return (np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - weights, weights)).astype(np.uint64)


def across(members: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs ``(a, b)`` with the same key, of different groups, whose
    weights allow the similarity."""
    several = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    m = members.join(several, "key", "left_semi")
    left = m.select("key", F.col("node").alias("a"), F.col("weight").alias("wa"), F.col("root").alias("ra"))
    right = m.select("key", F.col("node").alias("b"), F.col("weight").alias("wb"), F.col("root").alias("rb"))
    return (left.join(right, "key").filter("a < b and ra <> rb")
            .filter(F.least("wa", "wb") >= F.greatest("wa", "wb") * threshold - 1e-9)
            .select("a", "b").distinct())


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 4,
                    small_bucket: int = 50, block: int = 1024, block_shingles: int = 1_000_000) -> DataFrame:
    """``(doc_id, text_key, class_id, text_class, heads)`` per document:
    ``class_id`` is the least id of its group, ``text_class`` that of its equal
    texts; ``heads`` marks the rows with the text that stands for the group
    (the text of the least id)."""
    base = pick(docs)
    signs = materialize(signed(base, size, bands, rows), "signatures", batch_bytes=TEXT_BATCH)
    # Nodes: distinct texts, numbered by hash where ids are null or shared.
    nodes = materialize(signs.groupBy("text_key").agg(F.min("doc_id").alias("least"), F.first("weight").alias("weight"),
                                                      F.first("keys").alias("keys"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")

    band = nodes.select("node", "weight", F.explode("keys").alias("key"))
    buckets = materialize(band.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n"),
                                                  F.sum("weight").alias("load")).filter("n > 1"), "buckets")
    members = materialize(band.join(buckets, "key"), "members")
    stars = members.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    stars = materialize(stars, "stars")
    # Texts of the nodes that share a bucket, once each.
    wanted = members.select("node").distinct().join(nodes.select("node", "text_key"), "node")
    texts = materialize(base.select(text_key(F.col("text")).alias("text_key"), "text").join(wanted, "text_key")
                        .groupBy("node").agg(F.first("text").alias("text")), "texts", compression="zstd")
    links = materialize(verify(stars, texts, size, threshold), "links", batch_bytes=TEXT_BATCH)
    roots = groups(links, "roots")

    grouped = (members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
               .select("key", "node", "weight", "root", "n", "load"))
    grouped = materialize(grouped, "grouped")
    more = across(grouped.filter(F.col("n") <= small_bucket), threshold).join(stars, ["a", "b"], "left_anti")
    more = materialize(more, "more")
    large = grouped.filter(F.col("n") > small_bucket)
    mixed = large.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    large = materialize(large.join(mixed, "key", "left_semi"), "large")
    found = []
    if not more.isEmpty():
        found.append(verify(more, texts, size, threshold))
    if not large.isEmpty():
        found.append(block_links(large, texts, size, threshold, block, block_shingles))
    if found:
        for f in found:
            links = links.unionByName(f)
        roots = groups(links, "roots")

    # From nodes back to rows: every text has a root and the least id there.
    rooted = nodes.select("text_key", "node", "least").join(roots, "node", "left") \
        .select("text_key", "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.min(
        F.struct(F.col("least").isNull().alias("none"), "least", "text_key")).alias("head"))
    facts = rooted.join(least, "root").select(
        "text_key", F.col("least").alias("text_class"), "class_id", (F.col("head.text_key") == F.col("text_key")).alias("heads"))
    return (signs.select("doc_id", "text_key").join(facts, "text_key")
            .select("doc_id", "text_key", "class_id", "text_class", "heads"))
