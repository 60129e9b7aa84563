"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

1. *Counts*, over all training rows: for each n-gram, how many texts of either
   label have it. Tasks add up their own texts, Spark sums by n-gram. N-grams are
   told apart by 64-bit hashes, so that their number follows the corpus.
2. *Ratios*: the log of the n-gram's smoothed share among label 1 over that
   among label 0. Every n-gram counts whose ratio is ``least_ratio`` from 0 and
   significant: by the likelihood-ratio test of its four counts, at the level at
   which ``false_share`` of those found are expected to be so by chance, given how
   many are tested (Benjamini and Hochberg). These alone reach the driver.
3. *Windows*: a text is read in windows of ``span`` characters that overlap by
   half. A window's margin is the sum of the weights of the n-grams that are
   present in it; a text's margin is its greatest. So a passage weighs the same
   in a short text and in one of any length, and clean text beside it nothing.
4. *Fit*: logistic regression on (present or not) * ratio of the window that
   the ratios alone point to, on a sample of at most ``fit_rows`` training rows,
   half of either label if there are as many; the intercept is then moved from
   the sample's odds to the corpus's. The sample is chosen by a hash of id and
   text; of each row the driver holds the numbers of one window's n-grams.

Null and empty texts have no n-grams and get the score of the intercept. Very
long texts have more windows, one after another in a task. Training rows with a
null label or text teach nothing; without rows of both labels every score is the
smoothed share of label 1. Equal rows are counted each, and scored alike; of
windows with equal margins the first is taken. An empty table gives an empty
result. Columns other than those named are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantbeam.llm.base import bounded_sample, importable, pick
from quantbeam.session import materialize

SIZES = (3, 4, 5)
SPAN = 2000
#: N-grams that a task holds before it hands their counts on.
FLUSH = 1_500_000
#: Places of the table that rules out most n-grams before they are looked up.
SIEVE = 1 << 20


def hashed(text: str, sizes: tuple[int, ...] = SIZES):
    """For each size, the 64-bit hashes of the n-grams that begin at each
    place of the lower-cased text, framed by spaces."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = np.zeros(len(points), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(points) < n:
            return
        # Horner's rule over the n characters from each place on.
        mixed = mixed[:len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:] + np.uint64(n)
        if n in sizes:
            spread = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            yield n, (spread ^ (spread >> np.uint64(29))).view(np.int64)


def distinct_ngrams(text: str) -> np.ndarray:
    found = [h for _, h in hashed(text)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


@dataclass
class Model:
    """``keys``: hashes of the n-grams that count, ascending, with ``weights``."""
    keys: np.ndarray
    weights: np.ndarray
    intercept: float
    span: int = SPAN
    _sieve: np.ndarray | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_sieve": None}

    def hits(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """``(window, number of the n-gram)`` pairs, distinct, by window; and
        how many windows the text has."""
        if self._sieve is None:
            self._sieve = np.zeros(SIEVE, bool)
            self._sieve[self.keys & (SIEVE - 1)] = True
        places, numbers = [], []
        for _, h in hashed(text):
            maybe = np.flatnonzero(self._sieve[h & (SIEVE - 1)])
            if len(maybe):
                at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                same = self.keys[at] == h[maybe]
                places.append(maybe[same])
                numbers.append(at[same])
        half = self.span // 2
        windows = max(1, -(-(len(text) + 2) // half) - 1)
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int64), windows
        place, number = np.concatenate(places) // half, np.concatenate(numbers)
        # A place lies in the window that begins in its half, and the one before.
        window = np.concatenate([place, place - 1])
        pair = (window * len(self.keys) + np.tile(number, 2))[(window >= 0) & (window < windows)]
        pair = np.unique(pair)
        return pair // len(self.keys), pair % len(self.keys), windows

    def best_window(self, text: str | None) -> tuple[float, np.ndarray]:
        """The greatest sum of weights of a window, and its n-grams."""
        if not text or not len(self.keys):
            return 0.0, np.empty(0, np.int64)
        window, number, n = self.hits(text)
        sums = np.bincount(window, self.weights[number], minlength=n)
        best = int(sums.argmax())
        return float(sums[best]), number[window == best]

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.intercept + self.best_window(text)[0], -500, 500))))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, keep=None) -> DataFrame:
    """``(doc_id, text, y)`` of labelled texts; ``keep`` is a condition on
    ``doc_id``."""
    y = label_ids(labels, label, keep)
    rows = pick(docs).filter(F.col("text").isNotNull())
    if keep is not None:
        rows = rows.filter(keep)
    # Labels grow with the documents: one plan at every size, no broadcast.
    return rows.hint("merge").join(y, "doc_id")


def label_ids(labels: DataFrame, label: str, keep=None) -> DataFrame:
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    return (y if keep is None else y.filter(keep)).filter(F.col("y").isin(0, 1))


def count_ngrams(rows: DataFrame) -> DataFrame:
    """``(gram, zero, one)``: texts of either label that have the n-gram; of
    the gram null: all texts."""
    def count(batches):
        held = np.empty(0, np.int64), np.empty((2, 0), np.int64)
        waiting, size, texts = ([], []), 0, np.zeros(2, np.int64)

        def added(held):
            """``held`` and the counts of the texts that wait."""
            for y in (0, 1):
                if waiting[y]:
                    gram, n = np.unique(np.concatenate(waiting[y]), return_counts=True)
                    both, place = np.unique(np.concatenate([held[0], gram]), return_inverse=True)
                    sums = np.zeros((2, len(both)), np.int64)
                    sums[:, place[:len(held[0])]] = held[1]
                    sums[y, place[len(held[0]):]] += n
                    held = both, sums
                    waiting[y].clear()
            return held

        def handed(held):
            return pa.record_batch({"gram": pa.array(held[0]), "zero": pa.array(held[1][0]), "one": pa.array(held[1][1])})

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts[y] += 1
                waiting[y].append(distinct_ngrams(text))
                size += len(waiting[y][-1])
                if size > FLUSH:
                    held, size = added(held), 0
                    if len(held[0]) > FLUSH:
                        yield handed(held)
                        held = np.empty(0, np.int64), np.empty((2, 0), np.int64)
        yield handed(added(held))
        yield pa.record_batch({"gram": pa.array([None], pa.int64()), "zero": pa.array(texts[:1]), "one": pa.array(texts[1:])})

    return (rows.select("text", "y").mapInArrow(count, "gram long, zero long, one long")
            .groupBy("gram").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")))


def log_ratio(zero: Column, one: Column, n0: int, n1: int) -> Column:
    return F.log((one + 1) / (n1 + 2.0)) - F.log((zero + 1) / (n0 + 2.0))


def likelihood_ratio(zero: Column, one: Column, n0: int, n1: int) -> Column:
    """Twice the log likelihood ratio of the four counts against an n-gram
    that is as frequent in both labels."""
    share = (zero + one) / float(n0 + n1)
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    return 2 * (part(one, share * n1) + part(zero, share * n0)
                + part(n1 - one, (1 - share) * n1) + part(n0 - zero, (1 - share) * n0))


#: Steps of the test's value in which its distribution is gathered, a half each.
STEPS = 2000


def least_test(found: dict[int, int], false_share: float) -> float:
    """From how many n-grams have each half step of the test's value: the
    least value at which at most ``false_share`` of those above are expected by
    chance (of n-grams without meaning, the square of a normal deviate)."""
    total, above, least = sum(found.values()), 0, math.inf
    for step in sorted(found, reverse=True):
        above += found[step]
        if total * math.erfc(math.sqrt(step / 4)) <= false_share * above:
            least = step / 2
    return least


def significant(counted: DataFrame, n0: int, n1: int, least_ratio: float, false_share: float) -> DataFrame:
    """``(gram, ratio)`` of the n-grams that count."""
    zero, one = F.col("zero"), F.col("one")
    tested = counted.filter("gram is not null").select(
        "gram", log_ratio(zero, one, n0, n1).alias("ratio"), likelihood_ratio(zero, one, n0, n1).alias("test"))
    # Rounding may leave a value of 0 just below.
    step = F.greatest(F.least(F.floor(2 * F.col("test")), F.lit(STEPS)), F.lit(0))
    # A row per step reaches the driver.
    found = {r["step"]: r["n"] for r in tested.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()}
    least = least_test(found, false_share)
    return tested.filter(F.abs("ratio") >= least_ratio).filter(F.col("test") >= F.lit(least)).select("gram", "ratio")


def fit_logistic(x_at: np.ndarray, x_row: np.ndarray, x_value: np.ndarray, y: np.ndarray, width: int,
                 l2: float = 0.05, steps: int = 200, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam over all rows at once; the data are
    (column, row, value) triples."""
    theta, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        margin = theta[-1] + np.bincount(x_row, theta[x_at] * x_value, minlength=len(y))
        error = 1.0 / (1.0 + np.exp(-np.clip(margin, -50, 50))) - y
        grad = np.append(np.bincount(x_at, error[x_row] * x_value, minlength=width), error.sum()) / len(y)
        grad[:-1] += l2 * theta[:-1] / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def sampled_windows(docs: DataFrame, labels: DataFrame, label: str, keep, fit_rows: int, ratios) -> list[tuple[np.ndarray, int]]:
    """``(n-grams of the best window, y)`` of at most ``fit_rows`` training
    rows, whatever ids are repeated."""
    ids, half = label_ids(labels, label, keep), fit_rows // 2
    # At most fit_rows ids: a bound that the caller sets.
    parts = [bounded_sample(ids.filter(F.col("y") == y).distinct(), "doc_id", half) for y in (0, 1)]
    rows = pick(docs).filter(F.col("text").isNotNull()).join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")

    def windows(batches):
        model = ratios.value
        for batch in batches:
            found = [model.best_window(t)[1].astype(np.int32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(found, pa.binary()), batch.column(1), batch.column(2)], names=["at", "y", "mixed"])

    read = rows.select("text", "y", F.xxhash64("doc_id", "text").alias("mixed")).mapInArrow(
        windows, "at binary, y int, mixed long")
    # Rows of one id may be many: the bound holds for rows.
    return [(np.frombuffer(r["at"], np.int32), y) for y in (0, 1)
            for r in read.filter(F.col("y") == y).orderBy("mixed", "at").limit(half).collect()]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep=None, fit_rows: int = 4000,
          span: int = SPAN, least_ratio: float = 0.5, false_share: float = 0.1) -> Model:
    """Fit the model on the labelled rows whose id meets ``keep``."""
    spark = docs.sparkSession
    importable(spark)
    counted = materialize(count_ngrams(training_rows(docs, labels, label, keep)), "ngram-counts")
    totals = counted.filter("gram is null").first()
    n0, n1 = (totals.zero, totals.one) if totals else (0, 0)
    prior = (n1 + 1) / (n0 + n1 + 2)
    odds = math.log(prior / (1 - prior))
    nothing = Model(np.empty(0, np.int64), np.empty(0), odds, span)
    if not n0 or not n1:
        return nothing
    kept = significant(counted, n0, n1, least_ratio, false_share).toPandas().sort_values("gram")
    ratios = Model(kept["gram"].to_numpy(np.int64), kept["ratio"].to_numpy(float), 0.0, span)
    sample = sampled_windows(docs, labels, label, keep, fit_rows, spark.sparkContext.broadcast(ratios))
    y = np.array([y for _, y in sample], float)
    if len(set(y)) < 2:
        return nothing
    x_row = np.repeat(np.arange(len(sample)), [len(at) for at, _ in sample])
    x_at = np.concatenate([at for at, _ in sample]).astype(np.int64)
    theta, intercept = fit_logistic(x_at, x_row, ratios.weights[x_at], y, len(ratios.keys))
    share = (y.sum() + 1) / (len(y) + 2)
    return Model(ratios.keys, theta * ratios.weights, float(intercept + odds - np.log(share / (1 - share))), span)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every text."""
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)

    def apply(batches):
        model = shared.value
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(
                [model.score(t) for t in batch.column(1).to_pylist()], pa.float64())})

    return pick(docs).mapInArrow(apply, "doc_id long, score double")
