"""Language identification by words first, then ever shorter character n-grams.

A text's score for a language is the sum over its words of the word's log
frequency there. A word that was met in no training text is scored by its
character n-grams of the greatest length of which training met any, from
``LONGEST`` down to 1: the mean of their log frequencies.

Training counts words and n-grams over all training texts: tasks add up their
own, Spark sums by (language, word). All counts stay in tables. Tasks get the
commonest entries of each language, with their counts in every language:
``max_words`` words and ``max_grams`` n-grams of each length at most a language.
They score what is among these at once and hand on the rest, which is joined
with the tables. So the two numbers bound a task's memory, not the model.

``predict(evidence=True)`` also tells how well the text fits the language found:
the mean log frequency there of the ``FIT``-grams of its words, over those that
tasks hold (others have the frequency of one that was never met). A share of
the likelihood says which language is likelier, not whether any is; gibberish and
languages that training does not have stand out by the fit. ``least_fits`` learns
from labelled rows where it ends: half-way between how well texts of a language
fit it and how well texts of other languages do.

A word is a run of letters, lower-cased. Texts that are null or have no letter
get ``und`` with score 0. With no training rows every text is ``und``. Ties go
to the language that sorts first. Very long texts are read whole; what a task
holds of one are its distinct words. Repeated rows are counted each, and each is
predicted. An empty table gives an empty result. Columns other than the id, the
text and the language are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantbeam.llm import pieces
from quantbeam.llm.base import importable, pick
from quantbeam.session import TEXT_BATCH, materialize

UNDETERMINED = "und"
LONGEST = 4
#: Length of the n-grams that tell how well a text fits.
FIT = 3
#: Entries a task holds before it hands its counts on.
FLUSH = 400_000
#: Bytes of texts whose words a task holds at once when it scores.
RUN = 1 << 20
WORD = regex.compile(r"\p{L}+")


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked; single letters without."""
    if n == 1:
        return list(word)
    marked = f"_{word}_"
    return [marked[k:k + n] for k in range(len(marked) - n + 1)]


@dataclass
class Common:
    """What tasks hold: log frequencies by word, and by n-gram of each length,
    as rows of ``table`` with a column per language."""
    table: np.ndarray
    words: dict[str, int]
    grams: list[dict[str, int]]
    unmet: np.ndarray | None = None      # of a FIT-gram that was never met

    def fit(self, texts: list[Counter]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of log frequencies of the FIT-grams of each text's words by
        language, and how many there are."""
        words = list({w for t in texts for w in t})
        number, held = {w: k for k, w in enumerate(words)}, self.grams[FIT]
        of = [[held.get(g, -1) for g in grams(w, FIT)] for w in words]
        n = np.array([len(x) for x in of], np.int64)
        flat = np.array([r for x in of for r in x], np.int64)
        logs = np.where(flat[:, None] >= 0, self.table[flat], self.unmet)
        sums = np.add.reduceat(logs, np.cumsum(n) - n, axis=0) if len(words) else np.zeros((0, self.table.shape[1]))
        total, count = np.zeros((len(texts), self.table.shape[1])), np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                at, often = [number[w] for w in t], np.array(list(t.values()), np.int64)
                total[k], count[k] = often @ sums[at], often @ n[at]
        return total, count

    def known(self, words: Counter) -> tuple[np.ndarray, dict[str, int]]:
        """The score of the words that are held, and the other words."""
        held = {self.words[w]: n for w, n in words.items() if w in self.words}
        rest = {w: n for w, n in words.items() if w not in self.words}
        return np.array(list(held.values()), float) @ self.table[list(held)] if held else np.zeros(self.table.shape[1]), rest

    def spell(self, word: str):
        """``(size, gram, hits, sums)`` of a word that training never met: what
        the held n-grams add up to (``gram`` is empty), and each n-gram that is
        not held, down to the first length of which any is held."""
        for size in range(LONGEST, 0, -1):
            found = grams(word, size)
            at = [self.grams[size][g] for g in found if g in self.grams[size]]
            yield from ((size, g, 0, np.zeros(self.table.shape[1])) for g in found if g not in self.grams[size])
            if at:
                yield size, "", len(at), self.table[at].sum(axis=0)
                return


@dataclass
class Model:
    """``words``: ``(word, s0, s1, ...)`` with the log frequency in each of
    ``languages``, of all words met; ``grams``: the same by size and gram."""
    languages: list[str]
    common: Common
    words: DataFrame | None
    grams: DataFrame | None

    def predict(self, text: str | None) -> tuple[str, float]:
        """For one text; ``predict`` below takes a table."""
        if not self.languages or not text or not WORD.search(text.lower()):
            return UNDETERMINED, 0.0
        row = self.words.sparkSession.createDataFrame([(0, text)], "doc_id long, text string")
        found = predict(row, self).first()
        return found["lang_pred"], found["score"]


def count_words(rows: DataFrame) -> DataFrame:
    """``(lang, word, n)`` of ``(lang, text)`` rows."""
    def count(batches):
        seen: dict[str, Counter] = {}

        def flush():
            for lang, words in seen.items():
                yield pa.record_batch({"lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(list(words), pa.string()),
                                       "n": pa.array(list(words.values()), pa.int64())})
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
                if sum(map(len, seen.values())) > FLUSH:
                    yield from flush()
        yield from flush()

    return (rows.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def count_grams(counted: DataFrame) -> DataFrame:
    """``(lang, size, gram, n)`` from counted words."""
    def spell(batches):
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, word, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                c = seen.setdefault(lang, Counter())
                for size in range(1, LONGEST + 1):
                    for g in grams(word, size):
                        c[size, g] += n
            for lang, c in seen.items():
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(c)), "size": pa.array([s for s, _ in c], pa.int32()),
                    "gram": pa.array([g for _, g in c]), "n": pa.array(list(c.values()), pa.int64())})

    return (counted.select("lang", "word", "n").mapInArrow(spell, "lang string, size int, gram string, n long")
            .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))


def with_least(counted: DataFrame, by: list[str], most: int) -> DataFrame:
    """Add ``least``: the least power of two that leaves ``most`` entries or
    fewer with such a count in a group of ``by``."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = counted.groupBy(*by, power.alias("power")).agg(F.count("*").alias("m")).toPandas()
    least = []
    for key, part in sizes.groupby(by):
        total, lowest = 0, int(part["power"].max()) + 1
        for p, m in part.sort_values("power", ascending=False)[["power", "m"]].itertuples(index=False):
            if total + m > most:
                break
            total, lowest = total + m, p
        least.append((*(k.item() if hasattr(k, "item") else k for k in (key if isinstance(key, tuple) else (key,))),
                      2 ** int(lowest)))
    kinds = ", ".join(f"{c} {counted.schema[c].dataType.simpleString()}" for c in by)
    bounds = counted.sparkSession.createDataFrame(least, f"{kinds}, least long")
    return counted.join(F.broadcast(bounds), by)


def by_language(counted: DataFrame, by: list[str], languages: list[str], label: str) -> DataFrame:
    """``(*by, common, n0, n1, ...)``: an entry's count in each language, and
    whether it is among the commonest of any."""
    of = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(languages)]
    wide = counted.groupBy(*by).agg(F.max(F.col("n") >= F.col("least")).alias("common"), *of)
    return materialize(wide, label, compression="zstd")


def train(docs: DataFrame, lang_col: str = "lang", keep=None, max_words: int = 30_000, max_grams: int = 10_000) -> Model:
    """Learn from the texts of ``docs`` with a language; ``keep`` is a
    condition on ``doc_id``."""
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                       F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    if keep is not None:
        rows = rows.filter(keep)
    counted = materialize(count_words(rows), "words", compression="zstd", batch_bytes=TEXT_BATCH)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("m")).toPandas().sort_values("lang")
    languages = totals["lang"].tolist()
    if not languages:
        return Model([], Common(np.zeros((0, 0)), {}, [{} for _ in range(LONGEST + 1)]), None, None)
    spelled = materialize(count_grams(counted), "grams", compression="zstd")
    gram_totals = spelled.groupBy("lang", "size").agg(F.sum("n").alias("n"), F.count("*").alias("m")).toPandas()
    words = by_language(with_least(counted, ["lang"], max_words), ["word"], languages, "word-counts")
    spelled = by_language(with_least(spelled, ["lang", "size"], max_grams), ["size", "gram"], languages, "gram-counts")

    smooth = 0.5

    def logs(below: list[Column]) -> list[Column]:
        """Log frequencies with ``smooth`` added to every count."""
        return [F.log((F.col(f"n{k}") + smooth) / d).alias(f"s{k}") for k, d in enumerate(below)]

    entries = float(totals["m"].max())
    words = words.select("word", "common", *logs([F.lit(float(n) + smooth * entries) for n in totals["n"]]))
    below = [F.lit(None).cast("double")] * len(languages)
    for size in range(1, LONGEST + 1):
        of = gram_totals[gram_totals["size"] == size].set_index("lang").reindex(languages)
        entries = float(of["m"].fillna(1).max())
        below = [F.when(F.col("size") == size, F.lit(float(n) + smooth * entries)).otherwise(b)
                 for n, b in zip(of["n"].fillna(0), below)]
    spelled = spelled.select("size", "gram", "common", *logs(below))

    score = [f"s{k}" for k in range(len(languages))]
    held = words.filter("common").drop("common").toPandas()
    held_grams = spelled.filter("common").drop("common").toPandas()
    tables, at = [held[score].to_numpy(float)], [{}]
    for size in range(1, LONGEST + 1):
        part, base = held_grams[held_grams["size"] == size], sum(map(len, tables))
        tables.append(part[score].to_numpy(float))
        at.append({g: base + k for k, g in enumerate(part["gram"])})
    of = gram_totals[gram_totals["size"] == FIT].set_index("lang").reindex(languages)
    most = float(of["m"].fillna(1).max())
    unmet = np.log(smooth / (of["n"].fillna(0).to_numpy(float) + smooth * most))
    common = Common(np.concatenate(tables), {w: k for k, w in enumerate(held["word"])}, at, unmet)
    return Model(languages, common, words.drop("common"), spelled.drop("common"))


def score_words(asked: DataFrame, model: Model, shared) -> DataFrame:
    """``(word, s0, s1, ...)`` of distinct words, from the tables. A word of
    which not even a letter was met is left out: it tells nothing."""
    score = [f"s{k}" for k in range(len(model.languages))]
    looked = materialize(asked.join(model.words, "word", "left"), "looked-up", compression="zstd")

    def spell(batches):
        common = shared.value
        for batch in batches:
            found = [(w, *row) for w in batch.column(0).to_pylist() for row in common.spell(w)]
            sums = np.array([x[4] for x in found]).reshape(len(found), len(score))
            yield pa.record_batch({"word": pa.array([x[0] for x in found], pa.string()),
                                   "size": pa.array([x[1] for x in found], pa.int32()),
                                   "gram": pa.array([x[2] for x in found], pa.string()),
                                   "hits": pa.array([x[3] for x in found], pa.int64()),
                                   **{c: pa.array(sums[:, k]) for k, c in enumerate(score)}})

    doubles = ", ".join(f"{c} double" for c in score)
    parts = materialize(looked.filter("s0 is null").select("word").mapInArrow(
        spell, f"word string, size int, gram string, hits long, {doubles}"), "spelled", compression="zstd")
    others = (parts.filter("gram != ''").select("word", "size", "gram").join(model.grams, ["size", "gram"])
              .select("word", "size", F.lit(1).cast("long").alias("hits"), *score))
    sums = (parts.filter("gram = ''").select("word", "size", "hits", *score).unionByName(others)
            .groupBy("word", "size").agg(F.sum("hits").alias("hits"), *[F.sum(c).alias(c) for c in score]))
    means = F.struct(*[(F.col(c) / F.col("hits")).alias(c) for c in score])
    longest = sums.groupBy("word").agg(F.max_by(means, "size").alias("best")).select("word", "best.*")
    return looked.filter("s0 is not null").unionByName(longest)


def predict(docs: DataFrame, model: Model, evidence: bool = False) -> DataFrame:
    """``(doc_id, text_hash, lang_pred, score)``: the likeliest language and its share
    of the likelihood. With ``evidence`` also ``fits``, the mean log frequency of
    the text's n-grams in each language (null without letters), and ``fit``, that
    of the language found."""
    spark = docs.sparkSession
    importable(spark)
    rows = pick(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    if not model.languages:
        nothing = [F.lit(None).cast("array<double>").alias("fits"), F.lit(None).cast("double").alias("fit")] if evidence else []
        return rows.select("doc_id", "text_hash", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), *nothing)
    shared = spark.sparkContext.broadcast(model.common)
    score = [f"s{k}" for k in range(len(model.languages))]

    def apply(batches):
        common, task, n = shared.value, TaskContext.get().partitionId(), 0
        for batch in batches:
            # A few texts at a time: what a step holds goes with their words.
            for a, b in pieces.runs(batch.column(2), RUN):
                part = batch.slice(a, b - a)
                words = [Counter(WORD.findall(t.lower())) if t else Counter() for t in part.column(2).to_pylist()]
                found = [common.known(w) for w in words]
                sums = np.array([x for x, _ in found]).reshape(len(found), len(score))
                more = {}
                if evidence:
                    total, count = common.fit(words)
                    more = {"grams": pa.array(count), **{f"f{k}": pa.array(total[:, k]) for k in range(len(score))}}
                yield pa.record_batch({
                    **more, "row": pa.array(np.arange(n, n + len(found)) + (task << 40), pa.int64()),
                    "doc_id": part.column(0), "text_hash": part.column(1), "any": pa.array([bool(w) for w in words], pa.bool_()),
                    **{c: pa.array(sums[:, k]) for k, c in enumerate(score)},
                    "rest": pa.array([list(r.items()) for _, r in found], pa.map_(pa.string(), pa.int64()))})
                n += len(found)

    doubles = ", ".join(f"{c} double" for c in score)
    fits = "grams long, " + ", ".join(f"f{k} double" for k in range(len(score))) + ", " if evidence else ""
    # Written once: row numbers and what is handed on belong together.
    read = materialize(rows.mapInArrow(apply, fits + f"row long, doc_id long, text_hash long, any boolean, {doubles}, "
                                              "rest map<string,bigint>"), "language-rows", compression="zstd", batch_bytes=TEXT_BATCH)
    rest = read.select("row", F.explode("rest").alias("word", "n"))
    scored = score_words(rest.select("word").distinct(), model, shared)
    more = (rest.join(scored, "word").groupBy("row")
            .agg(*[F.sum(F.col("n") * F.col(c)).alias(f"more_{c}") for c in score]))
    total = F.array(*[F.col(c) + F.coalesce(f"more_{c}", F.lit(0.0)) for c in score])
    best = F.array_max("total")
    share = 1.0 / F.aggregate(F.transform("total", lambda x: F.exp(x - best)), F.lit(0.0), lambda a, x: a + x)
    at = (F.array_position("total", best) - 1).cast("int")
    first = F.get(F.array(*map(F.lit, model.languages)), at)
    fits = F.when(F.col("any"), F.array(*[F.col(f"f{k}") / F.col("grams") for k in range(len(score))]))
    fit = [fits.alias("fits")] if evidence else []
    out = read.drop("rest").join(more, "row", "left").select("doc_id", "text_hash", "any", total.alias("total"), *fit)
    return out.select("doc_id", "text_hash", F.when(F.col("any"), first).otherwise(UNDETERMINED).alias("lang_pred"),
                      F.when(F.col("any"), share).otherwise(0.0).alias("score"),
                      *(["fits", F.get("fits", at).alias("fit")] if evidence else []))


def least_fits(found: DataFrame, labelled: DataFrame, model: Model) -> dict[str, float]:
    """By language, the fit below which a text is of none that training has.
    ``found`` has the evidence, ``labelled`` ``(doc_id, text_hash, lang)``. With
    texts of one language alone, an n-gram that was never met takes the place of
    the other languages."""
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"l.{k}")) for k in ("doc_id", "text_hash")]
    told = found.filter("fits is not null").alias("f").join(
        labelled.filter("lang is not null").distinct().alias("l"), same[0] & same[1]).select(
        F.col("l.lang").alias("lang"), F.posexplode("f.fits").alias("k", "fit"))
    of = F.get(F.array(*map(F.lit, model.languages)), F.col("k")) if model.languages else F.lit(None)
    middle = lambda c: F.percentile_approx(F.when(c, F.col("fit")), 0.5, 10_000)
    rows = told.groupBy("k").agg(middle(F.col("lang") == of).alias("own"), middle(F.col("lang") != of).alias("other")).collect()
    return {model.languages[r.k]: (r.own + (model.common.unmet[r.k] if r.other is None else r.other)) / 2
            for r in rows if r.own is not None}   # a row per language
