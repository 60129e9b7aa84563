"""Quality rules: an ordered list of threshold conjunctions learned from
labelled statistics.

``statistics`` measures every whole text. ``learn`` is sequential covering on
labelled statistics: it *grows* a rule for label 0 on one part of the rows,
adding the threshold test with the greatest information gain until the rule
covers no row of label 1 (or nothing is gained), *prunes* it on the other part
by dropping last tests while that helps, keeps it if it is precise enough
there, removes the rows it covers and starts again (an imprecise rule is dropped). The list becomes one
ordered Spark conditional expression (``verdict``), so applying it is a
projection.

The rules are fitted on at most ``fit_rows`` labelled rows, chosen by a hash of
the id (a documented bound); statistics cover all rows.

Null and empty texts have no words; ratios of nothing are 0. Rows with a null
statistic never meet a test, since there is none. Very long texts are measured
whole, one at a time. Of tests with equal gains the first by name, side and
threshold is taken. Without rows of both labels no rule is learned. Equal rows
have equal statistics, and each has its verdict; an id with several labels
teaches each. An empty table gives an empty result. Columns other than those
named are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantbeam.llm.base import bounded_sample, importable, pick
from quantbeam.session import TEXT_BATCH, materialize

# Characters counted as symbols, and those that part words.
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\t\n\v\f\r "

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_letters",
          "n_upper", "n_digits", "longest_word")
STATISTICS = "doc_id long, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS)

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS)] = True
IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[ord("0"):ord("9") + 1] = True


def repeated_words(words: list[bytes], n: int = 3) -> tuple[int, int]:
    """Words inside ``n``-word windows that occur twice or more, and distinct
    words."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(ids) < n:
        return 0, len(number)
    window = ids[:len(ids) - n + 1]
    for k in range(1, n):
        # Renumbering keeps the products small for any vocabulary.
        _, window = np.unique(window * len(number) + ids[k:len(ids) - n + 1 + k], return_inverse=True)
    often = np.bincount(window)[window] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(n):
        inside[k:len(ids) - n + 1 + k] |= often
    return int(inside.sum()), len(number)


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    octets = np.frombuffer(raw, np.uint8)
    words = raw.split()
    repeat, distinct = repeated_words(words)
    points = int(((octets & 0xC0) != 0x80).sum())
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    low = text.lower()
    upper = sum(a != b for a, b in zip(text, low)) if len(low) != len(text) else _changed(text, low)
    letters = points - int((octets < 0x80).sum()) + int(_ASCII_LETTER[octets].sum())
    return (len(words), points - int(IS_BLANK[octets].sum()), int(IS_SYMBOL[octets].sum()), dup, repeat, distinct, lines,
            letters, upper, int(IS_DIGIT[octets].sum()), max(map(len, words), default=0))


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[ord("A"):ord("Z") + 1] = True
_ASCII_LETTER[ord("a"):ord("z") + 1] = True


def _changed(a: str, b: str) -> int:
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    return int((x != y).sum())


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, a hash of the text and ``COUNTS``. Letters are ASCII letters and all characters
    beyond ASCII; upper-case ones are those that lower-casing changes."""
    importable(docs.sparkSession)

    def apply(batches):
        for batch in batches:
            table = np.array([measure(t) for t in batch.column(2).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.record_batch([batch.column(0), batch.column(1), *map(pa.array, table.T)], names=["doc_id", "text_hash", *COUNTS])

    return pick(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(apply, STATISTICS)


def ratio(a: str, b: str) -> Column:
    """``a / b`` as a double; 0 if there is no ``b``."""
    return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(0.0)


def measures() -> dict[str, Column]:
    """What rules test, by name: expressions over the counts."""
    return {
        "repeat_share": ratio("n_repeat_words", "n_words"),
        "distinct_share": ratio("n_distinct", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "upper_share": ratio("n_upper", "n_letters"),
        "digit_share": ratio("n_digits", "word_chars"),
        "letter_share": ratio("n_letters", "word_chars"),
        "mean_word_chars": ratio("word_chars", "n_words"),
        "longest_word": F.col("longest_word").cast("double"),
    }


@dataclass(frozen=True)
class Test:
    """``measure >= threshold`` or, if not ``above``, ``measure < threshold``."""
    measure: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.measure] >= self.threshold if self.above else x[self.measure] < self.threshold

    def column(self, exprs: dict[str, Column]) -> Column:
        e = exprs[self.measure]
        return e >= F.lit(self.threshold) if self.above else e < F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """A conjunction, and its precision and reach on the pruning rows."""
    tests: tuple[Test, ...]
    precision: float
    covered: int

    def __str__(self) -> str:
        return " and ".join(f"{t.measure} {'>=' if t.above else '<'} {t.threshold:.6g}" for t in self.tests)


def covered(tests: list[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in tests:
        out &= t.holds(x)
    return out


def best_test(x: dict[str, np.ndarray], bad: np.ndarray, cuts: int = 128) -> tuple[float, Test | None]:
    """The test with the greatest gain p * (log p/(p+n) - log P/(P+N)) among
    thresholds half-way between neighbouring values."""
    base = np.log2(max(bad.mean(), 1e-12))
    top: tuple[float, Test | None] = (0.0, None)
    for name in sorted(x):
        values = np.unique(x[name])
        if len(values) < 2:
            continue
        middle = (values[1:] + values[:-1]) / 2
        # Where the two labels meet, a gap's middle is the safest threshold.
        if len(middle) > cuts:
            edges = np.quantile(x[name][bad], [0, 0.01, 0.02, 0.05]).tolist() + np.quantile(
                x[name][~bad], [0, 0.01, 0.02, 0.05, 0.95, 0.98, 0.99, 1]).tolist() if (~bad).any() else []
            pick_at = np.searchsorted(middle, np.quantile(x[name], np.linspace(0, 1, cuts)))
            edge_at = np.searchsorted(middle, edges)
            at = np.concatenate([pick_at, edge_at, edge_at - 1]).astype(int)
            middle = middle[np.unique(np.clip(at, 0, len(middle) - 1))]
        order = np.argsort(x[name], kind="stable")
        below = np.searchsorted(x[name][order], middle, side="left")
        bad_below = np.concatenate([[0], np.cumsum(bad[order])])[below]
        for above, p, n in ((False, bad_below, below - bad_below),
                            (True, bad.sum() - bad_below, len(bad) - bad.sum() - (below - bad_below))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > top[0] + 1e-9:
                top = (float(gain[k]), Test(name, above, float(middle[k])))
    return top


def grow(x: dict[str, np.ndarray], bad: np.ndarray, max_tests: int) -> list[Test]:
    tests: list[Test] = []
    inside = np.ones(len(bad), bool)
    while len(tests) < max_tests and (~bad[inside]).any():
        gain, test = best_test({k: v[inside] for k, v in x.items()}, bad[inside])
        if test is None:
            break
        tests.append(test)
        inside &= test.holds(x)
    return tests


def prune(tests: list[Test], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Test]:
    """The shortest start of the rule with the best (p - n) / (p + n)."""
    def worth(k: int) -> float:
        inside = covered(tests[:k], x, len(bad))
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return float(p - n) / (p + n) if p + n else -1.0
    return tests[:max(range(1, len(tests) + 1), key=lambda k: (worth(k), -k))] if tests else tests


def learn(x: dict[str, np.ndarray], bad: np.ndarray, grow_rows: np.ndarray, max_rules: int = 16, max_tests: int = 4,
          min_precision: float = 0.97, min_covered: int = 3) -> list[Rule]:
    """Sequential covering. ``bad`` marks label 0, ``grow_rows`` the rows to
    grow on; the others prune."""
    rules: list[Rule] = []
    tries = 0
    left = np.ones(len(bad), bool)
    while len(rules) + tries < max_rules:
        g, p = left & grow_rows, left & ~grow_rows
        if not bad[g].any() or not bad[p].any():
            break
        tests = grow({k: v[g] for k, v in x.items()}, bad[g], max_tests)
        tests = prune(tests, {k: v[p] for k, v in x.items()}, bad[p])
        if not tests:
            break
        inside = covered(tests, x, len(bad))
        on_prune = inside & p
        reach = int(on_prune.sum())
        precision = float(bad[on_prune].mean()) if reach else 0.0
        if precision >= min_precision and int(bad[on_prune].sum()) >= min_covered:
            rules.append(Rule(tuple(tests), precision, reach))
            left &= ~inside
        else:
            # Not to be trusted: leave its rows of label 0 out and look on.
            tries += 1
            left &= ~(inside & bad)
    return rules


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = 20_000, **how) -> list[Rule]:
    """Learn rules from labelled rows of ``stats``."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = stats.join(y.filter(F.col("y").isin(0, 1)), "doc_id")
    exprs = measures()
    # At most fit_rows rows of a few numbers reach the driver.
    data = (bounded_sample(rows, "doc_id", fit_rows)
            .select("doc_id", "y", *[e.alias(k) for k, e in exprs.items()])).toPandas()
    if data.empty or data["y"].nunique() < 2:
        return []
    data = data.sort_values(["doc_id", *exprs], kind="stable")
    mixed = (data["doc_id"].to_numpy(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return learn({k: data[k].to_numpy(float) for k in exprs}, data["y"].to_numpy() == 0, mixed % np.uint64(3) != 0, **how)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as a column: the number of the first rule that a row
    meets (from 1), 0 if none does."""
    exprs, out = measures(), None
    for k, rule in enumerate(rules, 1):
        met = F.lit(True)
        for t in rule.tests:
            met = met & t.column(exprs)
        out = F.when(met, F.lit(k)) if out is None else out.when(met, F.lit(k))
    return out.otherwise(F.lit(0)) if out is not None else F.lit(0)


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, **how) -> DataFrame:
    """``doc_id``, ``text_hash``, the counts, ``base_failed``, ``rule`` (0: none) and
    ``kept``. The base rule stands beside the learned ones."""
    stats = materialize(statistics(docs), "statistics", batch_bytes=TEXT_BATCH)
    rules = fit(stats, labels, **how)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
