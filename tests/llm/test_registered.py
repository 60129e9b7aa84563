"""The registered queries without SQL, run on the smallest tables and held
against plain versions of their contracts."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantbeam.llm import near_duplicates, quality_rules, queries
from tests.llm.test_operators import library

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_op1_files_hold_all_ids_in_order(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op1_token_files(spark, DIR).collect()}
    at, want = 0, {}
    for i in sorted(texts):
        ids = [*library(texts[i]), 0]
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    assert got == want


def test_op2_folds_and_verdicts(spark, texts):
    rows = queries.op2_toxicity(spark, DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    insults = re.compile(r"\b(trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)\b")
    plain = {i for i, t in texts.items() if t and len(insults.findall(t.lower())) >= 3}
    assert len(plain & {r.doc_id for r in rows if r.predicted}) >= 0.8 * len(plain) > 0


def pairs_at(texts, size, threshold):
    """All pairs of texts at the threshold, by the shingles that they share."""
    held = {i: near_duplicates.shingles(t) for i, t in texts.items()}
    by_shingle = collections.defaultdict(list)
    for i, (e, _) in held.items():
        for x in e.tolist():
            by_shingle[x].append(i)
    met = {(a, b) for ids in by_shingle.values() for a in ids for b in ids if a < b}
    same = {(a, b) for a in texts for b in texts if a < b and texts[a] == texts[b]}
    return same | {p for p in met if near_duplicates.similarity(held[p[0]], held[p[1]]) >= threshold}


def test_op3_recall_is_whole_and_nothing_else_is_joined(spark, texts):
    got = {r.doc_id: (r.class_id, r.text_class) for r in queries.op3_near_duplicates(spark, DIR).collect()}
    links, root = pairs_at(texts, 5, 0.8), {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in sorted(links):
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert len(links) >= 10 and {i: c for i, (c, _) in got.items()} == {i: top(i) for i in texts}
    least = {}
    for i in sorted(texts):
        least.setdefault(texts[i], i)
    assert {i: c for i, (_, c) in got.items()} == {i: least[t] for i, t in texts.items()}


def test_op6_folds_and_languages(spark, texts):
    rows = {r.doc_id: r for r in queries.op6_language(spark, DIR).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang").collect()}
    learned = {g for i, g in lang.items() if g and fold(i, 3) != 1}
    assert set(rows) == set(texts) and all(r.held_out == (fold(i, 3) == 1) for i, r in rows.items())
    assert all(r.lang_pred in learned | {"und"} and 0 <= r.score <= 1 for r in rows.values())
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", texts[i] or "")) for i, r in rows.items())
    out = [i for i, r in rows.items() if r.held_out and lang[i] and r.lang_pred != "und"]
    assert sum(rows[i].lang_pred == lang[i] for i in out) >= 0.9 * len(out) > 0


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def plain_failed(n_words, n_repeat):
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def test_op8_counts_and_base_rule(spark, texts):
    rows = queries.op8_quality_rules(spark, DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == plain_failed(n[0], n[4])
        assert r.kept == (not r.base_failed and r.rule == 0)


def test_judge_against_a_plain_version(spark):
    """Learned rules, read as text, decide as the expression does; with nulls,
    repeated rows and ids, unlabelled rows, long texts and clashing names."""
    import random
    rnd = random.Random(41)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9)))
    good = lambda n: " ".join(word() for _ in range(n))
    rows = [(k, good(rnd.randrange(55, 90))) for k in range(120)]
    rows += [(200 + k, " ".join(word() + "##" for _ in range(60))) for k in range(60)]
    rows += [(300 + k, " ".join(str(rnd.randrange(10 ** 6)) for _ in range(60))) for k in range(60)]
    rows += [(None, None), (400, None), (401, ""), (402, "too short"), (403, "again and again " * 30), (404, good(30_000)),
             (None, good(60)), rows[0], rows[0], (1, good(70)), (405, good(60) + "\n" + good(4) + "\n" + "## " * 90)]
    docs = spark.createDataFrame([(*r, 1, "x", 0.5, True) for r in rows],
                                 "doc_id long, text string, n_words int, rule string, repeat_share double, kept boolean")
    labels = [(i, int(i < 200)) for i, t in rows if i is not None and i < 400] + [(401, 0), (402, None), (None, 1), (999, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    judged = quality_rules.judge(docs, marks).collect()
    rules = quality_rules.fit(quality_rules.statistics(docs), marks)
    assert rules and len(judged) == len(rows)
    names = {t.measure for r in rules for t in r.tests}
    assert names <= set(quality_rules.measures())

    def measured(text):
        n = dict(zip(quality_rules.COUNTS, quality_rules.measure(text)))
        share = lambda a, b: n[a] / n[b] if n[b] else 0.0
        return {"repeat_share": share("n_repeat_words", "n_words"), "distinct_share": share("n_distinct", "n_words"),
                "symbols_per_word": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
                "upper_share": share("n_upper", "n_letters"), "digit_share": share("n_digits", "word_chars"),
                "letter_share": share("n_letters", "word_chars"), "mean_word_chars": share("word_chars", "n_words"),
                "longest_word": float(n["longest_word"])}

    def first_rule(text):
        x = measured(text)
        for k, r in enumerate(rules, 1):
            if all((x[t.measure] >= t.threshold) == t.above for t in r.tests):
                return k
        return 0

    want = collections.Counter()
    for i, t in rows:
        n = plain_counts(t)
        failed, rule = plain_failed(n[0], n[4]), first_rule(t)
        want[(i, *n, failed, rule, not failed and rule == 0)] += 1
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                               r.rule, r.kept) for r in judged)
    assert got == want
    kept = collections.Counter(r.doc_id for r in judged if r.kept)
    assert all(kept[k] for k in range(120)) and not any(kept[k] for k in range(200, 360))


def test_op9_pieces_make_up_all_ids(spark, texts):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op9_packing(spark, DIR).collect():
        by_doc[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        ids, at = [*library(texts[i]), 0], 0
        for start, length, digest, total in sorted(parts):
            assert (start, total, digest) == (at, len(ids), crc(ids[start:start + length]))
            at += length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    used = sum(n for parts in by_sequence.values() for _, n in parts)
    assert used >= 0.95 * 1024 * len(by_sequence)


def test_op10_counts(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_token_counts(spark, DIR).collect()}
    want = {i: (len((t or "").encode()), n := len(library(t)), n > 512) for i, t in texts.items()}
    assert got == want


def test_held_out_flags_agree_with_the_expression(spark):
    from quantbeam.llm.base import fold as column
    rows = spark.range(50).select("id", column(F.col("id"), 5).alias("a"), column(F.col("id"), 3).alias("b")).collect()
    assert all((r.a, r.b) == (fold(r.id, 5), fold(r.id, 3)) for r in rows)
