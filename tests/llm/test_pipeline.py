"""The pipeline against a plain version over all pairs and places, and its
stages on empty tables and nulls."""

import collections
import os
import random
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from quantbeam.llm import near_duplicates  # noqa: E402
from quantbeam.llm import language  # noqa: E402
from tests.llm.test_operators import library, plain_hits, plain_language  # noqa: E402

SCHEMA = "doc_id long, text string, lang string"


def plain_quality(text):
    w = (text or "").split()
    tri = list(zip(w, w[1:], w[2:]))
    n = collections.Counter(tri)
    inside = {j for k, t in enumerate(tri) if n[t] > 1 for j in (k, k + 1, k + 2)}
    # Texts full of symbols are the ones that the labels mark, far from all others.
    return len(w) >= 50 and 2 * len(inside) <= len(w) and (text or "").count("#") < len(w)


def plain_told(rows):
    """Texts that are in a language of the labelled rows, by all counts."""
    find, counts = language.WORD.findall, collections.defaultdict(collections.Counter)
    spelled = lambda t: [g for w in find((t or "").lower()) for g in language.grams(w, 3)]
    for _, t, g in rows:
        if g:
            counts[g].update(spelled(t))
    langs = sorted(counts)
    most = max(map(len, counts.values()))

    def fit(t, g):
        c = counts[g]
        return float(np.mean([np.log((c[x] + 0.5) / (sum(c.values()) + 0.5 * most)) for x in spelled(t)]))

    texts = {(i, t, g) for i, t, g in rows if g and find((t or "").lower())}
    middle = lambda x: sorted(x)[(len(x) + 1) // 2 - 1]
    least = {g: (middle([fit(t, g) for _, t, h in texts if h == g]) + middle([fit(t, g) for _, t, h in texts if h != g])) / 2
             for g in langs}
    seen = [(t, g) for _, t, g in rows]
    told = set()
    for t in {t for _, t, _ in rows}:
        lang = plain_language(seen, t)[0]
        if lang != "und" and fit(t, lang) >= least[lang]:
            told.add(t)
    return told


def plain_heads(rows):
    """One row of each group of near duplicates: the one of the least id."""
    root, sets = list(range(len(rows))), [near_duplicates.shingles(t) for _, t, _ in rows]
    top = lambda x: x if root[x] == x else top(root[x])
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or near_duplicates.similarity(sets[i], sets[j]) >= 0.8:
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = collections.defaultdict(list)
    for k, row in enumerate(rows):
        groups[top(k)].append(row)
    return [min(g, key=lambda r: (r[0] is not None, r[0] or 0)) for g in groups.values()]


def fixture(rnd):
    vocabulary = {g: ["".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 8))) for _ in range(400)]
                  for g, letters in (("en", "abcdefghij"), ("de", "ghijklmnop"))}
    made = lambda g, n: [rnd.choice(vocabulary[g]) for _ in range(n)]
    bench = [(k, " ".join(made("en", 20))) for k in range(5)]
    rows = [(k, " ".join(made(g, rnd.randrange(40, 120))), g) for k, g in enumerate(rnd.choices(["en", "de"], k=60))]
    long = [r for r in rows if len(r[1].split()) >= 60]
    for k, (_, text, g) in enumerate(long[:12]):  # near copies, some of them too far off
        w = text.split()
        for _ in range(k % 6):
            w[rnd.randrange(len(w))] = "new" + "ab"[k % 2]
        rows.append((100 + k, " ".join(w), g))
    rows += [(120 + k, long[12 + k][1], "en") for k in range(4)] + rows[:2]
    for k in range(5):  # contaminated, and with a hit of too small a share
        rows += [(130 + k, " ".join([*made("en", 40), bench[k][1], *made("en", 30)]), "en"),
                 (140 + k, " ".join([*made("en", 300), *bench[k][1].split()[:13], *made("en", 300)]), "en")]
    rows += [(150, None, "en"), (151, "", "de"), (152, "too short", "en"), (153, "again and again " * 30, "en"),
             (154, " ".join(str(rnd.randrange(9999)) for _ in range(80)), "en"), (155, " ".join(made("de", 70)), None),
             (None, " ".join(made("en", 70)), "en")]
    for k in range(10):  # gibberish, labelled or not, and a language that no label names
        other = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 8))) for _ in range(80))
        rows += [(200 + 4 * k + j, " ".join(w + "##" for w in made(("en", "de")[j % 2], rnd.randrange(50, 90))), "en")
                 for j in range(4)]
        rows += [(160 + k, other("abcdefghijklmnopqrstuvwxyz"), "en" if k < 3 else None), (170 + k, other("rstuvwxyz"), None)]
    return rows, bench


def test_equals_a_plain_pipeline(spark, tmpdir_path):
    rows, bench = fixture(random.Random(21))
    spark.createDataFrame([(*r, "a", "b", 3) for r in rows], SCHEMA + ", keep_id string, Keep_Text string, fit int"
                          ).write.parquet(tmpdir_path + "/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(tmpdir_path + "/benchmark.parquet")
    labels = [(i, int("#" not in t), 0) for i, t, _ in rows if i is not None and t and (i < 60 or i >= 200)]
    spark.createDataFrame([*labels, (None, 1, 0), (61, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        tmpdir_path + "/labels.parquet")
    after = [rows]
    after.append([r for r in after[-1] if plain_quality(r[1])])
    told = plain_told(after[-1])
    assert not told & {t for i, t, _ in rows if i is not None and 160 <= i < 180}
    after.append([r for r in after[-1] if r[1] in told])
    after.append(plain_heads(after[-1]))
    hits = {r: plain_hits(r[1], bench, 13) for r in after[-1]}
    after.append([r for r in after[-1] if not (hits[r][1] > 0 and 20 * hits[r][1] >= hits[r][0])])
    assert all(len(a) > len(b) for a, b in zip(after, after[1:]))  # each stage has something to reject
    want = collections.Counter((i, *library(t), 0) for i, t, _ in after[-1])
    pieces = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, tmpdir_path).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(pieces) == {w[0] for w in want} and set(want.values()) == {1}
    for doc_id, *ids in want:
        at = 0
        for start, length, crc, total in sorted(pieces[doc_id]):
            assert (start, total) == (at, len(ids))
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)


def test_stages_on_empty_tables_and_nulls(spark, tmpdir_path):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(tmpdir_path + "/benchmark.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(tmpdir_path + "/labels.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(1, None, None), (2, None, "en")], SCHEMA)
    kept = {"quality rules": 0, "language ID": 0, "near duplicates": 1, "decontamination": 2, "packing": 2}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tmpdir_path).count() == 0, name
        got = stage(spark, nulls, tmpdir_path)
        assert got.count() == kept[name], name
        assert name == "packing" or got.columns == nulls.columns
