"""Periodic runs, hard negatives and BPE coding against plain versions, with
nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names."""

import collections
import math
import random

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from quantbeam.llm import bpe_codec, hard_negatives, periodic_runs, queries

WORDS = public_tokenizers.path("word_bpe_49k.json")
#: Names that the operators use for columns of their own.
SCHEMA = "doc_id long, text string, text_hash string, words string, runs int, ids string, n_tokens string, period long"


def rows_of(texts):
    return [(k, t, "x", "y", 1, "z", "n", 5) for k, t in texts]


def plain_runs(words, min_words=6, min_exponent=4):
    """By definition: every stretch of equal words each distance apart."""
    found, n = {}, len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(min_words, min_exponent * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((s, q, length) for (s, length), q in found.items())


def repetitive(rnd, n):
    words = [rnd.choice(rnd.choice(["a", "ab", "abc", "abcdefgh"])) for _ in range(n)]
    for _ in range(rnd.randrange(4) if n else 0):
        a = rnd.randrange(n)
        p = rnd.randrange(1, max(2, (n - a) // 3))
        for i in range(a, rnd.randrange(a, n + 1)):
            words[i] = words[a + (i - a) % p]
    return words


def test_tiles_find_every_run():
    rnd = random.Random(11)
    for _ in range(1500):
        words = repetitive(rnd, rnd.randrange(rnd.choice([10, 40, 200])))
        codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1].astype(np.int32)
        stretches = collections.defaultdict(list)
        for octave, boundaries in periodic_runs.live_boundaries(codes, 4):
            span = 2 << octave
            for b in boundaries.tolist():
                low = max(0, b - span)
                part = codes[low:b + 3 * span].tolist()
                for q, left, right in periodic_runs.solve(part, b - low, octave, 4):
                    stretches[q].append((b - left, b + right))
        found = set()
        for q, parts in stretches.items():
            merged = []
            for a, b in sorted(parts):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            found |= {(a, q, b - a + q) for a, b in merged if b - a + q >= max(6, 4 * q)}
        assert sorted(found) == plain_runs(words), words


def test_runs_of_documents(spark):
    rnd = random.Random(12)
    long = " ".join(rnd.choice("abcdefgh") for _ in range(700)) + " "
    texts = [(k, " ".join(repetitive(rnd, rnd.randrange(120)))) for k in range(40)]
    texts += [(None, "x y " * 9), (None, None), (50, None), (51, ""), (52, " \n\t"), (53, "a\x0bb\x0ca b a b\ta\rb  a b"),
              (54, "é é " * 8), (7, "same id " * 5), (60, "twice " * 7), (60, "twice " * 7), (61, "w " * 5000),
              (62, long * 6 + "z"), (63, "a b a b a b a b b b b b b b")]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = periodic_runs.collapse_runs(docs).collect()
    assert len(got) == len(texts)
    want = []
    for k, text in texts:
        words = periodic_runs.split_words(text)
        runs = plain_runs(words) if len(words) < 1000 else None
        if runs is None:
            runs = [(0, 1, 5000)] if k == 61 else [(0, 700, 4200)]
            runs = sorted({*runs, *((s + 700 * j, q, n) for j in range(6) for s, q, n in plain_runs(words[:1400])
                                    if k == 62 and s < 700 and q < 300)})
        dropped = {i for s, q, n in runs for i in range(s + q, s + n)}
        top = max(runs, key=lambda r: (r[2] / r[1], -r[0], -r[1]), default=None)
        want.append((k, len(words), [(s, n, q) for s, q, n in runs], top and (top[0], top[2], top[1]),
                     b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()))
    have = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.top and tuple(r.top), r.collapsed) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted(have, key=key) == sorted(want, key=key)


def test_exponents_tie_by_start_then_period():
    assert periodic_runs._greater({"start": 0, "length": 8, "period": 2}, {"start": 3, "length": 4, "period": 1})
    assert not periodic_runs._greater({"start": 3, "length": 4, "period": 1}, {"start": 0, "length": 8, "period": 2})
    assert periodic_runs._greater({"start": 1, "length": 8, "period": 1}, {"start": 1, "length": 16, "period": 2})


def test_runs_of_an_empty_table(spark):
    assert periodic_runs.collapse_runs(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (16, 64, 33), (40, 37, 90), (65, 64, 129), (0, 4, 5), (3, 0, 5)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rnd = np.random.default_rng(sum(shape))
    a, b = rnd.integers(-2 ** 28, 2 ** 28, (m, k)), rnd.integers(-2 ** 28, 2 ** 28, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()


def plain_negatives(rows, positives=5, negatives=3, low=50, high=95):
    taken = []
    for row, (vec_id, vector, label) in enumerate(rows):
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taken.append((row, vec_id, label, [math.floor(256 * x) for x in vector]))
    found = []
    for row, vec_id, label, v in taken:
        if vec_id % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, l, r) for r, i, l, w in taken]
        for p, pid, _, _ in sorted(s for s in scored if s[2] == label and s[3] != row)[:positives]:
            inside = sorted(s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p)
            found += [(vec_id, pid, k, s[1], -p, -s[0]) for k, s in enumerate(inside[:negatives], 1)]
    return sorted(found)


VECTORS = "vec_id long, embedding array<float>, label int, row string, codes string, cell int, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], VECTORS)


def test_negatives_equal_the_definition(spark):
    rnd = random.Random(13)
    some = lambda: [float(np.float32(rnd.choice([-1, 0, 0.25, 0.5, 1]) + rnd.random() / 50)) for _ in range(9)]
    rows = [(k, some(), rnd.randrange(3)) for k in range(0, 420, 2)]
    rows += [(k, [0.5] * 9, k % 2) for k in range(501, 560)]                      # ties
    rows += rows[:30]                                                            # repeated, an anchor among them
    rows += [(None, some(), 1), (600, None, 1), (650, some(), None), (700, [0.5, None], 1), (750, [float("nan")] * 9, 1),
             (800, [float("inf")] * 9, 1), (850, [0.5, 0.5], 1), (851, [], 0), (900, [-0.5] * 9, 2), (950, [], 1)]
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 50 == 0, block_rows=8, chunk_blocks=2)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == names
    want = plain_negatives(rows)
    assert sorted(map(tuple, got.collect())) == want
    whole = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, whole.collect())) == want


def test_negatives_of_no_rows_and_of_no_anchor(spark):
    assert hard_negatives.mine(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.mine(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)]), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.mine(vectors(spark, [(50, [1.0], 1)]), F.col("vec_id") % 50 == 0).count() == 0


def test_components_too_large_are_refused(spark):
    with pytest.raises(ValueError):
        hard_negatives.mine(vectors(spark, [(50, [1e9], 1), (1, [1.0], 1)]), F.col("vec_id") % 50 == 0)
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(vectors(spark, [(50, [1e30], 1), (1, [1.0], 1)]), F.col("vec_id") % 50 == 0)


def library(text):
    found = bpe_codec.shared(WORDS).library.encode(text or "", add_special_tokens=False)
    return found.ids


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_bpe_equals_the_library_on_made_words():
    rnd, codec = random.Random(14), bpe_codec.Codec(WORDS, max_pieces=50)
    for _ in range(1500):
        word = "".join(rnd.choice("aabnsteihor"[:rnd.randrange(1, 12)]) for _ in range(rnd.randrange(1, 60)))
        assert ids_of(codec, word) == library(word), word


def test_bpe_of_every_known_character():
    codec = bpe_codec.shared(WORDS)
    for c in map(chr, [*range(0x400), 0x3A3, 0x1E9E, 0x212B, 0x2028, 0x3000, 0x4E2D, 0xFB01, 0x1F600, 0x1D7D9]):
        text = f"a{c}1{c}{c} {c}b'S<|endoftext|>A{c}x"
        assert ids_of(codec, text) == library(text), repr(c)


def test_merges_that_a_token_does_not_survive():
    """'abc' is made of 'ab' and 'c', but 'bc' comes first: no text ends in it."""
    shown = bpe_codec.byte_characters()
    vocab = {c: k for k, c in enumerate(shown)} | {"bc": 256, "ab": 257, "abc": 258, "aa": 259, "aaa": 260}
    bpe = bpe_codec.Bpe({"type": "BPE", "vocab": vocab, "merges": ["b c", "a b", "ab c", "a a", "aa a"]})
    a = vocab["a"]
    assert bpe.ids(b"abc").tolist() == [a, 256]
    assert list(bpe.ids(b"aaaaaaaa")) == plain_bpe("aaaaaaaa", vocab)
    rnd = random.Random(3)
    for _ in range(500):
        text = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 14)))
        assert list(bpe.ids(text.encode())) == plain_bpe(text, vocab), text


def plain_bpe(text, vocab):
    """The merges one after another, the first place first."""
    parts = list(text)
    ranks = {("b", "c"): 0, ("a", "b"): 1, ("ab", "c"): 2, ("a", "a"): 3, ("aa", "a"): 4}
    while True:
        known = [(ranks[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not known:
            return [vocab[p] for p in parts]
        _, k = min(known)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


def test_documents_round_trip(spark):
    rnd = random.Random(15)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "'RE", "é", "É", "ß", "İ", "Σ", "5", "12", "!?", "<|endoftext|>",
                "<|startoftext|", "中文", " ", "\x1c", "Straße", "the", "ING"]
    texts = [(k, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60)))) for k in range(60)]
    texts += [(None, None), (None, "no id"), (70, None), (71, ""), (72, "   "), (60, "twice"), (60, "twice"),
              (73, "x" * 70_000), (74, "".join(rnd.choice("etaoinshr") for _ in range(70_000))), (75, "two words " * 20_000)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = bpe_codec.decode(bpe_codec.encode(docs, WORDS), WORDS).collect()
    tokenizer = bpe_codec.shared(WORDS).library
    want = [(k, (ids := library(t)), tokenizer.decode(ids, skip_special_tokens=False)) for k, t in texts]
    have = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(have, key=key) == sorted(want, key=key)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_coding_of_an_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe_codec.decode(bpe_codec.encode(empty, WORDS), WORDS).count() == 0
    rows = spark.createDataFrame([(1, 0, None), (2, 1, bytearray(b"\xff\xff\xff\x7f"))], bpe_codec.ENCODED)
    assert [r.decoded for r in bpe_codec.decode(rows, WORDS).collect()] == ["", ""]


def test_registered_coding_equals_the_library(spark):
    import hashlib
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op13_bpe_codec(spark, folder).collect()}
    tokenizer = bpe_codec.shared(WORDS).library
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = library(r.text)
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id][1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                     hashlib.sha256(text.encode()).hexdigest())
