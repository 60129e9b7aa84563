"""The training-data operators against plain versions, on small fixtures with
nulls, empty texts, repeated rows, ties and columns of clashing names."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from quantbeam.llm import (decontamination, language, license_scan, near_duplicates, packing, pieces, quality_rules,
                           sharding, token_counts, token_files, toxicity)

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, node string, w string, key long"
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "'", "s", "'re", "é", "ß", "²", "5", "12", ",", "!", "<|endoftext|>", "中",
            "xxxxx", "_", "İ", "don't", "\x85", "\xa0", "'ll", "\x1c", "ŀ", "ƀ"]


def made(rnd, n):
    return "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(n)))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(5)
    rows = [(k, made(rnd, 80), "en", "x", "y", 1) for k in range(40)]
    rows += [(None, None, None, None, None, None), (50, None, "en", "x", "y", 1), (51, "", "en", "x", "y", 1),
             (7, "same id", "en", "x", "y", 1), (60, "twice", "en", "x", "y", 1), (60, "twice", "en", "x", "y", 1),
             (61, "word " * 4000, "en", "x", "y", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def library(text):
    return pieces.load(PATH).encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_the_library():
    rnd, encoder = random.Random(1), pieces.PieceEncoder(PATH, max_pieces=50)
    for _ in range(60):
        texts = [made(rnd, 40) for _ in range(20)]
        ids, n = encoder.encode(pa.array(texts))
        assert np.split(ids, np.cumsum(n)[:-1])[3].tolist() == library(texts[3])
        assert ids.tolist() == [i for t in texts for i in library(t)]
        assert encoder.counts(pa.array(texts)).tolist() == [len(library(t)) for t in texts]


def test_every_known_character_is_classed_like_the_library():
    texts = [f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}b" for c in range(pieces.KNOWN)]
    ids, _ = pieces.PieceEncoder(PATH).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library(t)]


def test_rank_coding_round_trip():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 1000):
        x = (rnd.integers(0, 2**32, n) >> rnd.integers(0, 32, n)).astype(np.uint32)
        assert (token_files.decode_ranks(*token_files.encode_ranks(x), n) == x).all()


def test_token_files(spark, docs, empty, tmpdir_path):
    token_files.write_token_files(docs, tmpdir_path + "/t", PATH, block_ids=100)
    got = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist())
           for r in token_files.read_token_files(spark, tmpdir_path + "/t").collect()]
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([r.doc_id for r in docs.collect()], key=lambda i: (i is not None, i))
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()
    assert collections.Counter((r[0], tuple(r[3])) for r in got) == collections.Counter(
        (r.doc_id, (*library(r.text), 0)) for r in docs.collect())
    token_files.write_token_files(empty, tmpdir_path + "/e", PATH)
    assert token_files.read_token_files(spark, tmpdir_path + "/e").count() == 0


def test_first_fit_decreasing_equals_a_plain_scan():
    rnd = random.Random(3)
    for _ in range(30):
        sizes, room, want = [rnd.randrange(1, 11) for _ in range(rnd.randrange(40))], [], {}
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            at = next((b for b, r in enumerate(room) if r >= sizes[k]), len(room))
            room += [10] * (at == len(room))
            want[k] = (at, 10 - room[at])
            room[at] -= sizes[k]
        assert dict(enumerate(zip(*packing.first_fit_decreasing(sizes, 10)))) == want


def test_packing(docs, empty):
    rows = packing.pack(docs, PATH, capacity=16, group_docs=8).collect()
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    assert sum(r.length for r in rows) == sum(len(library(r.text)) + 1 for r in docs.collect())
    long_doc = sorted((r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows if r.doc_id == 61)
    assert [i for _, ids in long_doc for i in ids] == [*library("word " * 4000), 0]
    assert packing.pack(empty, PATH).count() == 0


def test_token_counts(docs, empty):
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), len(library(r.text))) for r in docs.collect())
    for chunk, overlap in ((1 << 15, 1 << 10), (40, 8)):
        got = token_counts.count_tokens(docs, PATH, chunk, overlap).collect()
        assert collections.Counter(map(tuple, got)) == want
    assert token_counts.count_tokens(empty, PATH).count() == 0


def test_splices_of_random_texts():
    rnd = random.Random(4)
    for _ in range(100):
        text = "".join(rnd.choice([*ALPHABET, "x" * 30, " " * 25]) for _ in range(rnd.randrange(400)))
        assert token_counts.count_long(pieces.load(PATH), text, 21, 64, 40) == len(library(text))


def test_sharding(docs, empty):
    rows = sharding.shard(docs, 5).collect()
    assert len(rows) == docs.count() and {r.grown_shard for r in rows if r.grown_shard != r.shard} <= {5}
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 60}) == 1
    assert sharding.shard(empty, 5).count() == 0
    blocks = sharding.number(docs.select("doc_id", F.lit(1).alias("g")), "g", ["doc_id"], docs.count(), 10).collect()
    ids = [r.doc_id for r in sorted(blocks, key=lambda r: r.slot)]
    assert sorted(r.slot for r in blocks) == list(range(docs.count()))
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_slots_of_many_equal_rows_are_dealt_into_several_blocks(spark):
    rows = spark.range(2000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("g"))
    got = sharding.number(rows, "g", ["doc_id"], 2000, 100)
    assert sorted(r.slot for r in got.collect()) == list(range(2000))
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(20, "g", "doc_id", "_tie")
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()) < 400


def test_heavier_shards_get_more(spark):
    n = {r.shard: r["count"] for r in spark.range(4000).select(
        sharding.rendezvous(F.col("id"), [1.0, 3.0]).alias("shard")).groupBy("shard").count().collect()}
    assert abs(n[1] / 4000 - 0.75) < 0.03


def test_license_scan(spark, empty):
    text = "Intro.\nReleased under the MIT License.\nCC BY cc-by\n"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "released the license under an mit idea"), (4, text),
                                  (5, "the license\nreleased under mit")], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in license_scan.scan(rows).collect()}
    r = got[1, 10]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (2, 6, 8, "cc-by", "cc-by,mit", 1.0)
    assert got[2, 0].labels == "" and got[3, 0].first_word is None
    assert got[4, 7].labels == "mit" and got[4, 10].labels == "cc-by,mit" and got[5, 5].labels == "mit"
    assert license_scan.scan(empty).count() == 0


def test_wrapped_notices(spark):
    texts = ["Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
             "word " * 40 + "This Source Code Form is subject to the terms of the Mozilla Public\n"
             "License, v. 2.0. If a copy of the MPL was not", "the license\nreleased under mit", None, "",
             "mit\n" + "word " * 30 + "released under\n" + "word " * 30 + "the license",
             "word " * 50_000 + "Released\nunder\nthe\nMIT\nlicense" + " word" * 50_000]
    rows = spark.createDataFrame([(k, t, [], "x") for k, t in enumerate(texts)],
                                 "doc_id long, text string, spans array<string>, word string")
    got = {r.doc_id: r for r in license_scan.scan(rows).collect()}
    assert [got[k].labels for k in range(len(texts))] == ["bsd", "mpl", "mit", "", "", "", "mit"]
    assert got[0].score == 1.0 and abs(got[1].score - 10 / 11) < 1e-9


def test_best_blocks_against_every_place(spark):
    rnd, vocabulary = random.Random(11), ["released", "under", "the", "mit", "license", "x", "y", "\n"]
    made_up = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60)))) for k in range(120)]
    templates = (("mit", "released under the mit license"), ("the", "the mit the license x y"))
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(
        spark.createDataFrame(made_up, "doc_id long, text string"), templates).collect()}
    for k, text in made_up:
        w, met = text.split(), {}
        for label, template in templates:
            held, n = set(template.split()), len(template.split())
            best = max((len(held & set(w[i:i + n])) for i in range(len(w))), default=0) / len(held)
            if best >= 0.8:
                met[label] = best
        assert got[k] == (",".join(sorted(met)), max(met.values(), default=0.0)), text


def plain_hits(text, items, window):
    find = license_scan.WORD.findall
    words, hit, met = find((text or "").translate(license_scan.FOLD)), set(), set()
    for item_id, item in items:
        w = find((item or "").translate(license_scan.FOLD))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == w[k:k + n]:
                    hit.update(range(at, at + n))
                    met.add(str(item_id))
    return len(words), len(hit), sorted(met)


def plain_near(texts, items, window, count, slop, share):
    """``(text, item_id)`` of windows near, by definition."""
    find = license_scan.WORD.findall
    corpus = [find((t or "").translate(license_scan.FOLD)) for _, t in texts]
    rarity, met = collections.Counter(x for w in corpus for x in w), set()
    for item_id, item in items:
        words = find((item or "").translate(license_scan.FOLD))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            held = words[k:k + n]
            anchors = sorted({(rarity[x], x, held.index(x)) for x in held})[:count]
            for r, w in enumerate(corpus):
                for at in (i for i, x in enumerate(w) if x == anchors[0][1]):
                    start = at - anchors[0][2]
                    near = all(any(abs(j - start - p) <= slop for j, y in enumerate(w) if y == x) for _, x, p in anchors[1:])
                    around = set(w[max(0, start - slop):max(0, start + n + slop)])
                    if near and len(set(held) & around) >= share * len(set(held)):
                        met.add((r, str(item_id)))
    return met


def test_decontamination_against_every_place(spark, empty):
    rnd = random.Random(6)
    vocabulary = ["a", "b", "C", "d", "é"]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(9)))) for k in range(12)] + [(99, None)]
    texts = [(k, ", ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60)))) for k in range(30)]
    texts += [(None, None), (3, "a b"), (3, "a b"), (None, "a b C d é a b C d é"), (40, "x " * 20_000 + items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 1, ["x"], "y", "z") for i, t in texts],
                                 "doc_id long, text string, item int, w array<string>, words string, term string")
    want = collections.Counter((i, n, h, *met) for i, t in texts for n, h, met in [plain_hits(t, items, 5)])
    for slop in (0, 1):
        got = decontamination.decontaminate(docs, bench, window=5, slop=slop).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_hit, *r.item_ids) for r in got) == want
    near = collections.Counter(r for r, _ in plain_near(texts, items, 5, 2, 1, 0.8))
    assert collections.Counter((r.doc_id, r.n_words, r.n_near) for r in got) == collections.Counter(
        (i, plain_hits(t, [], 5)[0], near[k]) for k, (i, t) in enumerate(texts))
    assert decontamination.decontaminate(empty, bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_decontamination_is_one_plan_of_few_bytes(spark):
    """Without any broadcast the result is the same, and no shuffle carries a
    text once for each of its words."""
    rnd = random.Random(7)
    texts = [(k, " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(40)) for _ in range(3000))) for k in range(20)]
    items = [(k, " ".join(texts[k][1].split()[50:90])) for k in range(5)]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    read = lambda: sorted((r.doc_id, r.n_hit, r.n_near, *r.item_ids)
                          for r in decontamination.decontaminate(docs, bench, slop=1).collect())
    want, sizes = read(), {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in sizes:
            spark.conf.set(k, "-1")
        assert read() == want and sum(r[1] for r in want) == 200
        corpus = decontamination.split_corpus(decontamination.keyed_texts(docs))
        items_ = decontamination.items_of(bench)
        windows = decontamination.item_windows(items_, corpus, 13, 2)
        posted = corpus.select("doc", F.posexplode("w").alias("position", "term"))
        assert posted.columns == ["doc", "position", "term"]
        index = decontamination.build_index(corpus, windows)
        assert index.columns == ["term", "doc", "position"]
        assert index.count() < 20 * 3000 / 2
    finally:
        for k, v in sizes.items():
            spark.conf.set(k, v)


def test_decontamination_writes_few_files_of_matches(spark):
    """Texts are read by many tasks, each of which finds a few windows."""
    rnd = random.Random(9)
    texts = [(k, " ".join(str(rnd.randrange(10 ** 9)) for _ in range(3000))) for k in range(32)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t.split()[50:63])) for k, t in texts], "item_id long, text string")
    sizes = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        rows = decontamination.keyed_texts(docs)
        found = decontamination.matches(rows, decontamination.split_corpus(rows), bench)
        assert len(found.inputFiles()) <= 2
        assert sorted((r.doc.doc_id, r.item_id, r.start) for r in found.collect()) == sorted((k, str(k), 50) for k, _ in texts)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon"
    rows = spark.createDataFrame([(1, item), (2, "alpha beta new gamma delta epsilon"), (3, "epsilon x x x alpha"),
                                  (4, "x beta alpha gamma delta x")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near) for r in decontamination.decontaminate(rows, bench, 13, 3, slop=1).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0)}
    texts = decontamination.keyed_texts(rows)
    found = decontamination.matches(texts, decontamination.split_corpus(texts), bench, slop=1, anchor_words=3)
    assert {(r.doc.doc_id, r.item_id, r.n_words, r.phrase) for r in found.collect()} == {
        (1, "1", 5, True), (2, "1", 5, False)}


def test_quality_counts():
    text = "A b c\nA b c\n\n# x &  é\v\nA b c"
    got = dict(zip(quality_rules.COUNTS, quality_rules.measure(text)))
    assert got | {"n_words": 13, "word_chars": 13, "n_symbols": 2, "n_dup_lines": 2, "n_repeat_words": 9, "n_lines": 4} == got
    assert quality_rules.measure(None) == quality_rules.measure("") == (0,) * len(quality_rules.COUNTS)
    rnd = random.Random(8)
    for _ in range(100):
        w = [rnd.choice("abc") for _ in range(rnd.randrange(12))]
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        inside = {j for k, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in (k, k + 1, k + 2)}
        assert quality_rules.repeated_words([x.encode() for x in w])[0] == len(inside)


def test_rules_find_thresholds(spark, empty):
    rnd = np.random.default_rng(3)
    x = {"u": rnd.random(2000), "v": rnd.random(2000)}
    bad = ((x["u"] > 0.7) & (x["v"] < 0.4)) | (x["v"] > 0.95)
    rules = quality_rules.learn(x, bad, rnd.random(2000) < 0.67)
    met = np.zeros(2000, bool)
    for r in rules:
        met |= quality_rules.covered(list(r.tests), x, 2000)
    assert (met == bad).mean() > 0.97
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, quality int")
    assert quality_rules.judge(empty, labels).count() == 0


def test_language_and_toxicity_on_held_out_rows(spark, empty):
    d = "/root/testdata/sf0.01/"
    rows, labels = spark.read.parquet(d + "documents.parquet"), spark.read.parquet(d + "labels.parquet")
    model = language.train(rows, keep=F.col("doc_id") % 2 == 0)
    got = language.predict(rows, model).join(rows.select("doc_id", "lang"), "doc_id").filter("doc_id % 2 = 1")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert model.predict(None) == model.predict("12 !") == ("und", 0.0)
    assert language.train(empty).predict("text") == ("und", 0.0)
    assert language.predict(empty, model).count() == 0
    model = toxicity.train(rows, labels, keep=F.col("doc_id") % 4 != 0)
    got = toxicity.score(rows, model).join(labels, "doc_id").filter("doc_id % 4 = 0")
    assert got.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("toxic")).cast("int"))).first()[0] > 0.95
    assert 0 <= model.score(None) == model.score("") < 0.5
    assert 0 < toxicity.train(empty, labels).score("any") < 1
    assert toxicity.score(empty, model).count() == 0


def plain_grams(text):
    """All 3-, 4- and 5-grams of the lower-cased text framed by spaces."""
    t = f" {text.lower()} "
    return {t[k:k + n] for n in (3, 4, 5) for k in range(len(t) - n + 1)}


def one_hash(gram):
    """The hash of one n-gram as the operator finds it in a text."""
    framed = dict(toxicity.hashed("x" + gram + "x", (len(gram),)))
    return int(framed[len(gram)][2])


def test_toxicity_counts_ratios_and_scores(spark):
    rnd = random.Random(31)
    word = lambda y: rnd.choice(["vile", "rotten"]) if y and rnd.random() < 0.3 else "".join(rnd.choice("abcd") for _ in range(4))
    rows = [(k, " ".join(word(k % 3 == 0) for _ in range(rnd.randrange(5, 60)))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, "no label"), (0, "a second text of an id"), (None, "vile")]
    labels = [(k, int(k % 3 == 0)) for k in range(150)] + [(200, 1), (201, 0), (203, 1), (204, None), (None, 1), (5, 0)]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, y int, gram long, keys string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    used = [(t, y) for i, t in rows if t is not None and i is not None for j, y in labels if i == j and y is not None]
    n = collections.Counter(y for _, y in used)
    seen = collections.Counter((g, y) for t, y in used for g in plain_grams(t))
    grams = {g for g, _ in seen}
    counted = toxicity.count_ngrams(toxicity.training_rows(docs, marks, "toxic")).collect()
    got = {r.gram: (r.zero, r.one) for r in counted}
    assert got.pop(None) == (n[0], n[1])
    assert got == {one_hash(g): (seen[g, 0], seen[g, 1]) for g in grams}

    def part(a, expected):
        return a * np.log(a / expected) if a else 0.0

    ratios, tests = {}, {}
    for g in grams:
        b, a = seen[g, 0], seen[g, 1]
        share = (a + b) / (n[0] + n[1])
        test = 2 * (part(a, share * n[1]) + part(b, share * n[0]) + part(n[1] - a, (1 - share) * n[1])
                    + part(n[0] - b, (1 - share) * n[0]))
        tests[g], ratios[g] = test, np.log((a + 1) / (n[1] + 2)) - np.log((b + 1) / (n[0] + 2))
    # Of the values, by halves, the least at which a tenth of those above is expected by chance.
    least = min(c for c in {max(0, math.floor(2 * t)) / 2 for t in tests.values()}
                if len(grams) * math.erfc(math.sqrt(c / 2)) <= 0.1 * sum(t >= c for t in tests.values()))
    ratios = {g: r for g, r in ratios.items() if abs(r) >= 0.5 and tests[g] >= least}
    model = toxicity.train(docs, marks, span=40)
    assert model.keys.tolist() == sorted(map(one_hash, ratios)) and any("vile" in g for g in ratios)
    weight = {g: model.weights[model.keys.searchsorted(one_hash(g))] for g in ratios}
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == len(rows)
    want = []
    for i, t in rows:
        framed, best = f" {(t or '').lower()} ", []
        for a in range(0, max(1, len(framed) - 20), 20):
            # The n-grams that begin in a window.
            inside = {framed[k:k + m] for m in (3, 4, 5) for k in range(a, min(a + 40, len(framed) - m + 1))}
            best.append(sum(weight[g] for g in inside & set(ratios)))
        want.append((i, round(1 / (1 + np.exp(-model.intercept - (max(best) if t else 0))), 9)))
    assert collections.Counter((r.doc_id, round(r.score, 9)) for r in scored) == collections.Counter(want)
    assert all(0 <= r.score <= 1 for r in scored)


def test_toxicity_does_not_depend_on_length(spark):
    rnd = random.Random(32)
    prose = lambda n: " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9))) for _ in range(n))
    insult = lambda: "".join(f" {prose(12)} {rnd.choice(['vile moron', 'rotten scum'])}" for _ in range(5))
    rows = [(k, prose(200) + (insult() if k % 3 == 0 else "") + prose(rnd.randrange(400))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic"))
    clean = prose(60_000)
    assert len(clean) > 300_000 and model.score(clean) < 0.5
    for at in (0, 100_001, len(clean)):
        assert model.score(clean[:at] + insult() + " " + clean[at:]) >= 0.5


def test_toxicity_sample_is_bounded_in_rows(spark):
    docs = spark.range(400).selectExpr("id % 20 as doc_id", "concat('text number ', id) as text")
    labels = spark.range(20).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    ratios = spark.sparkContext.broadcast(toxicity.Model(np.empty(0, np.int64), np.empty(0), 0.0))
    for fit_rows, want in ((10, 10), (100, 100), (1000, 400)):
        found = toxicity.sampled_windows(docs, labels, "toxic", None, fit_rows, ratios)
        assert len(found) == want and sum(y for _, y in found) == want // 2
    repeated = docs.selectExpr("doc_id", "'same' as text")
    assert len(toxicity.sampled_windows(repeated, labels, "toxic", None, 100, ratios)) == 100


def plain_language(rows, text):
    """By all counts of all training rows."""
    find, counts = language.WORD.findall, [collections.defaultdict(collections.Counter) for _ in range(5)]
    for t, lang in rows:
        for w in find((t or "").lower()) if lang else ():
            counts[0][lang][w] += 1
            for size in range(1, 5):
                counts[size][lang].update(language.grams(w, size))
    langs, words = sorted(counts[0]), find((text or "").lower())
    if not words:
        return "und", 0.0

    def log(size, x):
        most = max([len(counts[size][g]) for g in langs if counts[size][g]], default=1)
        return np.log([(counts[size][g][x] + 0.5) / (sum(counts[size][g].values()) + 0.5 * most) for g in langs])

    total = np.zeros(len(langs))
    for w in words:
        if any(w in counts[0][g] for g in langs):
            total += log(0, w)
            continue
        for size in range(4, 0, -1):
            at = [log(size, x) for x in language.grams(w, size) if any(x in counts[size][g] for g in langs)]
            if at:
                total += np.mean(at, axis=0)
                break
    return langs[int(np.argmax(total))], 1 / np.exp(total - total.max()).sum()


def test_language_uses_all_counts_whatever_tasks_hold(spark):
    rnd = random.Random(12)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "efghij", None: "abcxyz", "dd": "cdefghk"}
    word = lambda g: "".join(rnd.choice(letters[g]) for _ in range(rnd.randrange(1, 6)))
    rows = [(k, " ".join(word(g) for _ in range(rnd.randrange(40))), g)
            for k, g in enumerate(rnd.choices(list(letters), [9, 3, 1, 2, 0], k=120))]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "12 !", "cc"), (503, "qqq rrr", None), (5, "bad cab", None), (5, "bad cab", None),
             (None, "fed", None), (504, "a", "dd"), (505, "fad " * 50, "aa"), (506, "fad " * 3, "bb")]
    rows += [(600, " ".join(word("aa") for _ in range(20_000)), None)]
    df = spark.createDataFrame([(*r, 1, "x", "y", 0.5) for r in rows],
                               "doc_id long, text string, lang string, row int, word string, any string, s0 double")
    rest = df.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").distinct()
    want = {t: plain_language([(t, g) for _, t, g in rows], t) for _, t, _ in rows}
    for most in (0, 3, 30_000):
        model = language.train(df, max_words=most, max_grams=most)
        assert len(model.common.words) <= 4 * most
        got = language.predict(df, model)
        assert got.count() == len(rows)
        for r in got.join(rest, "text_hash").collect():
            assert r.lang_pred == want[r.text][0] and abs(r.score - want[r.text][1]) < 1e-9, (most, r, want[r.text])
    assert model.predict("fad")[0] == want["fad " * 50][0]


def test_signatures_are_unbiased():
    rnd, off = np.random.default_rng(1), []
    for _ in range(300):
        n = rnd.integers(5, 150)
        e = near_duplicates.mix(rnd.integers(0, 2**63, n).astype(np.uint64))
        a = rnd.integers(1, 9, n)
        b = np.maximum(1, a + rnd.integers(-2, 3, n))
        same = near_duplicates.signature(e, a) == near_duplicates.signature(e, b)
        off.append(same.mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 4 * np.std(off) / len(off) ** 0.5


def test_near_duplicates_against_all_pairs(spark, empty):
    rnd = random.Random(9)
    base = [[rnd.choice("abcdefghij") + str(rnd.randrange(30)) for _ in range(60)] for _ in range(6)]
    rows = [(None, None), (1000, None), (1001, ""), (1002, "one two"), (1003, "One, two!"), (1004, "!!")]
    for k in range(120):
        w = list(base[k % 6])
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(60)] = "new" + str(rnd.randrange(99))
        rows.append((k, " ".join(w)))
    rows += rows[-3:]
    long = [rnd.choice("abcdefghij") + str(rnd.randrange(300)) for _ in range(20_000)]
    near = [w if rnd.random() > 0.01 else "new" for w in long]
    rows += [(2000, " ".join(long)), (2001, " ".join(near)), (2002, " ".join(reversed(long)))]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [near_duplicates.shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or near_duplicates.similarity(sets[i], sets[j]) >= 0.8:
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = collections.defaultdict(set)
    for k, (i, t) in enumerate(rows):
        groups[top(k)].add((i, t))
    want = {frozenset(g) for g in groups.values()}
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows],
                               "doc_id long, text string, node int, key string, root int, text_key string")
    texts = df.select(near_duplicates.text_key(F.col("text")).alias("text_key"), "text").distinct()
    for how in ({}, {"small_bucket": 2, "block": 8}, {"small_bucket": 2, "block_shingles": 300}):
        found = near_duplicates.near_duplicates(df, **how)
        got = collections.defaultdict(set)
        joined = found.join(texts, "text_key")
        assert found.count() == len(rows)
        for r in joined.collect():
            got[r.class_id].add((r.doc_id, r.text))
        assert {frozenset(g) for g in got.values()} == want
    assert near_duplicates.near_duplicates(empty).count() == 0
