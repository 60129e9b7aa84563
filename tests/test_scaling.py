"""What queries hold, write and repeat must not grow faster than their input."""

import os

import numpy as np
from pyspark.sql import functions as F

from quantbeam.plans import q_io
from quantbeam.sources import adapters, sinks
from quantbeam.operators import summary as sm

SF = "/root/testdata/sf0.001"


def test_bars_are_made_of_bounded_partitions(spark, monkeypatch):
    want = sorted(adapters.bars(spark, SF).collect(), key=str)
    monkeypatch.setattr(adapters, "LINES_A_TASK", 500)
    dealt = adapters.bars(spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert dealt.rdd.getNumPartitions() > lines // 500
    assert sorted(dealt.collect(), key=str) == want


def test_first_load_is_written_once(spark, tmpdir_path, monkeypatch):
    copies, real = [], sinks.materialize
    monkeypatch.setattr(sinks, "materialize", lambda df, label, **k: copies.append(label) or real(df, label, **k))
    rows = spark.range(10).select("id", (F.col("id") % 3).alias("part"), F.lit(1).alias("v"))
    table = os.path.join(tmpdir_path, "table")
    sinks.merge_partitions(spark, table, rows.unionByName(rows.withColumn("v", F.lit(2))), "part", ["id"])
    assert copies == [] and [r.v for r in spark.read.parquet(table).collect()] == [2] * 10
    sinks.merge_partitions(spark, table, rows.where("id = 4").withColumn("v", F.lit(3)), "part", ["id"])
    assert copies == ["batch", "merge"]
    assert {r.id: r.v for r in spark.read.parquet(table).collect()} == {k: 3 if k == 4 else 2 for k in range(10)}


def test_landed_answers_are_compressed(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "landing")
    q_io._land(spark.range(5), path)
    q_io._land(spark.range(5, 7), path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert sorted(r.id for r in spark.read.schema("id long").json(path).collect()) == list(range(7))


def test_export_after_a_batch_makes_the_master_and_the_quotes_once(spark, monkeypatch):
    seen, real = [], sm.market_summary

    def spy(tm, ticks, wide, **k):
        seen.append(("Join" in tm._jdf.queryExecution().optimizedPlan().toString(), k))
        return real(tm, ticks, wide, **k)

    monkeypatch.setattr(sm, "market_summary", spy)
    assert q_io.q_stream_export_summary(spark, SF).count() > 0
    assert seen == [(False, {"materialize_quotes": True})]


def test_export_by_range_runs_its_plan_once(spark, tmpdir_path):
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(count, "id long")
    path = os.path.join(tmpdir_path, "out")
    assert sinks.export_by_range(df, path, F.col("id"))
    assert rows.value == 1000 and spark.read.parquet(path).count() == 1000
    assert not sinks.export_by_range(df.where("false"), path, F.col("id")) and spark.read.parquet(path).count() == 1000


def test_columns_of_binaries():
    from quantbeam.llm.token_files import binaries
    got = binaries(np.arange(6, dtype="<u2"), np.array([2, 0, 4])).to_pylist()
    assert got == [np.arange(2, dtype="<u2").tobytes(), b"", np.arange(2, 6, dtype="<u2").tobytes()]


def test_language_of_a_batch_of_several_runs(spark):
    from quantbeam.llm import language
    learn = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 3)], "doc_id long, text string, lang string")
    model = language.train(learn)
    texts = [("the dog and the cat " * 150_000, "en"), ("die katze und der hund " * 150_000, "de"), (None, "und"), ("the cat", "en"), ("", "und")]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r for r in language.predict(docs, model, evidence=True).collect()}
    assert [found[k].lang_pred for k in range(len(texts))] == [lang for _, lang in texts]
    assert [found[k].fits is None for k in range(len(texts))] == [lang == "und" for _, lang in texts]


def test_texts_are_scored_in_bounded_batches(spark, monkeypatch):
    from types import SimpleNamespace

    from pyspark.accumulators import AccumulatorParam
    from quantbeam.llm import language, pieces

    class Listed(AccumulatorParam):
        def zero(self, value):
            return []

        def addInPlace(self, a, b):
            a.extend(b)
            return a

    learn = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 3)], "doc_id long, text string, lang string")
    model = language.train(learn)
    batches, slices = (spark.sparkContext.accumulator([], Listed()) for _ in range(2))
    plain = pieces.runs

    def runs(texts, *most):
        batches.add([texts.nbytes])
        for a, b in plain(texts, *most):
            slices.add([texts.slice(a, b - a).nbytes])
            yield a, b

    monkeypatch.setattr(language, "pieces", SimpleNamespace(runs=runs))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 1200, 1, 1).selectExpr("id AS doc_id", "repeat('the dog ', 2000) AS text")
    found = language.predict(docs, model, evidence=True).collect()
    assert len(found) == 1200 and {r.lang_pred for r in found} == {"en"}
    assert max(batches.value) < 5 << 20 and max(slices.value) < 5 << 18 and sum(slices.value) > 1200 * 16_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_pipeline_steps_that_read_texts_in_python_bound_their_batches(spark, monkeypatch):
    from quantbeam.llm import language, near_duplicates, packing, quality_rules
    from quantbeam.llm.queries import tokenizer
    from quantbeam.session import materialize
    bounds = {}

    def spy(df, label="stage", *a, **b):
        bounds[label] = b.get("batch_bytes") or 1 << 40
        return materialize(df, label, *a, **b)

    for module in (language, near_duplicates, packing, quality_rules):
        monkeypatch.setattr(module, "materialize", spy)
    docs = spark.createDataFrame([(k, f"the cat and the dog {k % 2}", "en") for k in range(4)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    language.predict(docs, language.train(docs)).collect()
    near_duplicates.near_duplicates(docs).collect()
    packing.pack(docs, tokenizer()).collect()
    quality_rules.judge(docs, labels).collect()
    assert all(bounds[k] <= 4 << 20 for k in ("words", "language-rows", "signatures", "links", "pieces", "statistics"))
