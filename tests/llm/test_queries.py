"""The registered queries next to their SQL, and the pipeline's laws."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from quantbeam.llm import queries  # noqa: E402
from tests.oracle_check import compare, duck  # noqa: E402

DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_its_sql(spark, name):
    got = compare(spark, duck(DIR), name, queries.queries()[name], queries.oracle_sql()[name], DIR)
    assert got["status"] == "OK", got


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(DIR + "/documents.parquet").withColumnRenamed("n_chars", "keep_id")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, DIR)
        assert after.columns == docs.columns
        assert after.count() == after.join(kept.select("doc_id"), "doc_id", "left_semi").count() <= kept.count()
        kept = after.cache()
    packed = corpus_pipeline.pack(spark, kept, DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.collect()}
    again = corpus_pipeline.deduplicate(spark, kept, DIR)
    assert again.count() == kept.count()
