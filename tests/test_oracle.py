"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def _names():
    from quantbeam.plans.catalog import oracle_sql
    return sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from quantbeam.plans.catalog import oracle_sql, queries
    r = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert r["status"] == "OK", r


def test_queries_without_oracle_run(spark):
    from quantbeam.plans.catalog import oracle_sql, queries
    for name in sorted(set(queries()) - set(oracle_sql())):
        assert queries()[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and len(df.columns) == 36
