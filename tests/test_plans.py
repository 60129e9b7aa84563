"""Plan-shape tests: the scale properties the README claims, read from the
physical plans (so a refactor cannot silently lose them)."""

from quantbeam.operators import indicators as ind
from quantbeam.operators import ticks as tk
from quantbeam.operators.latest import latest_per_key
from quantbeam.sources import adapters

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    ticks = adapters.ticks(spark, SF, with_week52=False)
    p = _plan(latest_per_key(ticks, ["symbol_token"], ["timestamp"], ["ltp", "timestamp"]))
    assert "partial_max_by" in p
    assert "Window" not in p


def test_bars_are_a_hash_aggregate(spark):
    p = _plan(adapters.bars(spark, SF))
    assert "HashAggregate" in p and "SortAggregate" not in p
    assert p.count("Exchange hashpartitioning") == 1


def test_indicators_one_token_exchange_with_partial_group_limit(spark):
    p = _plan(ind.indicators_long(adapters.bars(spark, SF)))
    assert p.count("Exchange hashpartitioning(token") == 1
    assert "WindowGroupLimit" in p and "Partial" in p
    # running frames and fixed offsets (lag), but for the rows that volatility needs as they are
    import re
    periods = {p for name, p in ind.ALL_CONFIGS if name == "volatility"}
    assert {int(n) + 1 for n in re.findall(r"RowFrame, -(\d+), currentrow", p)} <= periods | {2}


def test_wide_aggregate_adds_no_exchange_after_the_rank(spark):
    p = _plan(ind.latest_indicator_values(adapters.bars(spark, SF)))
    assert p.count("Exchange hashpartitioning(token") == 1


def test_newest_indicators_have_no_sliding_frames(spark):
    import re
    p = _plan(ind.latest_indicator_values(adapters.bars(spark, SF)))
    assert not re.findall(r"RowFrame, -(?!1,)(?!1\))\d+", p)
    # the aggregate finds its tokens together: partial and final in one stage
    assert p.count("Exchange hashpartitioning(token") == 1 and "WindowGroupLimit" in p


def test_futures_quotes_are_reduced_before_they_meet_the_master(spark):
    from quantbeam.operators import atm, tokens
    tm = tokens.build_token_master(adapters.raw_instruments(spark, SF))
    p = _plan(atm.futures_price_by_name(adapters.ticks(spark, SF, with_week52=False), tm))
    below_join = p[p.index("Join"):]
    assert "partial_max_by(ltp" in below_join and "HashAggregate(keys=[symbol_token" in below_join


def test_second_pass_prunes_the_stored_ticks_at_run_time(spark):
    from quantbeam.plans.catalog import queries
    from quantbeam.sources import tick_store
    df = queries()["second_pass_ticks"](spark, SF)
    rows = df.collect()
    p = _plan(df)
    assert "dynamicpruning" in p and rows


def test_buckets_without_wanted_tokens_are_not_read(spark, tmpdir_path):
    import os
    from quantbeam.sources import tick_store
    path = os.path.join(tmpdir_path, "store")
    ticks = adapters.ticks(spark, SF, with_week52=False)
    tick_store.write_ticks(ticks, path)
    tokens = spark.createDataFrame([("E1", "x"), ("E2", "x"), (None, "x"), ("E3", "y")], "token string, kind string")
    some = tick_store.ticks_of(spark, path, tokens.where("kind = 'x'"))
    want = ticks.where("symbol_token in ('E1', 'E2')")
    assert some.count() == want.count() > 0
    assert "dynamicpruning" in _plan(some)
    assert spark.read.parquet(path).select(tick_store.BUCKET).distinct().count() > 10


def test_registered_filters_reach_the_stored_summary(spark):
    from quantbeam.plans.catalog import queries
    for name, column in (("filter_price_range", "GreaterThanOrEqual(ltp"), ("filter_technical", "sma_200_position"),
                         ("lookup_symbol_exact", "EqualTo(symbol"), ("search_symbol_cs", "BC")):
        p = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in p.split("\n") if "PushedFilters" in line]
        assert len(pushed) == 1 and column.split("(")[-1] in pushed[0], (name, p)
        assert p.count("FileScan") == 1, name


def test_stored_summary_is_exported_once(spark):
    from quantbeam.plans import q_summary
    assert q_summary.stored_summary(spark, SF) == q_summary.stored_summary(spark, SF)
    assert q_summary.stored_summary(spark, SF) != q_summary.stored_wide(spark, SF)


def test_latest_quotes_scan_ticks_once(spark):
    q = tk.latest_quotes(adapters.ticks(spark, SF, with_week52=False))
    p = _plan(q)
    assert p.count("events.parquet") == 1


def test_no_broadcast_hints_or_udfs_in_library():
    """No local checkpoints, cross joins or UDFs anywhere; no hints and no
    collects in the market-data library. The training-data subpackage, whose
    operators may run Python and broadcast sides of a set bound, is left out of
    the latter."""
    import pathlib
    files = list(pathlib.Path(__file__).parents[1].joinpath("quantbeam").rglob("*.py"))
    for f in files:
        bad = ["pandas_udf", "@F.udf", "localCheckpoint", "crossJoin("]
        if "llm" not in f.parts:
            bad += ["F.broadcast(", ".collect()"]
        for b in bad:
            assert b not in f.read_text(), (f, b)
