"""End to end: landed JSON -> stored tables -> snapshot -> read-side functions."""

import os

from pyspark.sql import functions as F

from quantbeam import api
from quantbeam.operators import filters as flt
from quantbeam.plans import jobs
from quantbeam.plans.catalog import portable
from quantbeam.plans.q_summary import build_market_summary
from quantbeam.sources import adapters

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(portable(df).collect(), key=lambda r: tuple(str(x) for x in r))


def test_refresh_flow_end_to_end(spark, tmpdir_path):
    t = jobs.table_paths(tmpdir_path)
    inst = os.path.join(tmpdir_path, "landing", "instruments")
    adapters.raw_instruments(spark, SF).write.json(inst)

    # token master: built when missing, skipped when current, rebuilt when forced
    assert jobs.refresh_token_master(spark, inst, t["token_master"], "2025-03-12 09:30:00", multi_line=False)
    assert not jobs.refresh_token_master(spark, inst, t["token_master"], "2025-03-12 10:00:00", multi_line=False)
    assert jobs.refresh_token_master(spark, inst, t["token_master"], "2025-03-12 10:00:00", force=True,
                                     multi_line=False)

    # candles arrive in two landings (older years, then the rest) and are upserted
    bars = adapters.bars(spark, SF)
    cnd = F.array(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
                  *[F.col(c).cast("string") for c in ["open", "high", "low", "close", "volume"]])
    docs = (bars.select("token", "symbol_name", "timestamp", cnd.alias("c"))
                .groupBy("token", F.year("timestamp").alias("y"))
                .agg(F.first("symbol_name").alias("name"), F.collect_list("c").alias("data")))
    first = os.path.join(tmpdir_path, "landing", "candles1")
    rest = os.path.join(tmpdir_path, "landing", "candles2")
    docs.where(F.col("y") < 1998).drop("y").write.json(first)
    docs.drop("y").write.json(rest)  # overlaps the first landing: conflicts update
    jobs.load_candles(spark, first, t["historical_data"])
    jobs.load_candles(spark, rest, t["historical_data"])
    stored = spark.read.parquet(t["historical_data"]).drop("trade_year")
    assert _rows(stored.drop("interval")) == _rows(bars) and stored.select("interval").distinct().count() == 1

    jobs.refresh_indicators(spark, t["historical_data"], t["token_master"], t["technical_indicators"],
                            t["technical_indicators_summary"])
    adapters.ticks(spark, SF).write.parquet(t["realtime_market_data"])
    assert jobs.export_market_summary(spark, t["token_master"], t["realtime_market_data"],
                                      t["technical_indicators_summary"], t["market_summary"])

    snap = api.get_market_summary(spark, t["market_summary"])
    direct = build_market_summary(spark, SF)
    assert _rows(snap) == _rows(direct)

    # read side: same answers as the operators on the direct result
    assert _rows(api.get_market_summary(spark, t["market_summary"], "b")) == _rows(flt.search_symbol_ci(direct, "b"))
    assert _rows(api.filter_market_summary(spark, t["market_summary"], 10, 80)) == \
        _rows(flt.filter_price_range(direct, 10, 80))
    assert _rows(api.filter_market_by_technicals(spark, t["market_summary"], min_rsi=0, max_rsi=100)) == \
        _rows(flt.filter_technical(direct, min_rsi=0, max_rsi=100))
    one = api.get_market_summary_for_symbol(spark, t["market_summary"], "B-EQ").collect()
    assert len(one) == 1 and one[0].symbol == "B-EQ"
    wide = api.get_technical_indicators_summary(spark, t["technical_indicators_summary"], symbol="B")
    assert wide.count() >= 1
    plan = api.filter_market_summary(spark, t["market_summary"], 10, 80)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ltp), GreaterThanOrEqual(ltp" in plan


def test_readers_over_missing_snapshots_and_two_indicator_refreshes(spark, tmpdir_path):
    gone = os.path.join(tmpdir_path, "none")
    assert api.get_market_summary(spark, gone, "a").count() == 0
    assert api.filter_market_summary(spark, gone, 1, 2).count() == 0
    assert api.filter_market_by_technicals(spark, gone, min_rsi=1).count() == 0
    assert api.get_market_summary_for_symbol(spark, gone, "A").count() == 0
    assert api.get_technical_indicators_summary(spark, gone, symbol="A").count() == 0

    def bars(days):
        return spark.range(days).select(
            F.lit("T").alias("token"), F.lit("S").alias("symbol_name"),
            F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id))").alias("timestamp"),
            *[(F.col("id") % 7 + 100).cast("decimal(18,6)").alias(c) for c in ("open", "high", "low", "close")],
            F.col("id").alias("volume"))

    t = {k: os.path.join(tmpdir_path, k) for k in ("bars", "master", "long", "wide")}
    spark.createDataFrame([("T", "S", "S", "EQUITY")], "token string, symbol string, name string, token_type string").write.parquet(t["master"])
    bars(310).write.parquet(t["bars"])
    jobs.refresh_indicators(spark, t["bars"], t["master"], t["long"], t["wide"])
    first = {(r.indicator_name, r.period, r.timestamp) for r in spark.read.parquet(t["long"]).collect()}
    bars(700).write.mode("overwrite").parquet(t["bars"])
    jobs.refresh_indicators(spark, t["bars"], t["master"], t["long"], t["wide"])
    rows = [(r.indicator_name, r.period, r.timestamp) for r in spark.read.parquet(t["long"]).collect()]
    assert len(rows) == len(set(rows)) and first < set(rows)
