import json
import os
from decimal import Decimal

from quantbeam.sources import landing, sinks


def test_instruments_json_array(spark, tmpdir_path):
    recs = [{"token": "1", "symbol": "A-EQ", "name": "A", "expiry": "", "strike": "-1.000000", "lotsize": "1",
             "instrumenttype": "", "exch_seg": "NSE", "tick_size": "5.000000"},
            {"token": "2", "symbol": "AFUT", "name": "A", "expiry": "27MAR2025", "strike": "-1", "lotsize": "50",
             "instrumenttype": "FUTSTK", "exch_seg": "NFO", "tick_size": "5"}]
    with open(os.path.join(tmpdir_path, "master.json"), "w") as f:
        json.dump(recs, f, indent=1)
    df = landing.read_instruments_json(spark, tmpdir_path)
    assert sorted(r.token for r in df.collect()) == ["1", "2"]


def test_candles_drop_short_records(spark, tmpdir_path):
    doc = {"token": "E1", "name": "A", "data": [["2025-03-10T09:15:00+05:30", 1, 2, 0.5, 1.5, 100],
                                               ["2025-03-11T09:15:00+05:30", 1, 2, 0.5]]}
    with open(os.path.join(tmpdir_path, "c.json"), "w") as f:
        f.write(json.dumps(doc))
    rows = landing.read_candles_json(spark, tmpdir_path).collect()
    assert len(rows) == 1 and rows[0].close == Decimal("1.500000") and rows[0].volume == 100


def test_quote_envelope(spark, tmpdir_path):
    env = {"status": True, "data": {
        "fetched": [{"exchange": "NSE", "tradingSymbol": "A-EQ", "symbolToken": "1", "ltp": 10.5,
                     "exchFeedTime": "12-Mar-2025 15:29:59", "52WeekLow": 8, "52WeekHigh": 12,
                     "depth": {"buy": [{"price": 10.4, "quantity": 5, "orders": 1}], "sell": []}},
                    {"exchange": "NFO", "tradingSymbol": "AFUT", "symbolToken": "2", "ltp": "11"}],
        "unfetched": [{"exchange": "NSE", "symbolToken": "9", "message": "x", "errorCode": "AB"}]}}
    with open(os.path.join(tmpdir_path, "q.json"), "w") as f:
        f.write(json.dumps(env))
    envs = landing.read_quotes_json(spark, tmpdir_path)
    from pyspark.sql import functions as F
    rows = {r.symbol_token: r for r in landing.quote_rows(envs, as_of=F.lit("2025-03-12 15:30:00")).collect()}
    assert rows["1"].ltp == Decimal("10.500000") and rows["1"].week_high_52 == Decimal("12.000000")
    assert rows["1"].exch_feed_time.hour == 15 and '"price":10.4' in rows["1"].depth_json
    assert rows["2"].depth_json == "{}" and rows["2"].exch_feed_time is None
    cov = landing.quote_coverage(envs).collect()[0]
    assert (cov.fetched, cov.unfetched) == (2, 1)
    assert [r.symbolToken for r in landing.unfetched_rows(envs).collect()] == ["9"]


def test_export_refuses_empty_and_snapshot_roundtrip(spark, tmpdir_path):
    empty = spark.createDataFrame([], "a int")
    assert sinks.export_parquet(empty, os.path.join(tmpdir_path, "x")) is False
    assert sinks.read_snapshot(spark, os.path.join(tmpdir_path, "missing"), empty.schema).count() == 0
    df = spark.createDataFrame([(1,), (2,)], "a int")
    p = os.path.join(tmpdir_path, "snap")
    assert sinks.export_parquet(df, p) is True
    v = sinks.snapshot_verify(spark, p).collect()[0]
    assert v.readable and v.row_count == 2 and v.schema_matches
    other = lambda ddl: sinks.snapshot_verify(spark, p, spark.createDataFrame([], ddl).schema).first().schema_matches
    assert [other(d) for d in ("a int", "a long", "b int", "a int, b int")] == [True, False, False, False]
    gone = sinks.snapshot_verify(spark, os.path.join(tmpdir_path, "missing")).first()
    assert not gone.readable and not gone.schema_matches
