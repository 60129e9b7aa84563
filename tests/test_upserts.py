import datetime as dt
import os
from decimal import Decimal

import pytest

from pyspark.sql import functions as F
from quantbeam.operators import upserts as up
from quantbeam.sources import landing, sinks

T = dt.datetime(2025, 3, 12, 10, 0)
BAR = ["token", "timestamp"]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "symbol_token string, timestamp timestamp_ntz, exchange string, "
                                       "ltp decimal(18,6), week_low_52 decimal(18,6)")


def test_partial_upsert_keeps_nulls_and_first_values(spark):
    old = _frame(spark, [("A", T, "NSE", Decimal(10), Decimal(1)), ("B", T, "NSE", Decimal(20), Decimal(2))])
    new = _frame(spark, [("A", T, "NSE*", None, None), ("C", T, "NFO", Decimal(30), None)])
    m = {r.symbol_token: r for r in up.upsert_by_key(old, new, up.TICK_KEY, ["ltp"]).collect()}
    assert m["A"].ltp is None                      # listed column: NULL from the new row wins
    assert m["A"].exchange == "NSE" and m["A"].week_low_52 == Decimal(1)  # unlisted: first value kept
    assert m["B"].ltp == Decimal(20) and m["C"].exchange == "NFO"


def test_upserts_are_idempotent(spark):
    old = _frame(spark, [("A", T, "NSE", Decimal(10), Decimal(1))])
    new = _frame(spark, [("A", T, "X", Decimal(11), None), ("B", T, "Y", Decimal(5), None)])
    once = up.upsert_by_key(old, new, up.TICK_KEY, ["ltp"])
    twice = up.upsert_by_key(once, new, up.TICK_KEY, ["ltp"])
    assert sorted(once.collect()) == sorted(twice.collect())
    r1 = up.replace_by_key(old.withColumnRenamed("symbol_token", "token"),
                           new.withColumnRenamed("symbol_token", "token"))
    r2 = up.replace_by_key(r1, new.withColumnRenamed("symbol_token", "token"))
    assert sorted(r1.collect()) == sorted(r2.collect())


def test_schema_add_missing(spark):
    df = spark.createDataFrame([("A",)], "token string")
    out = up.schema_add_missing(df)
    assert out.schema["strike_distance"].dataType.simpleString() == "decimal(18,6)"
    assert out.collect()[0].strike_distance is None


def test_a_batch_with_repeated_keys(spark):
    schema = "token string, timestamp string, close int, kept string"
    old = spark.createDataFrame([("A", "t", 1, "old")], schema)
    batch = spark.createDataFrame([("A", "t", 2, "x"), ("A", "t", 3, "y"), ("B", "t", 4, "p"), ("B", "t", 5, "q")],
                                  schema).coalesce(1)
    for got, want in ((up.upsert_by_key(old, batch, BAR, ["close"]), {("A", "t", 3, "old"), ("B", "t", 5, "p")}),
                      (up.upsert_by_key(old, batch, BAR), {("A", "t", 3, "y"), ("B", "t", 5, "q")}),
                      (up.reduce_batch(batch, BAR, ["close"]), {("A", "t", 3, "x"), ("B", "t", 5, "p")})):
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == 2 and set(rows) == want


def _file(spark, path, value, rows, at):
    """One file in which the key 0 has ``value``, last modified at ``at``."""
    one = path + f"-{value}"
    (spark.range(rows).select(F.lit("2025-03-12").alias("day"), F.col("id").cast("string").alias("token"),
                              F.lit(value).alias("v"), F.lit(value).alias("kept")).coalesce(1).write.parquet(one))
    name = next(f for f in os.listdir(one) if f.endswith(".parquet"))
    os.makedirs(path, exist_ok=True)
    os.rename(os.path.join(one, name), os.path.join(path, name))
    os.utime(os.path.join(path, name), (at, at))


@pytest.mark.parametrize("older,newer", [(1, 20_000), (20_000, 1), (3, 3)])
def test_the_newer_file_wins_whatever_its_size(spark, tmpdir_path, older, newer):
    path = os.path.join(tmpdir_path, "landing")
    _file(spark, path, "old", older, 1_700_000_000)
    _file(spark, path, "new", newer, 1_700_000_100)
    batch = landing.read_batch(spark, path, spark.read.parquet(path).schema)
    stored = os.path.join(tmpdir_path, "table")
    sinks.merge_partitions(spark, stored, batch, "day", ["token"], ["v"])
    # A first load and a merge into what is stored: the last value, the first of the others.
    row = spark.read.parquet(stored).where("token = '0'").first()
    assert (row.v, row.kept) == ("new", "old")
    empty = spark.read.parquet(stored).limit(0).withColumn("day", F.col("day").cast("string"))
    assert up.upsert_by_key(empty, batch, ["token"]).where("token = '0'").first().v == "new"
    third = os.path.join(tmpdir_path, "third")
    _file(spark, third, "older than stored", 1, 1_600_000_000)
    sinks.merge_partitions(spark, stored, landing.read_batch(spark, third, batch.drop(up.ARRIVAL).schema), "day", ["token"], ["v"])
    assert spark.read.parquet(stored).where("token = '0'").first().v == "older than stored"   # it arrived in a later batch
    assert spark.read.parquet(stored).count() == max(older, newer)
    assert up.ARRIVAL not in spark.read.parquet(stored).columns


def test_rows_of_one_file_keep_their_order(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "quotes")
    os.makedirs(path)
    quote = '{"symbolToken": "1", "ltp": %d, "exchange": "%s"}'
    answer = '{"status": %s, "fetched_at": "2025-03-12 10:00:00", "data": {"fetched": [%s], "unfetched": []}}'
    lines = [answer % ("true", ", ".join(quote % (k, f"x{k}") for k in (5 * n, 5 * n + 1))) for n in range(200)]
    lines.append(answer % ("false", quote % (9999, "failed")))
    with open(os.path.join(path, "q.json"), "w") as f:
        f.write("\n".join(lines))
    rows = landing.quote_rows(landing.read_quotes_json(spark, path, arrival=True))
    once = up.reduce_batch(rows.repartition(7), up.TICK_KEY, up.TICK_UPDATE_COLUMNS).collect()
    assert [(r.ltp, r.exchange) for r in once] == [(Decimal(996), "x0")]


def test_bars_of_two_sizes_live_side_by_side(spark, tmpdir_path):
    from quantbeam.plans import jobs
    table, first = os.path.join(tmpdir_path, "bars"), os.path.join(tmpdir_path, "candles")
    os.makedirs(first)
    candle = '{"token": "1", "name": "A"%s, "data": [["2025-03-12T00:00:00+00:00", 1, 2, 1, %d, 10]]}'

    def land(*docs):
        with open(os.path.join(first, "c.json"), "w") as f:
            f.write("\n".join(docs))
        jobs.load_candles(spark, first, table)
        return {(r.token, r.interval): (r.close, r.trade_year) for r in spark.read.parquet(table).collect()}

    # A table of before: no interval.
    old = spark.createDataFrame(
        [("1", "A", dt.datetime(2025, 3, 12), Decimal(7), 2025), ("2", "B", dt.datetime(2024, 3, 12), Decimal(8), 2024)],
        "token string, symbol_name string, timestamp timestamp_ntz, close decimal(18,6), trade_year int")
    for c in ("open", "high", "low"):
        old = old.withColumn(c, F.col("close"))
    old.withColumn("volume", F.lit(1).cast("bigint")).write.partitionBy("trade_year").parquet(table)
    got = land(candle % (', "interval": "ONE_HOUR"', 3))
    assert got == {("1", "ONE_DAY"): (7, 2025), ("2", "ONE_DAY"): (8, 2024), ("1", "ONE_HOUR"): (3, 2025)}
    got = land(candle % ("", 4), candle % (', "interval": "ONE_HOUR"', 5), candle % ("", 6))
    assert got == {("1", "ONE_DAY"): (6, 2025), ("2", "ONE_DAY"): (8, 2024), ("1", "ONE_HOUR"): (5, 2025)}
    assert not sinks.add_key_column(spark, table, "interval", "string", "ONE_DAY", "trade_year")
    assert not sinks.add_key_column(spark, table + "-none", "interval", "string", "ONE_DAY", "trade_year")


def test_schema_add_missing_fills_a_value(spark):
    df = spark.createDataFrame([("A", None), ("B", "x")], "token string, interval string")
    assert [r.interval for r in up.schema_add_missing(df, column="interval", dtype="string", value="d").collect()] == ["d", "x"]
    assert [r.interval for r in up.with_interval(df.drop("interval")).collect()] == ["ONE_DAY", "ONE_DAY"]
