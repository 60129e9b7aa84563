import json
import os

from quantbeam.operators import ticks as tk
from quantbeam.sources import adapters
from quantbeam.streaming import ticks_stream as st

SF = "/root/testdata/sf0.001"


def test_stream_latest_equals_batch(spark, tmpdir_path):
    ticks = adapters.ticks(spark, SF)
    landing = os.path.join(tmpdir_path, "landing")
    ticks.repartition(3).write.parquet(landing)
    snap = os.path.join(tmpdir_path, "snap")
    q = st.start_latest_tick(spark, landing, snap, "t_latest", trigger="availableNow", max_files_per_trigger=1)
    q.awaitTermination()
    got = sorted(st.read_latest_snapshot(spark, snap).select("symbol_token", "timestamp", "ltp").collect())
    want = sorted(tk.latest_tick_all(ticks).select("symbol_token", "timestamp", "ltp").collect())
    assert got == want and len(got) > 0


def test_stream_append_is_idempotent_on_replay(spark, tmpdir_path):
    ticks = adapters.ticks(spark, SF)
    landing = os.path.join(tmpdir_path, "landing")
    ticks.repartition(2).write.parquet(landing)
    table = os.path.join(tmpdir_path, "table")
    for name in ["run1", "run2"]:  # a second query (fresh checkpoint) replays every file
        q = st.start_tick_append(spark, landing, table, f"t_append_{name}", trigger="availableNow",
                                 session_start="00:00:00", session_end="23:59:59")
        q.awaitTermination()
    assert spark.read.parquet(table).count() == ticks.count()


def test_stream_latest_without_state_equals_batch(spark, tmpdir_path):
    ticks = adapters.ticks(spark, SF)
    landing = os.path.join(tmpdir_path, "landing")
    ticks.repartition(3).write.parquet(landing)
    snap = os.path.join(tmpdir_path, "snap")
    # the data spans one month: a 60-day retention drops nothing
    q = st.start_latest_tick(spark, landing, snap, "t_latest_ttl", trigger="availableNow",
                             max_files_per_trigger=1, keep_state=False)
    q.awaitTermination()
    got = sorted(st.read_latest_snapshot(spark, snap).select("symbol_token", "timestamp", "ltp").collect())
    want = sorted(tk.latest_tick_all(ticks).select("symbol_token", "timestamp", "ltp").collect())
    assert got == want and len(got) > 0


def test_quote_stream_counts_by_trigger_and_replays(spark, tmpdir_path):
    quote = lambda token, ltp: {"exchange": "NSE", "tradingSymbol": f"{token}-EQ", "symbolToken": token, "ltp": ltp}
    missing = {"exchange": "NSE", "symbolToken": "9", "message": "none", "errorCode": "AB"}
    answers = [(True, "2025-03-12 10:00:00", [quote("1", 5), quote("1", 6), quote("2", 7)], [missing]),
               (True, "2025-03-12 10:01:00", [quote("1", 8)], [missing, missing]),
               (False, "2025-03-12 10:02:00", [quote("1", 99)], [missing]),
               (True, "2025-03-12 22:00:00", [quote("3", 1)], [])]       # the market is closed
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    for k, (status, at, fetched, unfetched) in enumerate(answers):
        with open(os.path.join(landing, f"{k}.json"), "w") as f:
            json.dump({"status": status, "fetched_at": at, "data": {"fetched": fetched, "unfetched": unfetched}}, f)
        os.utime(os.path.join(landing, f"{k}.json"), (1_700_000_000 + k, 1_700_000_000 + k))
    table, coverage = (os.path.join(tmpdir_path, x) for x in ("table", "coverage"))
    for run in ("a", "b"):  # another query of a fresh checkpoint replays every file
        st.start_quote_append(spark, landing, table, coverage, f"t_quotes_{run}", trigger="availableNow",
                              max_files_per_trigger=1).awaitTermination()
        rows = {(r.symbol_token, r.timestamp.minute): float(r.ltp) for r in spark.read.parquet(table).collect()}
        assert rows == {("1", 0): 6.0, ("2", 0): 7.0, ("1", 1): 8.0}
        counts = sorted((r.batch_id, r.fetched, r.unfetched) for r in spark.read.parquet(coverage).collect())
        assert counts == [(0, 3, 1), (1, 1, 2), (2, 0, 0), (3, 1, 0)]


def _land_empty_first(rows, landing: str, fmt: str) -> None:
    """An empty file, as a task without rows may write, before the others."""
    rows.where("false").coalesce(1).write.format(fmt).save(landing)
    for name in os.listdir(landing):
        os.utime(os.path.join(landing, name), (1_700_000_000, 1_700_000_000))
    rows.coalesce(1).write.mode("append").format(fmt).save(landing)


def test_streams_whose_first_trigger_meets_an_empty_file(spark, tmpdir_path):
    """One file a trigger: nothing is stored by the first, all by the second."""
    ticks = adapters.ticks(spark, SF)
    want = sorted(tk.latest_tick_all(ticks).select("symbol_token", "timestamp", "ltp").collect())
    landing = os.path.join(tmpdir_path, "ticks")
    _land_empty_first(ticks, landing, "parquet")
    for keep in (True, False):
        snap = os.path.join(tmpdir_path, f"snap_{keep}")
        st.start_latest_tick(spark, landing, snap, f"t_empty_first_{keep}", trigger="availableNow", max_files_per_trigger=1,
                             keep_state=keep).awaitTermination()
        assert sorted(st.read_latest_snapshot(spark, snap).select("symbol_token", "timestamp", "ltp").collect()) == want
    quotes = ticks.selectExpr("true as status", "cast(timestamp as string) as fetched_at", """named_struct('fetched',
        array(named_struct('exchange', exchange, 'tradingSymbol', trading_symbol, 'symbolToken', symbol_token, 'ltp', ltp))) as data""")
    landing, table, coverage = (os.path.join(tmpdir_path, x) for x in ("quotes", "table", "coverage"))
    _land_empty_first(quotes, landing, "json")
    st.start_quote_append(spark, landing, table, coverage, "t_empty_first_quotes", trigger="availableNow", max_files_per_trigger=1,
                          session_start="00:00:00", session_end="23:59:59").awaitTermination()
    assert spark.read.parquet(table).count() == ticks.count()
    counts = sorted((r.batch_id, r.fetched) for r in spark.read.parquet(coverage).collect())
    assert counts == [(0, 0), (1, ticks.count())]
