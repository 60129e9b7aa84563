from decimal import Decimal

from pyspark.sql import functions as F

from quantbeam.operators import tokens as tk
from quantbeam.schemas import RAW_INSTRUMENTS


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_INSTRUMENTS)


def test_strike_distance_mode_and_ties(spark):
    # strikes (after /100): A: 100,105,110,120,130 -> gaps 5,5,10,10 -> tie -> 5 (met first)
    # B: single strike -> no distance; C: duplicates + junk strike
    rows = []
    for i, s in enumerate([10000, 10500, 11000, 12000, 13000]):
        rows.append((f"A{i}", f"A27MAR2025{s}CE", "A", "27MAR2025", str(s), "1", "OPTSTK", "NFO", "5"))
    rows.append(("B0", "B27MAR2025CE", "B", "27MAR2025", "5000", "1", "OPTSTK", "NFO", "5"))
    for i, s in enumerate(["2000", "2000", "2500", "3000", "abc"]):
        rows.append((f"C{i}", f"C27MAR2025{s}PE", "C", "27MAR2025", s, "1", "OPTSTK", "NFO", "5"))
    opts = tk.options_tokens(_raw(spark, rows))
    got = {r.name: r.strike_distance for r in opts.select("name", "strike_distance").distinct().collect()}
    assert got["A"] == Decimal("5.000000")
    assert got["B"] is None
    assert got["C"] == Decimal("5.000000")
    junk = opts.where(F.col("token") == "C4").collect()[0]
    assert junk.strike is None


def test_nearest_expiry_is_global_min_including_past(spark):
    rows = [("F1", "AFUT", "A", "27MAR2020", "-1", "50", "FUTSTK", "NFO", "5"),
            ("F2", "BFUT", "B", "24APR2025", "-1", "50", "FUTSTK", "NFO", "5"),
            ("F3", "CFUT", "C", "27MAR2020", "-1", "50", "FUTSTK", "NFO", "5")]
    f = tk.futures_tokens(_raw(spark, rows))
    assert sorted(r.token for r in f.collect()) == ["F1", "F3"]


def test_equity_semi_join_and_futures_map(spark):
    rows = [("F1", "AFUT", "A", "27MAR2025", "-1", "50", "FUTSTK", "NFO", "5"),
            ("F9", "AFUT2", "A", "27MAR2025", "-1", "75", "FUTSTK", "NFO", "5"),
            ("E1", "A-EQ", "A", "", "-1", "1", "", "NSE", "5"),
            ("E2", "B-EQ", "B", "", "-1", "1", "", "NSE", "5")]
    raw = _raw(spark, rows)
    tm = tk.build_token_master(raw)
    eq = tm.where(F.col("token_type") == "EQUITY").collect()
    assert [(r.token, r.futures_token, r.strike, r.expiry) for r in eq] == [("E1", "F9", Decimal("0.000000"), None)]
    assert {r.token_type for r in tm.collect()} == {"FUTURES", "EQUITY"}


def test_tokens_by_exchange_batches_are_bounded(spark):
    tm = spark.createDataFrame([(f"T{i}", "NSE" if i % 3 else "NFO") for i in range(500)],
                               "token string, exch_seg string")
    b = tk.tokens_by_exchange(tm, batch_size=50)
    assert b.agg(F.max(F.size("tokens"))).collect()[0][0] <= 50
    flat = b.select("exch_seg", F.explode("tokens").alias("t"))
    assert flat.count() == 500 and flat.distinct().count() == 500


def test_needs_refresh(spark):
    tm = spark.createDataFrame([("2025-03-11 18:00:00",)], "c string").select(
        F.col("c").cast("timestamp_ntz").alias("created_at"))
    assert tk.needs_refresh(tm, "2025-03-12 10:00:00").collect()[0].needs_refresh is True
    assert tk.needs_refresh(tm, "2025-03-11 20:00:00").collect()[0].needs_refresh is False
    empty = tm.limit(0)
    assert tk.needs_refresh(empty, "2025-03-11 20:00:00").collect()[0].needs_refresh is True


def test_tokens_by_exchange_batches_are_full_and_independent_of_settings(spark):
    tm = spark.createDataFrame([(f"T{i}", "NSE" if i % 3 else "NFO") for i in range(430)],
                               "token string, exch_seg string")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("8", "300"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append({(r.exch_seg, r.batch_id, tuple(r.tokens)) for r in tk.tokens_by_exchange(tm).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0]) == 3 + 6
    assert sorted(len(t) for _, _, t in seen[0]) == [36, 44] + [50] * 7
