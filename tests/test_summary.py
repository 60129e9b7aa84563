from decimal import Decimal

from pyspark.sql import functions as F

from quantbeam.functions import derived as dv


def test_derived_metric_edges(spark):
    rows = [  # ltp, low52, high52, sma50, sma200
        ("a", "10", "10", "10", None, None),         # empty range -> NULL position; NULL smas -> AT / NEUTRAL
        ("b", "12", "10", "20", "5", "0"),           # sma200 = 0 -> NULL percent diff
        ("c", "15", "10", "20", "15", "15"),         # ltp = sma200 -> AT, equal smas -> NEUTRAL
        ("d", "20", "10", "20", "16", "15"),
    ]
    df = spark.createDataFrame(rows, "k string, ltp string, week_low_52 string, week_high_52 string, "
                                     "sma_50 string, sma_200 string")
    df = df.select("k", *[F.col(c).cast("decimal(18,6)").alias(c) for c in df.columns[1:]])
    out = {r.k: r for r in df.select("k", dv.position_metric().alias("pm"), dv.sma_200_position().alias("pos"),
                                     dv.ma_crossover_status().alias("x"),
                                     dv.sma_200_percent_diff().alias("pd")).collect()}
    assert out["a"].pm is None and out["a"].pos == "AT_SMA200" and out["a"].x == "NEUTRAL"
    assert out["b"].pd is None and out["b"].pm == -60.0 and out["b"].pos == "ABOVE_SMA200"
    assert out["c"].pos == "AT_SMA200" and out["c"].x == "NEUTRAL" and out["c"].pm == 0.0
    assert out["d"].pm == 100.0 and out["d"].x == "BULLISH_CROSSOVER" and out["d"].pd == 33.33


def test_atm_total_price_coalesces(spark):
    df = spark.createDataFrame([(None, Decimal("2")), (None, None)], "atm_ce_price decimal(18,6), atm_pe_price decimal(18,6)")
    assert [r[0] for r in df.select(dv.atm_total_price()).collect()] == [Decimal("2.000000"), Decimal("0.000000")]


def _tm_rows():
    from quantbeam.schemas import TOKEN_MASTER
    rows = [("E1", "ABC-EQ", "ABC", None, Decimal(0), 1, "", "NSE", Decimal(5), "EQUITY", "F1", None, None),
            ("F1", "ABC27MAR2025FUT", "ABC", None, Decimal(-1), 50, "FUTSTK", "NFO", Decimal(5), "FUTURES",
             None, None, None)]
    return rows, TOKEN_MASTER


def test_summary_name_join_fans_out_like_the_reference(spark):
    import datetime as dt
    from quantbeam.operators import summary as sm
    from quantbeam.schemas import MARKET_SUMMARY_COLUMNS, REALTIME_MARKET_DATA, TECHNICAL_INDICATORS_SUMMARY
    rows, schema = _tm_rows()
    tm = spark.createDataFrame(rows, schema)
    t0 = dt.datetime(2025, 3, 12, 10, 0)

    def tick(ex, sym, tok, ltp):
        r = {f.name: None for f in REALTIME_MARKET_DATA.fields}
        r.update(exchange=ex, trading_symbol=sym, symbol_token=tok, ltp=Decimal(ltp), timestamp=t0)
        return tuple(r[f.name] for f in REALTIME_MARKET_DATA.fields)
    # two NSE tokens whose symbols strip to the same name 'ABC'
    ticks = spark.createDataFrame([tick("NSE", "ABC-EQ", "E1", "10"), tick("NSE", "ABC-BE", "E7", "11"),
                                   tick("NFO", "ABC27MAR25FUT", "F1", "12")], REALTIME_MARKET_DATA)
    wide = spark.createDataFrame([], TECHNICAL_INDICATORS_SUMMARY)
    out = sm.market_summary(tm, ticks, wide)
    assert out.columns == MARKET_SUMMARY_COLUMNS
    got = sorted((r.token, float(r.ltp), float(r.futures_ltp), r.lotsize) for r in out.collect())
    assert got == [("E1", 10.0, 12.0, 50), ("E1", 11.0, 12.0, 50)]


def test_wide_columns_by_name_with_missing_indicator(spark):
    import datetime as dt
    from quantbeam.operators import indicators as ind
    from quantbeam.schemas import WIDE_INDICATOR_COLUMNS
    n = 150  # enough for every 14/20/21/50/100 config, never for 200
    rows = [("E1", "abc", dt.datetime(2020, 1, 1) + dt.timedelta(days=i), Decimal(100 + (i % 7)), 10 + i)
            for i in range(n)]
    bars = spark.createDataFrame(rows, "token string, symbol_name string, timestamp timestamp_ntz, "
                                       "close decimal(18,6), volume bigint")
    tm = spark.createDataFrame([("E1", "ABC")], "token string, name string")
    for long in (None, ind.indicators_long(bars)):
        r = ind.indicators_wide(tm, bars, long).collect()[0]
        assert r.symbol_name == "ABC" and r.last_volume == 10 + n - 1 and r.last_close == Decimal(100 + (n - 1) % 7)
        for c in WIDE_INDICATOR_COLUMNS:
            assert (getattr(r, c) is None) == c.endswith("_200"), (c, getattr(r, c))
