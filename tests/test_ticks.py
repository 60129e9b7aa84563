import datetime as dt
from decimal import Decimal

from quantbeam.operators import ticks as tk
from quantbeam.operators.latest import latest_per_key
from quantbeam.schemas import REALTIME_MARKET_DATA


def _ticks(spark, rows):
    full = []
    for ex, sym, tok, ltp, ts in rows:
        r = {f.name: None for f in REALTIME_MARKET_DATA.fields}
        r.update(exchange=ex, trading_symbol=sym, symbol_token=tok,
                 ltp=None if ltp is None else Decimal(ltp), timestamp=ts)
        full.append(tuple(r[f.name] for f in REALTIME_MARKET_DATA.fields))
    return spark.createDataFrame(full, REALTIME_MARKET_DATA)


T0 = dt.datetime(2025, 3, 12, 10, 0, 0)
T1 = dt.datetime(2025, 3, 12, 10, 1, 0)


def test_latest_equity_tick_and_null_ltp(spark):
    t = _ticks(spark, [("NSE", "ABC-EQ", "E1", "10", T0), ("NSE", "ABC-EQ", "E1", None, T1),
                       ("NSE", "XYZ-EQ", "E2", "5", T0)])
    got = {r.name: r.ltp for r in tk.latest_equity_tick(t).collect()}
    assert got == {"ABC": None, "XYZ": Decimal("5.000000")}


def test_option_latest_tie_break_by_symbol_token(spark):
    t = _ticks(spark, [("NFO", "ABC27MAR25100CE", "C1", "1", T1), ("NFO", "ABC27MAR25110CE", "C2", "2", T1),
                       ("NFO", "ABC27MAR25100PE", "P1", "3", T0)])
    got = {(r.underlying_name, r.option_type): r.symbol_token for r in tk.latest_option_by_type(t).collect()}
    assert got == {("ABC", "CE"): "C2", ("ABC", "PE"): "P1"}
    assert tk.atm_straddle(t).collect()[0].atm_price == Decimal("5.000000")


def test_count_by_instrument_is_anchored(spark):
    t = _ticks(spark, [("NSE", "RELIANCE-EQ", "E1", "1", T0), ("NFO", "ABC27MAR25FUT", "F1", "1", T0),
                       ("NFO", "ABC27MAR25100CE", "C1", "1", T0)])
    got = {r.instrument_class: r.n for r in tk.count_by_instrument(t).collect()}
    assert got == {"EQUITY": 1, "FUTURES": 1, "OPTIONS": 1}


def test_latest_per_key_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 20)}", rnd.randint(0, 50), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts int, v int")
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, ["k"], ["ts", "v"]).collect()}
    want = {}
    for k, ts, v in rows:
        if k not in want or (ts, v) > want[k]:
            want[k] = (ts, v)
    assert got == want


def test_market_hours_inclusive(spark):
    t = _ticks(spark, [("NSE", "A-EQ", "E1", "1", dt.datetime(2025, 3, 12, 9, 15, 0)),
                       ("NSE", "A-EQ", "E1", "1", dt.datetime(2025, 3, 12, 9, 14, 59)),
                       ("NSE", "A-EQ", "E1", "1", dt.datetime(2025, 3, 12, 15, 30, 0))])
    assert tk.filter_market_hours(t, "09:15:00", "15:30:00").count() == 2
