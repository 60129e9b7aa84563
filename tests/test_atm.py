import datetime as dt
from decimal import Decimal

from quantbeam.operators import atm
from quantbeam.schemas import TOKEN_MASTER


def _tm(spark, rows):
    full = []
    for token, symbol, name, strike, dist in rows:
        full.append((token, symbol, name, None, None if strike is None else Decimal(strike), 1, "OPTSTK", "NFO",
                     Decimal("5"), "OPTIONS", None, None if dist is None else Decimal(dist), None))
    return spark.createDataFrame(full, TOKEN_MASTER).drop("created_at")


def _prices(spark, rows):
    return spark.createDataFrame([(n, Decimal(p)) for n, p in rows], "name string, futures_price decimal(18,6)")


def test_near_atm_defaults_and_edges(spark):
    tm = _tm(spark, [
        ("N1", "NIFTY100CE", "NIFTY", "1000", None),      # default 50: |1040-1000|=40 <= 50
        ("N2", "NIFTY100PE", "NIFTY", "1100", "0"),       # 0 -> default 50: 60 > 50
        ("B1", "BANKNIFTY1CE", "BANKNIFTY", "2100", None),  # default 100: exactly on the edge
        ("S1", "STK1CE", "STK", "103", None),             # default 5: 3 <= 5
        ("S2", "STK2CE", "STK", "110", "10"),             # own 10: 10 <= 10 edge
        ("S3", "STK3CE", "STK", None, "10"),              # NULL strike dropped
        ("X1", "NOPRICE1CE", "NOPRICE", "100", "5"),      # no futures price dropped
    ])
    prices = _prices(spark, [("NIFTY", "1040"), ("BANKNIFTY", "2000"), ("STK", "100")])
    got = sorted(r.token for r in atm.near_atm_options(tm, prices, 1).collect())
    assert got == ["B1", "N1", "S1", "S2"]


def test_exact_atm_tie_goes_to_lower_strike(spark):
    tm = _tm(spark, [
        ("A1", "A90CE", "A", "90", "10"), ("A2", "A110CE", "A", "110", "10"),
        ("A3", "A100PE", "A", "100", "10"), ("A4", "A120PE", "A", "120", "10"),
        ("A5", "A100XX", "A", "100", "10"),  # no CE/PE: dropped
    ])
    got = {(r.option_type, r.token) for r in atm.exact_atm_options(tm, _prices(spark, [("A", "100")])).collect()}
    assert got == {("CE", "A1"), ("PE", "A3")}


def _master(spark):
    rows = [("E2", "A-EQ", "A", None, "EQUITY"), ("E1", "B-EQ", "B", None, "EQUITY"), ("F1", "A27FUT", "A", None, "FUTURES"),
            ("F2", "B27FUT", "B", None, "FUTURES"), ("O1", "A90CE", "A", "90", "OPTIONS"), ("O2", "A100CE", "A", "100", "OPTIONS"),
            ("O3", "A100PE", "A", "100", "OPTIONS"), ("O4", "B50CE", "B", "50", "OPTIONS"), ("O5", "9C70PE", "9C", "70", "OPTIONS"),
            ("O6", "9C70CE", "9C", "70", "OPTIONS"), ("F9", "9C27FUT", "9C", None, "FUTURES")]
    full = [(t, s, n, None, None if k is None else Decimal(k), 1, "X", "NFO", Decimal("5"), y, None, None, None)
            for t, s, n, k, y in rows]
    return spark.createDataFrame(full, TOKEN_MASTER).drop("created_at")


def _quotes(spark, rows):
    return spark.createDataFrame([(t, None if p is None else Decimal(p), dt.datetime(2025, 3, 12, 10, m)) for t, p, m in rows],
                                 "symbol_token string, ltp decimal(18,6), timestamp timestamp_ntz")


def test_second_pass_branches_and_limits(spark):
    tm = _master(spark)
    quotes = _quotes(spark, [("F1", "200", 1), ("F1", "101", 2), ("F2", "52", 1), ("O1", "5", 1)])
    got = lambda **kw: sorted(r.token for r in atm.atm_two_pass(tm, quotes, **kw).collect())
    assert got() == ["E1", "E2", "O2", "O3", "O4"]
    assert got(exact_atm_only=True) == ["E1", "E2", "O2", "O3", "O4"]
    assert got(strike_buffer=3) == ["E1", "E2", "O1", "O2", "O3", "O4"]
    assert got(equity_limit=1, options_limit=2) == ["E1", "O2", "O3"]
    assert got(equity_limit=0, options_limit=0) == []
    assert got(atm_only=False) == ["E1", "E2", "O1", "O2", "O3", "O4", "O5", "O6"]
    assert got(atm_only=False, options_limit=2) == ["E1", "E2", "O5", "O6"]
    assert got(futures_limit=1) == ["E1", "E2", "O2", "O3"]
    nothing = sorted(r.token for r in atm.atm_two_pass(tm, quotes.limit(0)).collect())
    assert nothing == got(atm_only=False)


def test_straddle_by_contract_keeps_strikes_apart(spark):
    tm = _master(spark)
    prices = _prices(spark, [("A", "101"), ("9C", "70"), ("B", "52")])
    quotes = _quotes(spark, [("O1", "1", 9), ("O2", "20", 1), ("O2", "21", 5), ("O3", "30", 2), ("O5", "7", 1), ("F1", "9", 1)])
    got = {r.name: tuple(r)[1:] for r in atm.straddle_by_contract(tm, prices, quotes).collect()}
    dec = lambda *xs: tuple(None if x is None else Decimal(x) for x in xs)
    assert got == {"A": dec(100, 100, 21, 30, 51), "9C": dec(70, 70, None, 7, 7), "B": dec(50, None, None, None, None)}
