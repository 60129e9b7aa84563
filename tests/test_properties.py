"""Property tests: operators vs plain-Python references on random inputs.
Each example holds many groups so one Spark job covers many cases."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quantbeam.operators import atm, upserts, tokens as tk
from quantbeam.schemas import TOKEN_MASTER

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

strikes_by_name = st.dictionaries(
    st.sampled_from([f"N{i}" for i in range(12)]),
    st.lists(st.integers(min_value=1, max_value=60).map(lambda v: v * 250), min_size=1, max_size=12),
    min_size=1, max_size=12)


def _reference_distance(strikes):
    """Reference semantics: sorted unique strikes, rounded adjacent gaps,
    most common gap, ties -> the gap met first."""
    u = sorted(set(strikes))
    if len(u) < 2:
        return None
    diffs = [round(u[i + 1] - u[i], 2) for i in range(len(u) - 1)]
    return Counter(diffs).most_common(1)[0][0]


@SETTINGS
@given(strikes_by_name)
def test_strike_distance_matches_reference(spark, data):
    rows = [(name, Decimal(s) / 100) for name, ss in data.items() for s in ss]
    df = spark.createDataFrame(rows, "name string, strike decimal(18,6)")
    got = {r.name: (None if r.strike_distance is None else float(r.strike_distance))
           for r in tk.strike_distance(df).collect()}
    for name, ss in data.items():
        want = _reference_distance([s / 100 for s in ss])
        assert got.get(name) == want, (name, sorted(set(ss)), got.get(name), want)


keyed_rows = st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 9)),
                                st.one_of(st.none(), st.integers(0, 9))), max_size=40)


@SETTINGS
@given(keyed_rows, keyed_rows)
def test_partial_upsert_matches_reference(spark, old_rows, new_rows):
    # unique keys within a batch (as ON CONFLICT requires)
    old = {k: (a, b) for k, a, b in old_rows}
    new = {k: (a, b) for k, a, b in new_rows}
    schema = "k int, a int, b int"
    o = spark.createDataFrame([(k, a, b) for k, (a, b) in old.items()], schema)
    n = spark.createDataFrame([(k, a, b) for k, (a, b) in new.items()], schema)
    got = {r.k: (r.a, r.b) for r in upserts.upsert_by_key(o, n, ["k"], ["a"]).collect()}
    want = dict(old)
    for k, (a, b) in new.items():
        want[k] = (a, old[k][1]) if k in old else (a, b)
    assert got == want


options = st.lists(st.tuples(st.sampled_from(["NIFTY", "BANKNIFTY", "S1", "S2"]),
                             st.one_of(st.none(), st.integers(0, 400)),
                             st.one_of(st.none(), st.sampled_from([0, 5, 10, 25]))), min_size=1, max_size=60)
prices = st.fixed_dictionaries({"NIFTY": st.integers(100, 300), "BANKNIFTY": st.integers(100, 300),
                                "S1": st.integers(100, 300)})


@SETTINGS
@given(options, prices, st.integers(1, 3))
def test_near_atm_matches_reference(spark, opts, px, buffer):
    rows = []
    for i, (name, strike, dist) in enumerate(opts):
        rows.append((f"T{i}", f"{name}{i}CE", name, None, None if strike is None else Decimal(strike), 1, "OPTSTK",
                     "NFO", Decimal(5), "OPTIONS", None, None if dist is None else Decimal(dist), None))
    tm = spark.createDataFrame(rows, TOKEN_MASTER).drop("created_at")
    pdf = spark.createDataFrame([(k, Decimal(v)) for k, v in px.items()], "name string, futures_price decimal(18,6)")
    got = sorted(r.token for r in atm.near_atm_options(tm, pdf, buffer).collect())
    want = []
    for i, (name, strike, dist) in enumerate(opts):
        if name not in px or strike is None:
            continue
        d = dist if dist else {"NIFTY": 50, "BANKNIFTY": 100}.get(name, 5)
        if abs(px[name] - strike) / d <= buffer:
            want.append(f"T{i}")
    assert got == sorted(want)


exact_opts = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["CE", "PE", "XX"]),
                                st.integers(0, 40), st.integers(0, 2)), min_size=1, max_size=50)


@SETTINGS
@given(exact_opts, st.integers(0, 400))
def test_exact_atm_matches_reference(spark, opts, price10):
    import datetime as dt
    rows = []
    for i, (name, typ, strike, exp) in enumerate(opts):
        rows.append((f"T{i:03d}", f"{name}{strike}{typ}", name, dt.date(2025, 3, 27) + dt.timedelta(days=exp),
                     Decimal(strike * 10), 1, "OPTSTK", "NFO", Decimal(5), "OPTIONS", None, None, None))
    tm = spark.createDataFrame(rows, TOKEN_MASTER).drop("created_at")
    fut = Decimal(price10) / 2
    pdf = spark.createDataFrame([("A", fut), ("B", fut)], "name string, futures_price decimal(18,6)")
    got = {(r.name, r.option_type): r.token for r in atm.exact_atm_options(tm, pdf).collect()}
    # reference: options ordered by (name, strike, expiry); per (name, CE/PE) the first minimum distance
    ordered = sorted(rows, key=lambda r: (r[2], r[4], r[3], r[0]))
    want = {}
    for r in ordered:
        name, typ = r[2], r[1][-2:]
        if name not in ("A", "B") or typ not in ("CE", "PE"):
            continue
        d = abs(r[4] - fut)
        if (name, typ) not in want or d < want[(name, typ)][0]:
            want[(name, typ)] = (d, r[0])
    assert got == {k: v[1] for k, v in want.items()}
