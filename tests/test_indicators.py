import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantbeam.operators import indicators as ind

CONFIGS = ind.ALL_CONFIGS


def _bars_pdf(lengths, seed=3, flat_token=None):
    rnd = np.random.default_rng(seed)
    rows = []
    for t, n in lengths.items():
        px = 100 + np.cumsum(rnd.normal(0, 1, n)).round(2)
        px = np.maximum(px, 1.0)
        if t == flat_token:
            px = np.full(n, 50.0)
        for i in range(n):
            rows.append((t, t.lower(), dt.datetime(2020, 1, 1) + dt.timedelta(days=i), float(px[i])))
    return pd.DataFrame(rows, columns=["token", "symbol_name", "timestamp", "close"])


def _spark_bars(spark, pdf):
    df = spark.createDataFrame(pdf).withColumn("close", F.when(~F.isnan("close"), F.col("close")))
    return df.select("token", "symbol_name", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                     F.col("close").cast("decimal(18,6)").alias("open"),
                     F.col("close").cast("decimal(18,6)").alias("high"),
                     F.col("close").cast("decimal(18,6)").alias("low"),
                     F.col("close").cast("decimal(18,6)").alias("close"),
                     F.lit(1).cast("bigint").alias("volume"))


def _reference(pdf):
    """The reference computation in pandas: per token, per config, newest
    floor(1.5p) bars (>= p needed), rolling / ewm / Wilder RSI."""
    out = []
    for (name, p) in CONFIGS:
        k = int(p * 1.5)
        for t, g in pdf.groupby("token"):
            g = g.sort_values("timestamp").tail(k)
            if len(g) < p:
                continue
            c = g["close"]
            if name == "sma":
                v = c.rolling(p).mean()
            elif name == "ema":
                v = c.ewm(span=p, adjust=False).mean()
            elif name == "rsi":
                neg = c.diff()
                pos = neg.copy()
                pos[pos < 0] = 0
                neg[neg > 0] = 0
                pa = pos.ewm(alpha=1.0 / p, min_periods=p).mean()
                na = neg.ewm(alpha=1.0 / p, min_periods=p).mean()
                v = 100 * pa / (pa + na.abs())
            else:
                v = (c.ffill() / c.ffill().shift() - 1).rolling(p).apply(lambda a: a.std(ddof=1), raw=True) * 252 ** 0.5
            for ts, val in zip(g["timestamp"], v):
                if pd.notna(val) and np.isfinite(val):
                    out.append((t, name, p, pd.Timestamp(ts), float(val)))
    return {(a, b, c, d): e for a, b, c, d, e in out}


@pytest.fixture(scope="module")
def data():
    # exactly p-1, p, p+1, 1.5p and more bars for the 200-period configs; flat prices on one token
    lengths = {"T199": 199, "T200": 200, "T201": 201, "T300": 300, "T420": 420, "FLAT": 260, "T14": 14, "T22": 22}
    return _bars_pdf(lengths, flat_token="FLAT")


@pytest.fixture(scope="module")
def gaps():
    """Missing closes alone, in a row, at either end of a fetch window; zero
    closes; an extreme price."""
    pdf = _bars_pdf({"ONE": 260, "ROW": 320, "ENDS": 300, "OLD": 300, "ZERO": 280, "EXTREME": 300, "ALL": 210}, seed=5)
    for token, at, value in [("ONE", [40, 200], np.nan), ("ROW", range(100, 110), np.nan), ("ENDS", [0, 1, 299], np.nan),
                             ("OLD", range(215, 226), np.nan), ("ZERO", [30, 31, 270], 0.0), ("EXTREME", [5, 272], 1e9),
                             ("ALL", range(210), np.nan)]:
        rows = pdf.index[pdf["token"] == token]
        pdf.loc[rows[list(at)], "close"] = value
    return pdf


@pytest.mark.parametrize("name", ["data", "gaps"])
def test_long_matches_pandas(spark, name, request):
    data = request.getfixturevalue(name)
    got = {(r.token, r.indicator_name, r.period, pd.Timestamp(r.timestamp)): float(r.value)
           for r in ind.indicators_long(_spark_bars(spark, data)).collect()}
    want = _reference(data)
    assert set(got) == set(want)
    # stored values have six decimals; doubles of 1e9 hold as many digits as they can
    worst = max(abs(got[k] - want[k]) / max(1.0, abs(want[k]) * 1e-6) for k in want)
    assert worst <= 1e-6


def test_flat_prices_rsi_dropped_and_volatility_needs_p_plus_one(spark, data):
    long = ind.indicators_long(_spark_bars(spark, data))
    assert long.where((F.col("token") == "FLAT") & (F.col("indicator_name") == "rsi")).count() == 0
    vol200 = long.where((F.col("indicator_name") == "volatility") & (F.col("period") == 200))
    counts = {r.token: r["count"] for r in vol200.groupBy("token").count().collect()}
    assert "T200" not in counts and counts["T201"] == 1


@pytest.mark.parametrize("name", ["data", "gaps"])
def test_wide_path_equals_long_path(spark, name, request):
    data = request.getfixturevalue(name)
    bars = _spark_bars(spark, data)
    tm = spark.createDataFrame([(t, t.lower()) for t in data["token"].unique()], "token string, name string")
    fast = {r.token: r.asDict() for r in ind.indicators_wide(tm, bars).collect()}
    slow = {r.token: r.asDict() for r in ind.indicators_wide(tm, bars, ind.indicators_long(bars)).collect()}
    assert fast.keys() == slow.keys()
    for t in fast:
        for c, v in fast[t].items():
            w = slow[t][c]
            if v is None or w is None:
                assert v is None and w is None, (t, c, v, w)
            elif isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
                assert abs(float(v) - float(w)) <= 2e-6, (t, c, v, w)
            else:
                assert v == w
