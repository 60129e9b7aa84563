"""Technical indicators as native window expressions.

Per token the reference fetches the newest floor(1.5 p) bars (only when at
least p exist) and runs pandas rolling/ewm over them oldest-first. Here
every (indicator, period) is one window branch over the same
token-partitioned, newest-first ranked bars; the branches share one
shuffle (hash on token satisfies every per-token window).

Recursive indicators use exact closed forms (index i = 0..n-1 oldest
first inside the fetch window):

* EMA (span p, adjust=False): alpha = 2/(p+1), q = 1 - alpha,
  y_i = q^i * (x_0 + sum_{1<=j<=i} alpha x_j q^-j)  -- a running sum.
* RSI (Wilder RMA via ewm(alpha=1/p, adjust=True), r = 1 - 1/p):
  rsi_i = 100 * sum_j max(d_j,0) r^-j / sum_j |d_j| r^-j.
  The ewm normalisers cancel in the ratio.

The window length is at most 1.5 p, so q^-i stays below ~20: no overflow.

Missing and zero closes follow pandas 2.1 (rolling and ewm with their
defaults, pct_change padding):

* SMA and volatility need p values in their p rows, else there is none.
* EMA keeps its last value over a gap. A close that comes g rows after the
  last one weighs alpha / (q^g + alpha), the value before it the rest; so q^i
  is a product of such rests. It starts at the window's first close.
* RSI skips changes next to a gap, and needs p changes.
* Returns are taken between neighbouring known closes, padded inside the
  fetch window (0 on a gap); there is no return on a zero close.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantbeam.schemas import DEC, FETCH_MULTIPLIER, INDICATOR_PERIODS, WIDE_INDICATOR_COLUMNS

ANNUALISATION = 252  # fixed value: trading days per year

ALL_CONFIGS: list[tuple[str, int]] = [(k, p) for k, ps in INDICATOR_PERIODS.items() for p in ps]


def fetch_len(period: int) -> int:
    return int(period * FETCH_MULTIPLIER)


def rank_bars(bars: DataFrame, keep: int) -> DataFrame:
    """Newest-first rank per token, keeping the newest ``keep`` bars
    (Spark inserts a partial WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy("token").orderBy(F.col("timestamp").desc())
    return bars.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= keep)


def fetch_window(ranked: DataFrame, period: int) -> DataFrame:
    """Bars of the fetch window for ``period`` with n (window size) and
    i (0-based oldest-first index); tokens with fewer than p bars drop."""
    k = fetch_len(period)
    b = ranked.where(F.col("rn") <= k)
    n = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return (b.withColumn("n", n).where(F.col("n") >= period)
             .withColumn("i", F.col("n") - F.col("rn")))


def _asc() -> Window:
    return Window.partitionBy("token").orderBy("timestamp")


def _cfg_cols(name: str, p: int) -> tuple[Column, Column]:
    """(in_window, i) of config (name, p) on rows carrying rn and n_all
    (= min(bar count, longest fetch window))."""
    k = fetch_len(p)
    n_p = F.least(F.col("n_all"), F.lit(k))
    in_win = (F.col("rn") <= k) & (F.col("n_all") >= p)
    return in_win, n_p - F.col("rn")


def _value(name: str, p: int) -> Column:
    """Indicator value on every bar of the shared ascending window; NULL
    outside the config's fetch window or during warm-up. Rows older than
    the fetch window get weight 0 in the running sums, so one window spec
    serves all configs."""
    w = _asc()
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    x = F.col("_x")
    in_win, i = _cfg_cols(name, p)
    if name == "sma":
        # the last p closes as differences of exact decimal running sums: O(n), not O(n*p)
        s_now, n_now = F.sum(F.col("close")).over(run), F.count(F.col("close")).over(run)
        s_before, n_before = (F.coalesce(F.lag(v, p).over(w), F.lit(0)) for v in (s_now, n_now))
        return F.when(in_win & (i >= p - 1) & (n_now - n_before == p), ((s_now - s_before) / F.lit(p)).cast(DEC))
    if name == "ema":
        q, c, s = 1.0 - 2.0 / (p + 1), F.col(f"_steps_{p}"), F.col(f"_gaps_{p}")
        total = F.pow(F.lit(q), c) * F.exp(s) * F.sum(_ema_term(p)).over(run)
        return F.when(in_win & (F.col("_filled_rn") <= fetch_len(p)), total.cast(DEC))
    if name == "rsi":
        use, up, change = _rsi_terms(p)
        up, tot, n = F.sum(up).over(run), F.sum(change).over(run), F.count(F.when(use, F.lit(1))).over(run)
        return F.when(in_win & (n >= p), (F.lit(100.0) * F.try_divide(up, F.nullif(tot, F.lit(0.0)))).cast(DEC))
    if name == "volatility":
        # The p rows themselves, not differences of running squares, which one
        # extreme return would cancel out; at most 1.5 p rows are left of a token.
        ret = _window_return(p)
        sd = F.stddev_samp(ret).over(w.rowsBetween(-(p - 1), 0))
        n_now = F.count(ret).over(run)
        known = n_now - F.coalesce(F.lag(n_now, p).over(w), F.lit(0))
        return F.when(in_win & (known == p), (sd * F.lit(ANNUALISATION ** 0.5)).cast(DEC))
    raise ValueError(f"unsupported indicator {name}")


def _known_before(p: int) -> tuple[Column, Column]:
    """(is there a close before this row in the config's fetch window, rows since then)."""
    return (F.coalesce(F.col("_prev_rn") <= fetch_len(p), F.lit(False)), F.col("_prev_rn") - F.col("rn"))


def _window_return(p: int) -> Column:
    """The return inside the config's fetch window."""
    return F.when(_cfg_cols("volatility", p)[0] & _known_before(p)[0], F.col("_ret"))


def _newest_value(name: str, p: int) -> Column:
    """The value of ``_value`` on a token's newest bar, as an aggregate over its
    prepared bars: sums over ranks, without frames. Running counts and sums of
    the preparation never fall (or, logs of gaps, never rise), so their values on
    the newest bar are their greatest (least)."""
    x, (in_win, i) = F.col("_x"), _cfg_cols(name, p)
    enough, last_p = F.max("n_all") >= p, F.col("rn") <= p
    count = lambda c: F.count(F.when(c, F.lit(1)))
    if name == "sma":
        return F.when(enough & (count(last_p & x.isNotNull()) == p),
                      (F.sum(F.when(last_p, F.col("close"))) / F.lit(p)).cast(DEC))
    if name == "ema":
        q = 1.0 - 2.0 / (p + 1)
        total = F.pow(F.lit(q), F.max(f"_steps_{p}")) * F.exp(F.min(f"_gaps_{p}")) * F.sum(_ema_term(p))
        return F.when(enough & (count(in_win & x.isNotNull()) > 0), total.cast(DEC))
    if name == "rsi":
        use, up, change = _rsi_terms(p)
        value = F.lit(100.0) * F.try_divide(F.sum(up), F.nullif(F.sum(change), F.lit(0.0)))
        return F.when(enough & (count(use) >= p), value.cast(DEC))
    if name == "volatility":
        ret = F.when(last_p, _window_return(p))
        return F.when(enough & (F.count(ret) == p), (F.stddev_samp(ret) * F.lit(ANNUALISATION ** 0.5)).cast(DEC))
    raise ValueError(f"unsupported indicator {name}")


def _ema_term(p: int) -> Column:
    """A bar's part of the EMA's sum, before it shrinks to the newest bar."""
    a = 2.0 / (p + 1)
    q, x, in_win = 1.0 - a, F.col("_x"), _cfg_cols("ema", p)[0]
    known, gap = _known_before(p)
    shrink = F.pow(F.lit(q), -F.col(f"_steps_{p}")) * F.exp(-F.col(f"_gaps_{p}"))
    weight = F.when(gap == 1, F.lit(a)).otherwise(F.lit(a) / (F.pow(F.lit(q), gap) + F.lit(a)))
    return F.when(~in_win | x.isNull(), F.lit(0.0)).when(~known, x).otherwise(weight * x * shrink)


def _rsi_terms(p: int) -> tuple[Column, Column, Column]:
    """(is there a change in the window, the rise, the change), weighted."""
    in_win, i = _cfg_cols("rsi", p)
    use, scale = in_win & (i >= 1) & F.col("_d").isNotNull(), F.pow(F.lit(1.0 - 1.0 / p), -i)
    return (use, F.when(use, F.greatest(F.col("_d"), F.lit(0.0)) * scale).otherwise(F.lit(0.0)),
            F.when(use, F.abs(F.col("_d")) * scale).otherwise(F.lit(0.0)))


def daily_return(bars: DataFrame) -> DataFrame:
    """pct_change of close per token, oldest first: NULL on the first bar and
    on a zero close; a missing close counts as the one before."""
    run = _asc().rowsBetween(Window.unboundedPreceding, 0)
    filled = bars.withColumn("_filled", F.last(F.col("close").cast("double"), ignorenulls=True).over(run))
    prev = F.nullif(F.lag("_filled").over(_asc()), F.lit(0.0))
    return filled.withColumn("daily_return", F.col("_filled") / prev - F.lit(1.0)).drop("_filled")


def drop_null_indicator(df: DataFrame) -> DataFrame:
    return df.where(F.col("value").isNotNull())


def _prepared(bars: DataFrame, configs: list[tuple[str, int]]) -> DataFrame:
    """Newest bars of the longest fetch window with rn, n_all, the close and
    its change, the last known close (``_filled``) with its rank, the one before
    it, the return, and for each EMA the rows without and with a gap so far: one
    shuffle on token, one desc rank, one asc sort."""
    keep = max(fetch_len(p) for _, p in configs)
    ranked = rank_bars(bars, keep).withColumn("_x", F.col("close").cast("double"))
    w = _asc()
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.when(F.col("_x").isNotNull(), F.col("rn"))
    seen = ranked.withColumns({"n_all": F.count(F.lit(1)).over(whole), "_d": F.col("_x") - F.lag("_x").over(w),
                               "_filled": F.last("_x", ignorenulls=True).over(run),
                               "_filled_rn": F.last(known, ignorenulls=True).over(run)})
    seen = seen.withColumns({"_prev": F.lag("_filled").over(w), "_prev_rn": F.lag("_filled_rn").over(w)})
    more = {"_ret": F.col("_filled") / F.nullif(F.col("_prev"), F.lit(0.0)) - F.lit(1.0)}
    for p in sorted({p for name, p in configs if name == "ema"}):
        a = 2.0 / (p + 1)
        before, gap = _known_before(p)
        before = before & _cfg_cols("ema", p)[0] & F.col("_x").isNotNull()
        rest = F.pow(F.lit(1.0 - a), gap)
        more[f"_steps_{p}"] = F.count(F.when(before & (gap == 1), F.lit(1))).over(run)
        more[f"_gaps_{p}"] = F.coalesce(F.sum(F.when(before & (gap > 1), F.ln(rest / (rest + F.lit(a))))).over(run), F.lit(0.0))
    return seen.withColumns(more)


def indicators_long(bars: DataFrame, configs: Iterable[tuple[str, int]] = ALL_CONFIGS) -> DataFrame:
    """All configured indicators for all tokens in one window pass, stacked
    to (token, symbol_name, indicator_name, timestamp, value, period);
    warm-up rows (NULL value) are dropped."""
    configs = list(configs)
    prep = _prepared(bars, configs)
    vals = prep.select("token", "symbol_name", "timestamp",
                       *[_value(n, p).alias(f"{n}_{p}") for n, p in configs])
    cells = F.array(*[F.struct(F.lit(n).alias("indicator_name"), F.lit(p).alias("period"),
                               F.col(f"{n}_{p}").alias("value")) for n, p in configs])
    long = vals.select("token", "symbol_name", "timestamp", F.inline(cells))
    return drop_null_indicator(long.select("token", "symbol_name", "indicator_name", "timestamp",
                                           "value", "period"))


def latest_bar_per_token(bars: DataFrame) -> DataFrame:
    """Newest (trade_date, close, volume) per token (partial aggregate)."""
    last = F.max_by(F.struct("timestamp", "close", "volume"), "timestamp")
    return (bars.groupBy("token").agg(last.alias("b"))
                .select("token", F.to_date("b.timestamp").alias("trade_date"),
                        F.col("b.close").alias("last_close"), F.col("b.volume").alias("last_volume")))


def latest_indicator_value(long: DataFrame) -> DataFrame:
    """Newest value per (token, indicator_name, period)."""
    return (long.groupBy("token", "indicator_name", "period")
                .agg(F.max_by("value", "timestamp").alias("value"),
                     F.max("timestamp").alias("timestamp")))


def indicator_pivot_wide(long: DataFrame, latest: DataFrame,
                         columns: Sequence[str] = WIDE_INDICATOR_COLUMNS) -> DataFrame:
    """Long -> one row per token with a column per (indicator, period),
    keeping only values dated on the token's latest trade date."""
    key = F.concat_ws("_", "indicator_name", F.col("period").cast("string"))
    same_day = long.join(latest.select("token", "trade_date"), "token", "inner").where(
        F.to_date("timestamp") == F.col("trade_date"))
    return (same_day.withColumn("k", key).groupBy("token")
                    .pivot("k", list(columns)).agg(F.max_by("value", "timestamp")))


def indicators_wide_from_long(tm_equity: DataFrame, bars: DataFrame, long: DataFrame) -> DataFrame:
    """technical_indicators_summary the reference's way: latest bar +
    pivot of the long table (values dated on the latest trade date)."""
    latest = latest_bar_per_token(bars)
    wide = indicator_pivot_wide(long, latest)
    base = (tm_equity.select("token", F.col("name").alias("symbol_name"))
                     .join(latest, "token", "inner"))
    out = base.join(wide, "token", "left")
    return out.select("token", "symbol_name", "trade_date",
                      *[F.col(c).cast(DEC).alias(c) for c in WIDE_INDICATOR_COLUMNS],
                      "last_close", "last_volume")


def latest_indicator_values(bars: DataFrame, configs: Iterable[tuple[str, int]] = ALL_CONFIGS) -> DataFrame:
    """Newest bar of every token with the value of every indicator there.
    The values are those of ``indicators_long``; one aggregate over the prepared
    bars, which lie by token already: no frames, long rows or second shuffle."""
    configs = list(configs)
    newest = lambda c: F.max_by(c, "timestamp")
    return _prepared(bars, configs).groupBy("token").agg(
        F.to_date(F.max("timestamp")).alias("trade_date"), *[_newest_value(n, p).alias(f"{n}_{p}") for n, p in configs],
        newest("close").alias("last_close"), newest("volume").alias("last_volume"))


def indicators_as_of(bars: DataFrame, as_of, configs: Iterable[tuple[str, int]] = ALL_CONFIGS) -> DataFrame:
    """The long table as it was computed when the newest bar was that of
    ``as_of``. EMA and RSI start at the oldest bar of the fetch window, so their
    values on a day depend on the day of the computation; a table that is upserted
    by key, snapshot after snapshot, keeps the latest computation of each."""
    return indicators_long(bars.where(F.col("timestamp") <= F.lit(as_of).cast("timestamp_ntz")), configs)


def lookup_indicator_value(long: DataFrame, token: str, name: str, period: int) -> DataFrame:
    """Newest value of one token's indicator: no row or one; the three
    filters reach the scan of a stored table."""
    return latest_indicator_value(long.where(
        (F.col("token") == token) & (F.col("indicator_name") == name) & (F.col("period") == period)))


def indicators_wide(tm_equity: DataFrame, bars: DataFrame, long: DataFrame | None = None) -> DataFrame:
    """technical_indicators_summary: equity tokens with bars, latest bar
    values and the ten indicator columns (by name, NULL if not computable).

    Without ``long`` the newest values come straight from the ranked bars
    (``latest_indicator_values``); with ``long`` the pivot path is used."""
    if long is not None:
        return indicators_wide_from_long(tm_equity, bars, long)
    vals = latest_indicator_values(bars)
    base = tm_equity.select("token", F.col("name").alias("symbol_name"))
    out = base.join(vals, "token", "inner")
    return out.select("token", "symbol_name", "trade_date",
                      *[F.col(c).cast(DEC).alias(c) for c in WIDE_INDICATOR_COLUMNS],
                      "last_close", "last_volume")


def indicator_coverage(tm_equity: DataFrame, long: DataFrame,
                       configs: Iterable[tuple[str, int]] = ALL_CONFIGS) -> DataFrame:
    """Per (indicator, period): tokens with values (success), without
    (errors), total and success rate in percent."""
    cfg = F.array(*[F.struct(F.lit(n).alias("indicator_name"), F.lit(p).alias("period"))
                    for n, p in configs])
    pairs = tm_equity.select("token", F.explode(cfg).alias("c")).select("token", "c.*")
    done = long.select("token", "indicator_name", "period").distinct().withColumn("ok", F.lit(1))
    j = pairs.join(done, ["token", "indicator_name", "period"], "left")
    return (j.groupBy("indicator_name", "period")
             .agg(F.count("ok").alias("success"),
                  F.count_if(F.col("ok").isNull()).alias("errors"),
                  F.count(F.lit(1)).alias("total"))
             .withColumn("success_rate", F.round(F.col("success") * 100.0 / F.col("total"), 2)))


def coverage_totals(coverage: DataFrame) -> DataFrame:
    """One row over all indicators of ``indicator_coverage``."""
    return coverage.agg(F.sum("success").alias("overall_success"), F.sum("errors").alias("overall_errors"),
                        F.count(F.lit(1)).alias("indicators_processed"))


def bars_per_token(bars: DataFrame, sample: int = 2) -> DataFrame:
    """Per token: bar count plus the ``sample`` newest bars as a sample."""
    w = Window.partitionBy("token").orderBy(F.col("timestamp").desc())
    cnt = bars.groupBy("token").agg(F.count(F.lit(1)).alias("n_bars"))
    top = bars.withColumn("sample_rank", F.row_number().over(w).cast("bigint")).where(F.col("sample_rank") <= sample)
    return top.join(cnt, "token", "inner").select("token", "n_bars", "sample_rank", "timestamp", "close")


def filter_history_range(bars: DataFrame, start: str, as_of: str, close_time: str = "15:30:00") -> DataFrame:
    """Bars from ``start`` up to the market close of the day before ``as_of``."""
    end = F.to_timestamp(F.concat(F.date_format(F.date_sub(F.to_date(F.lit(as_of)), 1), "yyyy-MM-dd"),
                                  F.lit(" " + close_time))).cast("timestamp_ntz")
    return bars.where(F.col("timestamp").between(F.lit(start).cast("timestamp_ntz"), end))
