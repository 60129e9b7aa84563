"""Quote-tick operators: latest tick per instrument, straddle, classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantbeam.functions.scalars import option_type_suffix, strip_last3, underlying
from quantbeam.operators.latest import latest_per_key


def filter_exchange(ticks: DataFrame, exchange: str) -> DataFrame:
    return ticks.where(F.col("exchange") == exchange)


def filter_future_symbols(ticks: DataFrame) -> DataFrame:
    """trading_symbol LIKE '%FUT' (NULL symbols drop out)."""
    return ticks.where(F.col("trading_symbol").endswith("FUT"))


def filter_option_symbols(ticks: DataFrame) -> DataFrame:
    """trading_symbol NOT LIKE '%FUT' (NULL symbols drop out)."""
    return ticks.where(~F.col("trading_symbol").endswith("FUT"))


def latest_equity_tick(ticks: DataFrame, enrich=None) -> DataFrame:
    """Newest NSE tick per symbol_token; name = symbol without its last 3 chars.

    ``enrich`` (optional) is applied to the reduced rows (one per
    symbol_token, key still present) before the final projection, e.g. to
    attach per-instrument fields to a few rows instead of every tick."""
    eq = filter_exchange(ticks, "NSE")
    cols = ["trading_symbol", "ltp", "percent_change", "open", "high", "low", "close",
            "trade_volume", "opn_interest", "week_low_52", "week_high_52", "timestamp"]
    last = latest_per_key(eq, ["symbol_token"], ["timestamp"], cols)
    if enrich is not None:
        last = enrich(last)
    return last.select(
        "trading_symbol", strip_last3("trading_symbol").alias("name"), "ltp", "percent_change",
        "open", "high", "low", "close", F.col("trade_volume").alias("volume"), "opn_interest",
        "week_low_52", "week_high_52")


def latest_futures_tick(ticks: DataFrame) -> DataFrame:
    """Newest NFO futures tick per symbol_token."""
    fut = filter_future_symbols(filter_exchange(ticks, "NFO"))
    cols = ["trading_symbol", "ltp", "percent_change", "trade_volume", "opn_interest", "timestamp"]
    last = latest_per_key(fut, ["symbol_token"], ["timestamp"], cols)
    return last.select(
        "trading_symbol", "symbol_token", F.col("ltp").alias("futures_ltp"),
        F.col("percent_change").alias("futures_percent_change"),
        F.col("trade_volume").alias("futures_volume"), F.col("opn_interest").alias("futures_oi"))


def latest_option_by_type(ticks: DataFrame) -> DataFrame:
    """Newest NFO option tick per (underlying, last-2-chars), any strike.

    Ties on timestamp go to the greater symbol_token (deterministic).
    """
    opt = (filter_option_symbols(filter_exchange(ticks, "NFO"))
           .withColumns({"underlying_name": underlying("trading_symbol"),
                         "option_type": option_type_suffix("trading_symbol")}))
    cols = ["symbol_token", "trading_symbol", "ltp", "open", "high", "low", "close",
            "net_change", "percent_change", "trade_volume", "opn_interest", "timestamp"]
    return latest_per_key(opt, ["underlying_name", "option_type"], ["timestamp", "symbol_token"], cols)


def atm_straddle(ticks: DataFrame) -> DataFrame:
    """Per underlying: sum of the latest CE and PE prices."""
    return (latest_option_by_type(ticks).groupBy("underlying_name")
            .agg(F.sum("ltp").alias("atm_price")))


LATEST_TICK_ALL_COLUMNS = [
    "exchange", "trading_symbol", "ltp", "open", "high", "low", "close", "exch_feed_time",
    "exch_trade_time", "net_change", "percent_change", "trade_volume", "opn_interest",
    "lower_circuit", "upper_circuit", "tot_buy_quan", "tot_sell_quan", "week_low_52",
    "week_high_52", "timestamp"]


KIND_EQUITY, KIND_FUTURES, KIND_OPTION = "EQ", "FUT", "OPT"
_QUOTE_PAYLOAD = ["symbol_token", "trading_symbol", "ltp", "open", "high", "low", "close", "percent_change",
                  "trade_volume", "opn_interest", "week_low_52", "week_high_52", "timestamp"]


def latest_quotes(ticks: DataFrame) -> DataFrame:
    """The three "latest" selections of the summary in ONE aggregate:
    equity ticks per symbol_token (NSE), futures per symbol_token (NFO,
    '%FUT'), options per (underlying, last 2 chars) (NFO, not '%FUT').
    Output: kind, k1, k2 and the newest row's payload; ties on timestamp
    go to the greater symbol_token."""
    ex, sym = F.col("exchange"), F.col("trading_symbol")
    is_fut = sym.endswith("FUT")
    kind = (F.when(ex == "NSE", F.lit(KIND_EQUITY))
             .when((ex == "NFO") & is_fut, F.lit(KIND_FUTURES))
             .when((ex == "NFO") & ~is_fut, F.lit(KIND_OPTION)))
    k1 = F.when(kind == KIND_OPTION, underlying("trading_symbol")).otherwise(F.col("symbol_token"))
    k2 = F.when(kind == KIND_OPTION, option_type_suffix("trading_symbol")).otherwise(F.lit(""))
    t = ticks.select(kind.alias("kind"), k1.alias("k1"), k2.alias("k2"), *_QUOTE_PAYLOAD).where(
        F.col("kind").isNotNull())
    return latest_per_key(t, ["kind", "k1", "k2"], ["timestamp", "symbol_token"], _QUOTE_PAYLOAD)


def equity_from_quotes(q: DataFrame) -> DataFrame:
    return q.where(F.col("kind") == KIND_EQUITY).select(
        "trading_symbol", strip_last3("trading_symbol").alias("name"), "ltp", "percent_change",
        "open", "high", "low", "close", F.col("trade_volume").alias("volume"), "opn_interest",
        "week_low_52", "week_high_52")


def futures_from_quotes(q: DataFrame) -> DataFrame:
    return q.where(F.col("kind") == KIND_FUTURES).select(
        "trading_symbol", "symbol_token", F.col("ltp").alias("futures_ltp"),
        F.col("percent_change").alias("futures_percent_change"),
        F.col("trade_volume").alias("futures_volume"), F.col("opn_interest").alias("futures_oi"))


def straddle_from_quotes(q: DataFrame) -> DataFrame:
    return (q.where(F.col("kind") == KIND_OPTION).groupBy(F.col("k1").alias("underlying_name"))
             .agg(F.sum("ltp").alias("atm_price")))


def latest_tick_all(ticks: DataFrame, enrich=None) -> DataFrame:
    """Newest tick per symbol_token with the 20 summary columns
    (``enrich`` as in ``latest_equity_tick``)."""
    last = latest_per_key(ticks, ["symbol_token"], ["timestamp"], LATEST_TICK_ALL_COLUMNS)
    return enrich(last) if enrich is not None else last


def classify_instrument(symbol) -> F.Column:
    """FUTURES / OPTIONS / EQUITY from the symbol suffix (anchored, so
    'RELIANCE-EQ' is not an option)."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    return (F.when(s.endswith("FUT"), F.lit("FUTURES"))
             .when(s.rlike("(CE|PE)$"), F.lit("OPTIONS"))
             .otherwise(F.lit("EQUITY")))


def count_by_instrument(ticks: DataFrame) -> DataFrame:
    return (ticks.groupBy(classify_instrument("trading_symbol").alias("instrument_class"))
            .agg(F.count(F.lit(1)).alias("n")))


def filter_market_hours(ticks: DataFrame, start: str = "09:15:00", end: str = "19:30:00",
                        ts_col: str = "timestamp") -> DataFrame:
    """Keep rows whose time of day lies in [start, end] (inclusive)."""
    return ticks.where(F.date_format(F.col(ts_col), "HH:mm:ss").between(start, end))
