"""Checkable tick queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantbeam.operators import ticks as tk
from quantbeam.plans.catalog import query
from quantbeam.plans.oracle_ctes import with_ctes
from quantbeam.sources import adapters

_T = with_ctes("ticks")


def _ticks(spark, d):
    """Ticks without the adapter's 52-week columns (not used by the query)."""
    return adapters.ticks(spark, d, with_week52=False)


def _wk(spark, d):
    """Attach the 52-week range to reduced rows that still carry symbol_token."""
    return lambda df: adapters.attach_week52(spark, d, df)
_DEC_TICK = ["ltp", "open", "high", "low", "close", "percent_change", "week_low_52", "week_high_52"]


def _dbl(cols, src=""):
    return ", ".join(f"cast({src}{c} as double) as {c}" for c in cols)


@query("latest_equity_tick", _T + f"""
select trading_symbol, substr(trading_symbol, 1, length(trading_symbol) - 3) as name,
       {_dbl(["ltp", "percent_change", "open", "high", "low", "close"])},
       trade_volume as volume, opn_interest, {_dbl(["week_low_52", "week_high_52"])}
from (select *, row_number() over (partition by symbol_token order by timestamp desc) as rn
      from ticks where exchange = 'NSE') where rn = 1""")
def latest_equity_tick(spark, d):
    return tk.latest_equity_tick(_ticks(spark, d), enrich=_wk(spark, d))


@query("latest_futures_tick", _T + """
select trading_symbol, symbol_token, cast(ltp as double) as futures_ltp,
       cast(percent_change as double) as futures_percent_change,
       trade_volume as futures_volume, opn_interest as futures_oi
from (select *, row_number() over (partition by symbol_token order by timestamp desc) as rn
      from ticks where exchange = 'NFO' and trading_symbol like '%FUT') where rn = 1""")
def latest_futures_tick(spark, d):
    return tk.latest_futures_tick(_ticks(spark, d))


_OPT_LATEST = """
select * from (
  select regexp_extract(trading_symbol, '^([^0-9]+)', 1) as underlying_name,
         substr(trading_symbol, -2) as option_type, symbol_token, trading_symbol,
         ltp, open, high, low, close, net_change, percent_change, trade_volume, opn_interest, timestamp,
         row_number() over (partition by regexp_extract(trading_symbol, '^([^0-9]+)', 1), substr(trading_symbol, -2)
                            order by timestamp desc, symbol_token desc) as rn
  from ticks where exchange = 'NFO' and trading_symbol not like '%FUT') where rn = 1"""


@query("latest_option_by_type", _T + f"""
select underlying_name, option_type, symbol_token, trading_symbol,
       {_dbl(["ltp", "open", "high", "low", "close", "net_change", "percent_change"])},
       trade_volume, opn_interest, timestamp
from ({_OPT_LATEST}) o""")
def latest_option_by_type(spark, d):
    return tk.latest_option_by_type(_ticks(spark, d))


@query("atm_straddle", _T + f"""
select underlying_name, cast(sum(ltp) as double) as atm_price from ({_OPT_LATEST}) o group by 1""")
def atm_straddle(spark, d):
    return tk.atm_straddle(_ticks(spark, d))


_ALL20 = tk.LATEST_TICK_ALL_COLUMNS


@query("latest_tick_all", _T + f"""
select symbol_token, exchange, trading_symbol,
       {_dbl(["ltp", "open", "high", "low", "close"])}, exch_feed_time, exch_trade_time,
       {_dbl(["net_change", "percent_change"])}, trade_volume, opn_interest,
       {_dbl(["lower_circuit", "upper_circuit"])}, tot_buy_quan, tot_sell_quan,
       {_dbl(["week_low_52", "week_high_52"])}, timestamp
from (select *, row_number() over (partition by symbol_token order by timestamp desc) as rn from ticks)
where rn = 1""")
def latest_tick_all(spark, d):
    return tk.latest_tick_all(_ticks(spark, d), enrich=_wk(spark, d))


@query("count_by_instrument", _T + """
select case when trading_symbol like '%FUT' then 'FUTURES'
            when regexp_matches(trading_symbol, '(CE|PE)$') then 'OPTIONS' else 'EQUITY' end as instrument_class,
       count(*) as n
from ticks group by 1""")
def count_by_instrument(spark, d):
    return tk.count_by_instrument(_ticks(spark, d))


_TICK_OUT = ("exchange, trading_symbol, symbol_token, "
             + _dbl(["ltp", "percent_change"]) + ", trade_volume, timestamp")


def _tick_out(df):
    return df.select("exchange", "trading_symbol", "symbol_token", "ltp", "percent_change",
                     "trade_volume", "timestamp")


@query("filter_exchange", _T + f"select {_TICK_OUT} from ticks where exchange = 'NFO'")
def filter_exchange(spark, d):
    return _tick_out(tk.filter_exchange(_ticks(spark, d), "NFO"))


@query("filter_future_symbols", _T + f"select {_TICK_OUT} from ticks where trading_symbol like '%FUT'")
def filter_future_symbols(spark, d):
    return _tick_out(tk.filter_future_symbols(_ticks(spark, d)))


@query("filter_option_symbols", _T + f"""
select {_TICK_OUT} from ticks where exchange = 'NFO' and trading_symbol not like '%FUT'""")
def filter_option_symbols(spark, d):
    return _tick_out(tk.filter_option_symbols(tk.filter_exchange(_ticks(spark, d), "NFO")))


@query("filter_market_hours", _T + f"""
select {_TICK_OUT} from ticks where strftime(timestamp, '%H:%M:%S') between '09:15:00' and '15:30:00'""")
def filter_market_hours(spark, d):
    return _tick_out(tk.filter_market_hours(_ticks(spark, d), "09:15:00", "15:30:00"))


@query("scan_table", _T + f"select {_TICK_OUT}, depth_json from ticks")
def scan_table(spark, d):
    return _ticks(spark, d).select(
        "exchange", "trading_symbol", "symbol_token", "ltp", "percent_change",
        "trade_volume", "timestamp", "depth_json")


@query("scalar_strip_suffix", _T + """
select distinct trading_symbol, substr(trading_symbol, 1, length(trading_symbol) - 3) as stripped,
       replace(trading_symbol, '-EQ', '') as base_name
from ticks where exchange = 'NSE'""")
def scalar_strip_suffix(spark, d):
    from quantbeam.functions.scalars import strip_eq, strip_last3
    t = tk.filter_exchange(_ticks(spark, d), "NSE")
    return t.select("trading_symbol", strip_last3("trading_symbol").alias("stripped"),
                    strip_eq("trading_symbol").alias("base_name")).distinct()


@query("scalar_option_type", _T + """
select distinct trading_symbol, substr(trading_symbol, -2) as suffix2,
       nullif(regexp_extract(trading_symbol, '(CE|PE)$', 1), '') as option_type
from ticks""")
def scalar_option_type(spark, d):
    from quantbeam.functions.scalars import option_type_regex, option_type_suffix
    t = _ticks(spark, d)
    return t.select("trading_symbol", option_type_suffix("trading_symbol").alias("suffix2"),
                    option_type_regex("trading_symbol").alias("option_type")).distinct()


@query("scalar_underlying", _T + """
select distinct trading_symbol, regexp_extract(trading_symbol, '^([^0-9]+)', 1) as underlying_name
from ticks""")
def scalar_underlying(spark, d):
    from quantbeam.functions.scalars import underlying
    t = _ticks(spark, d)
    return t.select("trading_symbol", underlying("trading_symbol").alias("underlying_name")).distinct()


@query("legacy_latest_flag", _T + """
select t.symbol_token, t.timestamp, t.timestamp = m.last_ts as latest_record_flag
from ticks t join (select symbol_token, max(timestamp) as last_ts from ticks group by 1) m
  on t.symbol_token = m.symbol_token""")
def legacy_latest_flag(spark, d):
    t = _ticks(spark, d)
    # per-key maximum is a partial aggregate; the join back is skew-split by AQE
    last = t.groupBy("symbol_token").agg(F.max("timestamp").alias("last_ts"))
    return (t.select("symbol_token", "timestamp").join(last, "symbol_token")
             .select("symbol_token", "timestamp", (F.col("timestamp") == F.col("last_ts"))
                     .alias("latest_record_flag")))


@query("scalar_parse_feed_time", _T + """
select symbol_token, timestamp, date_trunc('second', timestamp) as feed_time from ticks""")
def scalar_parse_feed_time(spark, d):
    from quantbeam.functions.scalars import FEED_TIME_FORMAT, parse_feed_time
    t = _ticks(spark, d)
    text = F.date_format("timestamp", FEED_TIME_FORMAT)
    return t.select("symbol_token", "timestamp", parse_feed_time(text).alias("feed_time"))
