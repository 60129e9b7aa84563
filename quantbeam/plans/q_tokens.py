"""Checkable instrument-master and ATM queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantbeam.functions import scalars as sc
from quantbeam.operators import atm, tokens as tk
from quantbeam.operators import ticks as ticks_ops
from quantbeam.plans.catalog import query
from quantbeam.plans.oracle_ctes import register, with_ctes
from quantbeam.session import scratch_path
from quantbeam.sources import adapters, tick_store

_EXP = "cast(try_strptime(expiry, '%d%b%Y') as date)"
_INT = "try_cast(try_cast(lotsize as decimal(38,6)) as integer)"

register("fut_raw", ["raw_instruments"],
         "select * from raw_instruments where instrumenttype = 'FUTSTK' and exch_seg = 'NFO'")
register("opt_raw", ["raw_instruments"],
         "select * from raw_instruments where instrumenttype = 'OPTSTK' and exch_seg = 'NFO'")
register("fut_tm", ["fut_raw"], f"""
select token, symbol, name, {_EXP} as expiry, try_cast(strike as decimal(18,6)) as strike, {_INT} as lotsize,
       instrumenttype, exch_seg, try_cast(tick_size as decimal(18,6)) as tick_size, 'FUTURES' as token_type,
       cast(null as varchar) as futures_token, cast(null as decimal(18,6)) as strike_distance
from fut_raw where {_EXP} = (select min({_EXP}) from fut_raw)""")
register("opt_base", ["opt_raw"], f"""
select token, symbol, name, {_EXP} as expiry,
       cast(try_cast(strike as decimal(18,6)) / 100 as decimal(18,6)) as strike, {_INT} as lotsize,
       instrumenttype, exch_seg, try_cast(tick_size as decimal(18,6)) as tick_size
from opt_raw where {_EXP} = (select min({_EXP}) from opt_raw)""")
register("sd", ["opt_base"], """
select name, cast(diff as decimal(18,6)) as strike_distance from (
  select name, diff, row_number() over (partition by name order by cnt desc, first_at) as rn from (
    select name, diff, count(*) as cnt, min(strike) as first_at from (
      select name, strike, round(lead(strike) over (partition by name order by strike) - strike, 2) as diff
      from (select distinct name, strike from opt_base where strike is not null))
    where diff is not null group by name, diff))
where rn = 1""")
register("opt_tm", ["opt_base", "sd"], """
select o.token, o.symbol, o.name, o.expiry, o.strike, o.lotsize, o.instrumenttype, o.exch_seg, o.tick_size,
       'OPTIONS' as token_type, cast(null as varchar) as futures_token, sd.strike_distance
from opt_base o left join sd on o.name = sd.name""")
register("eq_tm", ["raw_instruments", "fut_tm"], f"""
select r.token, r.symbol, r.name, cast(null as date) as expiry, cast(0 as decimal(18,6)) as strike,
       {_INT} as lotsize, r.instrumenttype, r.exch_seg, try_cast(r.tick_size as decimal(18,6)) as tick_size,
       'EQUITY' as token_type, m.futures_token, cast(null as decimal(18,6)) as strike_distance
from raw_instruments r
left join (select name, max(token) as futures_token from fut_tm group by name) m
       on replace(r.symbol, '-EQ', '') = m.name
where r.exch_seg = 'NSE' and r.symbol in (select name || '-EQ' from fut_tm)""")
register("token_master", ["fut_tm", "opt_tm", "eq_tm"],
         "select * from fut_tm union all select * from opt_tm union all select * from eq_tm")

_TM_COLS = ("token, symbol, name, expiry, cast(strike as double) as strike, lotsize, instrumenttype, exch_seg, "
            "cast(tick_size as double) as tick_size, token_type, futures_token, "
            "cast(strike_distance as double) as strike_distance")


def _raw(spark, d):
    return adapters.raw_instruments(spark, d)


def _tm(spark, d):
    return tk.build_token_master(_raw(spark, d)).drop("created_at")


@query("src_raw_instruments", with_ctes("raw_instruments") + "select * from raw_instruments")
def q_raw(spark, d):
    return _raw(spark, d)


@query("filter_futures", with_ctes("fut_raw") + "select * from fut_raw")
def q_filter_futures(spark, d):
    return tk.filter_futures(_raw(spark, d))


@query("filter_options", with_ctes("opt_raw") + "select * from opt_raw")
def q_filter_options(spark, d):
    return tk.filter_options(_raw(spark, d))


@query("min_expiry", with_ctes("opt_raw") + f"select min({_EXP}) as min_expiry from opt_raw")
def q_min_expiry(spark, d):
    return tk.min_expiry(tk.filter_options(_raw(spark, d)))


@query("distinct_expiries", with_ctes("raw_instruments") + """
select expiry, row_number() over (order by expiry) as place
from (select distinct expiry from raw_instruments where exch_seg = 'NFO')""")
def q_distinct_expiries(spark, d):
    """The sorted expiries with their places; there are as many as months listed."""
    from pyspark.sql import Window
    found = tk.distinct_expiries(_raw(spark, d).where(F.col("exch_seg") == "NFO"))
    return found.withColumn("place", F.row_number().over(Window.orderBy("expiry")).cast("bigint"))


@query("nearest_expiry", with_ctes("opt_raw") + f"""
select token, symbol, expiry, {_EXP} as expiry_date from opt_raw
where {_EXP} = (select min({_EXP}) from opt_raw)""")
def q_nearest_expiry(spark, d):
    return tk.nearest_expiry(tk.filter_options(_raw(spark, d))).select("token", "symbol", "expiry", "expiry_date")


@query("coerce_numeric", with_ctes("raw_instruments") + f"""
select token, cast(try_cast(strike as decimal(18,6)) as double) as strike, {_INT} as lotsize,
       cast(try_cast(tick_size as decimal(18,6)) as double) as tick_size from raw_instruments""")
def q_coerce_numeric(spark, d):
    return tk.coerce_numeric(_raw(spark, d)).select("token", "strike", "lotsize", "tick_size")


@query("normalize_strike", with_ctes("opt_raw") + """
select token, cast(cast(try_cast(strike as decimal(18,6)) / 100 as decimal(18,6)) as double) as strike
from opt_raw""")
def q_normalize_strike(spark, d):
    return tk.normalize_strike(tk.coerce_numeric(tk.filter_options(_raw(spark, d)))).select("token", "strike")


@query("strike_distance", with_ctes("sd") + "select name, cast(strike_distance as double) as strike_distance from sd")
def q_strike_distance(spark, d):
    o = tk.normalize_strike(tk.coerce_numeric(tk.nearest_expiry(tk.filter_options(_raw(spark, d)))))
    return tk.strike_distance(o)


@query("strike_stats", with_ctes("opt_base") + """
select name, count(*) as n_options, cast(min(strike) as double) as min_strike,
       cast(max(strike) as double) as max_strike from opt_base group by name""")
def q_strike_stats(spark, d):
    o = tk.normalize_strike(tk.coerce_numeric(tk.nearest_expiry(tk.filter_options(_raw(spark, d)))))
    return tk.strike_stats(o)


@query("futures_tokens", with_ctes("fut_tm") + f"select {_TM_COLS} from fut_tm")
def q_futures_tokens(spark, d):
    return tk.futures_tokens(_raw(spark, d))


@query("options_tokens", with_ctes("opt_tm") + f"select {_TM_COLS} from opt_tm")
def q_options_tokens(spark, d):
    return tk.options_tokens(_raw(spark, d))


@query("equity_of_futures", with_ctes("raw_instruments", "fut_tm") + """
select * from raw_instruments r
where r.exch_seg = 'NSE' and r.symbol in (select name || '-EQ' from fut_tm)""")
def q_equity_of_futures(spark, d):
    r = _raw(spark, d)
    return tk.equity_of_futures(r, tk.futures_tokens(r))


@query("map_futures_token", with_ctes("eq_tm") + "select token, symbol, futures_token from eq_tm")
def q_map_futures_token(spark, d):
    r = _raw(spark, d)
    f = tk.futures_tokens(r)
    return tk.map_futures_token(tk.equity_of_futures(r, f), f).select("token", "symbol", "futures_token")


@query("project_equity", with_ctes("eq_tm") + f"select {_TM_COLS} from eq_tm")
def q_project_equity(spark, d):
    r = _raw(spark, d)
    return tk.equity_tokens(r, tk.futures_tokens(r))


@query("build_token_master", with_ctes("token_master") + f"select {_TM_COLS} from token_master")
def q_build_token_master(spark, d):
    return _tm(spark, d)


@query("tokens_by_type", with_ctes("token_master") + """
select token, name, exch_seg from token_master where token_type = 'FUTURES'""")
def q_tokens_by_type(spark, d):
    return tk.tokens_by_type(_tm(spark, d), "FUTURES")


@query("options_sorted_limit", with_ctes("token_master") + f"""
select {_TM_COLS} from token_master where token_type = 'OPTIONS'
order by name, strike, expiry, token limit 100""")
def q_options_sorted_limit(spark, d):
    return tk.options_sorted(_tm(spark, d), 100)


@query("sample_rows", with_ctes("token_master") + f"""
select {_TM_COLS} from (select *, row_number() over (partition by token_type order by token) as rn
                        from token_master) where rn <= 3""")
def q_sample_rows(spark, d):
    return tk.sample_rows(_tm(spark, d), 3)


@query("strike_distance_sample", with_ctes("token_master") + """
select distinct name, cast(strike_distance as double) as strike_distance
from token_master where strike_distance is not null""")
def q_strike_distance_sample(spark, d):
    return tk.strike_distance_sample(_tm(spark, d))


@query("options_null_distance", with_ctes("token_master") + """
select count(*) filter (where strike_distance is null) as null_distance,
       count(*) filter (where strike_distance is not null) as with_distance
from token_master where token_type = 'OPTIONS'""")
def q_options_null_distance(spark, d):
    return tk.options_null_distance(_tm(spark, d))


@query("table_status", with_ctes("token_master") + """
select count(*) as row_count, timestamp '2025-03-12 09:00:00' as last_update from token_master""")
def q_table_status(spark, d):
    tm = tk.build_token_master(_raw(spark, d), as_of=F.lit("2025-03-12 09:00:00").cast("timestamp_ntz"))
    return tk.table_status(tm)


@query("needs_refresh", with_ctes("token_master") + """
select count(*) as row_count, timestamp '2025-03-11 18:00:00' as last_update,
       coalesce(max(timestamp '2025-03-11 18:00:00') < timestamp '2025-03-12 09:00:00', true) as needs_refresh
from token_master""")
def q_needs_refresh(spark, d):
    tm = tk.build_token_master(_raw(spark, d), as_of=F.lit("2025-03-11 18:00:00").cast("timestamp_ntz"))
    return tk.needs_refresh(tm, "2025-03-12 10:00:00")


@query("tokens_by_exchange", with_ctes("token_master") + """
select exch_seg, token, true as batch_ok,
       cast(ceil(count(*) over (partition by exch_seg) / 50.0) as bigint) as n_batches
from token_master""")
def q_tokens_by_exchange(spark, d):
    b = tk.tokens_by_exchange(_tm(spark, d))
    n = b.groupBy("exch_seg").agg(F.count_distinct("batch_id").alias("n_batches"))
    return b.join(n, "exch_seg").select("exch_seg", F.explode("tokens").alias("token"),
                                        (F.size("tokens") <= tk.REQUEST_BATCH).alias("batch_ok"), "n_batches")


@query("scalar_parse_expiry", with_ctes("raw_instruments") + f"""
select distinct expiry, {_EXP} as expiry_date, strftime({_EXP}, '%Y-%m-%d') as expiry_text
from raw_instruments""")
def q_scalar_parse_expiry(spark, d):
    r = _raw(spark, d)
    return r.select("expiry", sc.parse_expiry("expiry").alias("expiry_date"),
                    sc.format_date(sc.parse_expiry("expiry")).alias("expiry_text")).distinct()


@query("scalar_concat_eq", with_ctes("fut_tm") + "select distinct name, name || '-EQ' as symbol from fut_tm")
def q_scalar_concat_eq(spark, d):
    return tk.futures_tokens(_raw(spark, d)).select("name", sc.concat_eq("name").alias("symbol")).distinct()


# ---- ATM selection -------------------------------------------------------

register("fut_prices", ["ticks", "token_master"], """
select tm.name, max_by(t.ltp, (t.timestamp, t.symbol_token)) as futures_price
from (select * from ticks where exchange = 'NFO' and trading_symbol like '%FUT') t
join (select token, name from token_master where token_type = 'FUTURES') tm on t.symbol_token = tm.token
group by tm.name""")


def _prices(spark, d, tm):
    t = ticks_ops.filter_future_symbols(ticks_ops.filter_exchange(adapters.ticks(spark, d, with_week52=False), "NFO"))
    return atm.futures_price_by_name(t, tm)


@query("futures_price_by_name", with_ctes("fut_prices") + """
select name, cast(futures_price as double) as futures_price from fut_prices""")
def q_futures_price_by_name(spark, d):
    return _prices(spark, d, _tm(spark, d))


_DIST = ("case when o.strike_distance is not null and o.strike_distance <> 0 then o.strike_distance "
         "when o.name = 'NIFTY' then 50 when o.name = 'BANKNIFTY' then 100 else 5 end")
register("near_atm", ["token_master", "fut_prices"], f"""
select o.* from token_master o join fut_prices p on o.name = p.name
where o.token_type = 'OPTIONS' and o.strike is not null
  and abs(p.futures_price - o.strike) <= 1 * {_DIST}""")


@query("near_atm_options", with_ctes("near_atm") + f"select {_TM_COLS} from near_atm")
def q_near_atm_options(spark, d):
    tm = _tm(spark, d)
    return atm.near_atm_options(tm, _prices(spark, d, tm), 1)


@query("exact_atm_options", with_ctes("token_master", "fut_prices") + f"""
select name, option_type, token, symbol, expiry, cast(strike as double) as strike, lotsize, instrumenttype,
       exch_seg, cast(tick_size as double) as tick_size, token_type, futures_token,
       cast(strike_distance as double) as strike_distance
from (select o.*, nullif(regexp_extract(o.symbol, '(CE|PE)$', 1), '') as option_type,
             row_number() over (partition by o.name, nullif(regexp_extract(o.symbol, '(CE|PE)$', 1), '')
                                order by abs(o.strike - p.futures_price), o.strike, o.expiry, o.token) as rn
      from token_master o join fut_prices p on o.name = p.name
      where o.token_type = 'OPTIONS' and o.strike is not null
        and regexp_extract(o.symbol, '(CE|PE)$', 1) <> '')
where rn = 1""")
def q_exact_atm_options(spark, d):
    tm = _tm(spark, d)
    return atm.exact_atm_options(tm, _prices(spark, d, tm))


@query("atm_two_pass", with_ctes("token_master", "near_atm") + """
select token, name, exch_seg, token_type from token_master where token_type = 'EQUITY'
union all select token, name, exch_seg, token_type from near_atm""")
def q_atm_two_pass(spark, d):
    tm = _tm(spark, d)
    t = ticks_ops.filter_future_symbols(ticks_ops.filter_exchange(adapters.ticks(spark, d, with_week52=False), "NFO"))
    return atm.atm_two_pass(tm, t, strike_buffer=1)


_FETCH = "select token, name, exch_seg, token_type from"
_EQUITY = "(select * from token_master where token_type = 'EQUITY' {})"
_BY_STRIKE = "order by name, strike nulls first, expiry nulls first, token limit"


def _futures_quotes(spark, d):
    return ticks_ops.filter_future_symbols(ticks_ops.filter_exchange(adapters.ticks(spark, d, with_week52=False), "NFO"))


@query("atm_two_pass_limited", with_ctes("token_master", "near_atm") + f"""
{_FETCH} {_EQUITY.format('order by token limit 7')}
union all {_FETCH} (select * from near_atm {_BY_STRIKE} 25)""")
def q_atm_two_pass_limited(spark, d):
    return atm.atm_two_pass(_tm(spark, d), _futures_quotes(spark, d), equity_limit=7, options_limit=25)


@query("atm_two_pass_all_options", with_ctes("token_master") + f"""
{_FETCH} {_EQUITY.format('')} union all {_FETCH} (select * from token_master where token_type = 'OPTIONS' {_BY_STRIKE} 40)""")
def q_atm_two_pass_all_options(spark, d):
    return atm.atm_two_pass(_tm(spark, d), _futures_quotes(spark, d), atm_only=False, options_limit=40)


@query("atm_two_pass_no_futures", with_ctes("token_master") + f"""
{_FETCH} {_EQUITY.format('')} union all {_FETCH} (select * from token_master where token_type = 'OPTIONS')""")
def q_atm_two_pass_no_futures(spark, d):
    """No quote of a future came in: all options are asked for."""
    return atm.atm_two_pass(_tm(spark, d), _futures_quotes(spark, d).where("ltp is null"))


register("first_futures", ["token_master"], "select token, name from token_master where token_type = 'FUTURES' order by token limit 5")


@query("atm_two_pass_few_futures", with_ctes("token_master", "ticks", "first_futures") + f""",
few as (select f.name, max_by(t.ltp, (t.timestamp, t.symbol_token)) as futures_price
        from (select * from ticks where exchange = 'NFO' and trading_symbol like '%FUT') t
        join first_futures f on t.symbol_token = f.token group by f.name)
{_FETCH} {_EQUITY.format('')} union all
{_FETCH} (select o.* from token_master o join few p on o.name = p.name where o.token_type = 'OPTIONS'
          and o.strike is not null and abs(p.futures_price - o.strike) <= 2 * {_DIST})""")
def q_atm_two_pass_few_futures(spark, d):
    return atm.atm_two_pass(_tm(spark, d), _futures_quotes(spark, d), strike_buffer=2, futures_limit=5)


@query("second_pass_ticks", with_ctes("token_master", "near_atm", "ticks", "option_ticks") + f""",
wanted as (select token from {_EQUITY.format('order by token limit 7')}
           union select token from (select * from near_atm {_BY_STRIKE} 25))
select symbol_token, cast(ltp as double) as ltp, timestamp from (
  select symbol_token, ltp, timestamp from ticks union all select symbol_token, ltp, timestamp from option_ticks)
where symbol_token in (select token from wanted)""")
def q_second_pass_ticks(spark, d):
    """The stored quotes of the tokens that the second pass asks for."""
    path = scratch_path(spark, "tick-store")
    stored = adapters.ticks(spark, d, with_week52=False).unionByName(adapters.option_ticks(spark, d))
    tick_store.write_ticks(stored, path)
    wanted = atm.atm_two_pass(_tm(spark, d), _futures_quotes(spark, d), equity_limit=7, options_limit=25)
    return tick_store.ticks_of(spark, path, wanted).select("symbol_token", "ltp", "timestamp")


def _with_digits(df):
    """Every other name begins with a digit, as some listed names do."""
    return df.withColumn("name", F.when(F.length("name") % 2 == 0, F.concat(F.lit("3M"), "name")).otherwise(F.col("name")))


register("digit_master", ["token_master"], """
select * replace (case when length(name) % 2 = 0 then '3M' || name else name end as name) from token_master""")


@query("straddle_by_contract", with_ctes("digit_master", "ticks", "option_ticks") + """,
prices as (select tm.name, max_by(t.ltp, (t.timestamp, t.symbol_token)) as futures_price
           from (select * from ticks where exchange = 'NFO' and trading_symbol like '%FUT') t
           join (select token, name from digit_master where token_type = 'FUTURES') tm on t.symbol_token = tm.token
           group by tm.name),
legs as (select * from (
           select o.*, regexp_extract(o.symbol, '(CE|PE)$', 1) as kind,
                  row_number() over (partition by o.name, regexp_extract(o.symbol, '(CE|PE)$', 1)
                                     order by abs(o.strike - p.futures_price), o.strike, o.expiry, o.token) as rn
           from digit_master o join prices p on o.name = p.name
           where o.token_type = 'OPTIONS' and o.strike is not null and regexp_extract(o.symbol, '(CE|PE)$', 1) <> '')
         where rn = 1),
newest as (select symbol_token, max_by(ltp, timestamp) as ltp from option_ticks group by 1)
select name, cast(max(strike) filter (where kind = 'CE') as double) as ce_strike,
       cast(max(strike) filter (where kind = 'PE') as double) as pe_strike,
       cast(max(ltp) filter (where kind = 'CE') as double) as ce_price,
       cast(max(ltp) filter (where kind = 'PE') as double) as pe_price, cast(sum(ltp) as double) as atm_price
from legs left join newest on token = symbol_token group by name""")
def q_straddle_by_contract(spark, d):
    tm = _with_digits(_tm(spark, d))
    return atm.straddle_by_contract(tm, _prices(spark, d, tm), adapters.option_ticks(spark, d))


@query("project_token_master", with_ctes("token_master") + """
select token, symbol, name, expiry, cast(strike as double) as strike, lotsize, instrumenttype, exch_seg,
       cast(tick_size as double) as tick_size, token_type, futures_token,
       cast(strike_distance as double) as strike_distance
from token_master""")
def q_project_token_master(spark, d):
    from quantbeam.schemas import TOKEN_MASTER_COLUMNS
    return _tm(spark, d).select(*TOKEN_MASTER_COLUMNS)


@query("tag_token_type", with_ctes("token_master") + """
select token, token_type, futures_token, instrumenttype from token_master""")
def q_tag_token_type(spark, d):
    return _tm(spark, d).select("token", "token_type", "futures_token", "instrumenttype")


@query("adjacent_diff", with_ctes("opt_base") + """
select name, cast(strike as double) as strike,
       cast(round(lead(strike) over (partition by name order by strike) - strike, 2) as double) as next_gap
from (select distinct name, strike from opt_base where strike is not null)""")
def q_adjacent_diff(spark, d):
    from pyspark.sql import Window
    o = tk.normalize_strike(tk.coerce_numeric(tk.nearest_expiry(tk.filter_options(_raw(spark, d)))))
    s = o.where(F.col("strike").isNotNull()).select("name", "strike").distinct()
    w = Window.partitionBy("name").orderBy("strike")
    return s.select("name", "strike", F.round(F.lead("strike").over(w) - F.col("strike"), 2).alias("next_gap"))


@query("closest_strike", with_ctes("token_master", "fut_prices") + """
select name, option_type, cast(strike as double) as strike, cast(atm_distance as double) as atm_distance
from (select o.name, nullif(regexp_extract(o.symbol, '(CE|PE)$', 1), '') as option_type, o.strike,
             abs(o.strike - p.futures_price) as atm_distance,
             row_number() over (partition by o.name, nullif(regexp_extract(o.symbol, '(CE|PE)$', 1), '')
                                order by abs(o.strike - p.futures_price), o.strike, o.expiry, o.token) as rn
      from token_master o join fut_prices p on o.name = p.name
      where o.token_type = 'OPTIONS' and o.strike is not null and regexp_extract(o.symbol, '(CE|PE)$', 1) <> '')
where rn = 1""")
def q_closest_strike(spark, d):
    tm = _tm(spark, d)
    return atm.closest_strikes(tm, _prices(spark, d, tm)).select("name", "option_type", "strike", "atm_distance")


@query("union_fetch_set", with_ctes("token_master", "fut_prices") + """
select token, name, exch_seg, token_type from token_master where token_type = 'EQUITY'
union all
select token, name, exch_seg, token_type from (
  select o.*, row_number() over (partition by o.name, nullif(regexp_extract(o.symbol, '(CE|PE)$', 1), '')
                                 order by abs(o.strike - p.futures_price), o.strike, o.expiry, o.token) as rn
  from token_master o join fut_prices p on o.name = p.name
  where o.token_type = 'OPTIONS' and o.strike is not null and regexp_extract(o.symbol, '(CE|PE)$', 1) <> '')
where rn = 1""")
def q_union_fetch_set(spark, d):
    tm = _tm(spark, d)
    t = ticks_ops.filter_future_symbols(ticks_ops.filter_exchange(adapters.ticks(spark, d, with_week52=False), "NFO"))
    return atm.atm_two_pass(tm, t, exact_atm_only=True)


@query("scalar_format_date", with_ctes("token_master") + """
select token, strftime(expiry, '%Y-%m-%d') as expiry_text from token_master""")
def q_scalar_format_date(spark, d):
    return _tm(spark, d).select("token", sc.format_date("expiry").alias("expiry_text"))


@query("scalar_now", with_ctes("token_master") + """
select cast(1 as bigint) as n_stamps, count(*) as n_rows, true as within_the_run from token_master""")
def q_scalar_now(spark, d):
    """One stamp for all rows, of this run."""
    stamp, now = F.col("created_at").cast("timestamp_ntz"), F.localtimestamp()
    return tk.build_token_master(_raw(spark, d)).agg(
        F.count_distinct("created_at").alias("n_stamps"), F.count(F.lit(1)).alias("n_rows"),
        (F.min(stamp).between(now - F.expr("interval 1 hour"), now + F.expr("interval 1 second"))).alias("within_the_run"))
