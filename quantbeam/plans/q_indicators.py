"""Checkable bar and indicator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantbeam.operators import indicators as ind
from quantbeam.operators import tokens as tk
from quantbeam.plans.catalog import query
from quantbeam.plans import q_tokens  # noqa: F401  (registers token_master CTEs)
from quantbeam.plans.oracle_ctes import register, with_ctes
from quantbeam.schemas import WIDE_INDICATOR_COLUMNS
from quantbeam.sources import adapters

register("ranked_bars", ["bars"], """
select *, row_number() over (partition by token order by timestamp desc) as rn from bars""")


def _branch_sql(name: str, p: int, ranked: str = "ranked_bars") -> str:
    """One indicator over its fetch window. ``prev_i``: index of the last known
    close before the row; ``filled``: the last known close."""
    k = ind.fetch_len(p)
    w = "partition by token order by timestamp"
    run = f"over ({w} rows between unbounded preceding and current row)"
    last_p = f"over ({w} rows between {p - 1} preceding and current row)"
    source = f"""(select *, cast(close as double) as x, count(*) over (partition by token) as n,
       count(*) over (partition by token) - rn as i from {ranked} where rn <= {k})"""
    if name == "sma":
        v = f"case when count(x) {last_p} = {p} then avg(close) {last_p} end"
    elif name == "ema":
        a = 2.0 / (p + 1)
        q = 1.0 - a
        rest = f"pow({q!r}, i - prev_i)"
        source = f"""(select *, max(case when x is not null then i end) over ({w} rows between unbounded preceding
       and 1 preceding) as prev_i from {source})"""
        source = f"""(select *, count(*) filter (where x is not null and i - prev_i = 1) {run} as steps,
       coalesce(sum(case when x is not null and i - prev_i > 1 then ln({rest} / ({rest} + {a!r})) end) {run}, 0.0) as gaps
       from {source})"""
        v = (f"case when count(x) {run} > 0 then pow({q!r}, steps) * exp(gaps) * sum(case when x is null then 0.0 "
             f"when prev_i is null then x when i - prev_i = 1 then {a!r} * x * (pow({q!r}, -steps) * exp(-gaps)) "
             f"else {a!r} / ({rest} + {a!r}) * x * (pow({q!r}, -steps) * exp(-gaps)) end) {run} end")
    elif name == "rsi":
        r = 1.0 - 1.0 / p
        source = f"(select *, x - lag(x) over ({w}) as d from {source})"
        v = (f"case when count(d) {run} >= {p} then 100.0 * sum(greatest(d, 0.0) * pow({r!r}, -i)) {run} "
             f"/ nullif(sum(abs(d) * pow({r!r}, -i)) {run}, 0.0) end")
    else:
        source = f"(select *, last_value(x ignore nulls) {run} as filled from {source})"
        source = f"(select *, filled / nullif(lag(filled) over ({w}), 0.0) - 1.0 as ret from {source})"
        v = f"case when count(ret) {last_p} = {p} then stddev_samp(ret) {last_p} * sqrt({ind.ANNUALISATION}) end"
    return f"""
select token, symbol_name, '{name}' as indicator_name, timestamp,
       cast(cast({v} as decimal(18,6)) as double) as value, {p} as period
from {source}
where n >= {p}"""


def _long_sql(configs, ranked: str = "ranked_bars") -> str:
    parts = [f"select * from ({_branch_sql(n, p, ranked)}) where value is not null" for n, p in configs]
    return "\nunion all\n".join(parts)


register("ind_long", ["ranked_bars"], _long_sql(ind.ALL_CONFIGS))


def _bars(spark, d):
    return adapters.bars(spark, d)


def _cfg(name):
    return [(n, p) for n, p in ind.ALL_CONFIGS if n == name]


@query("src_bars", with_ctes("bars") + """
select token, symbol_name, timestamp, cast(open as double) as open, cast(high as double) as high,
       cast(low as double) as low, cast(close as double) as close, volume from bars""")
def q_bars(spark, d):
    return _bars(spark, d)


@query("fetch_window", with_ctes("ranked_bars") + """
select token, timestamp, n, i from (
  select *, count(*) over (partition by token) as n, count(*) over (partition by token) - rn as i
  from ranked_bars where rn <= 300) where n >= 200""")
def q_fetch_window(spark, d):
    return ind.fetch_window(ind.rank_bars(_bars(spark, d), 300), 200).select("token", "timestamp", "n", "i")


for _name in ["sma", "ema", "rsi", "volatility"]:
    def _make(name):
        def fn(spark, d):
            return ind.indicators_long(_bars(spark, d), _cfg(name))
        return fn
    query(_name, with_ctes("ranked_bars") + _long_sql(_cfg(_name)))(_make(_name))


@query("indicators_long", with_ctes("ind_long") + "select * from ind_long")
def q_indicators_long(spark, d):
    return ind.indicators_long(_bars(spark, d))


AS_OF = ["1996-12-31", "1998-06-30"]
for _k, _day in enumerate(AS_OF):
    register(f"ranked_as_of_{_k}", ["bars"], f"""
select *, row_number() over (partition by token order by timestamp desc) as rn from bars
where timestamp <= timestamp '{_day}'""")
    register(f"long_as_of_{_k}", [f"ranked_as_of_{_k}"], _long_sql(ind.ALL_CONFIGS, f"ranked_as_of_{_k}"))


@query("indicators_as_of", with_ctes("long_as_of_0", "long_as_of_1") + """
select * from long_as_of_1
union all
select o.* from long_as_of_0 o anti join long_as_of_1 n on o.token = n.token
  and o.indicator_name = n.indicator_name and o.period = n.period and o.timestamp = n.timestamp""")
def q_indicators_as_of(spark, d):
    """Two snapshots, one after the other, in the table that holds them by key."""
    from quantbeam.operators.upserts import upsert_indicators
    older, newer = (ind.indicators_as_of(_bars(spark, d), day) for day in AS_OF)
    return upsert_indicators(older, newer)


@query("daily_return", with_ctes("bars") + """
select token, timestamp, filled / nullif(lag(filled) over (partition by token order by timestamp), 0.0) - 1.0
         as daily_return
from (select *, last_value(cast(close as double) ignore nulls) over (partition by token order by timestamp
                rows between unbounded preceding and current row) as filled from bars)""")
def q_daily_return(spark, d):
    return ind.daily_return(_bars(spark, d)).select("token", "timestamp", "daily_return")


@query("drop_null_indicator", with_ctes("ranked_bars") + _long_sql([("rsi", 14)]))
def q_drop_null_indicator(spark, d):
    return ind.indicators_long(_bars(spark, d), [("rsi", 14)])


@query("latest_bar_per_token", with_ctes("ranked_bars") + """
select token, cast(timestamp as date) as trade_date, cast(close as double) as last_close, volume as last_volume
from ranked_bars where rn = 1""")
def q_latest_bar_per_token(spark, d):
    return ind.latest_bar_per_token(_bars(spark, d))


@query("sort_bars_asc", with_ctes("bars") + """
select token, timestamp, row_number() over (partition by token order by timestamp) as seq from bars""")
def q_sort_bars_asc(spark, d):
    from pyspark.sql import Window
    w = Window.partitionBy("token").orderBy("timestamp")
    return _bars(spark, d).select("token", "timestamp", F.row_number().over(w).cast("bigint").alias("seq"))


@query("latest_indicator_value", with_ctes("ind_long") + """
select token, indicator_name, period, max_by(value, timestamp) as value, max(timestamp) as timestamp
from ind_long group by 1, 2, 3""")
def q_latest_indicator_value(spark, d):
    return ind.latest_indicator_value(ind.indicators_long(_bars(spark, d)))


_WIDE_SEL = ",\n       ".join(
    f"max_by(value, timestamp) filter (where indicator_name || '_' || cast(period as varchar) = '{c}') as {c}"
    for c in WIDE_INDICATOR_COLUMNS)

register("latest_bar", ["ranked_bars"], """
select token, cast(timestamp as date) as trade_date, close as last_close, volume as last_volume
from ranked_bars where rn = 1""")
register("ind_pivot", ["ind_long", "latest_bar"], f"""
select l.token, {_WIDE_SEL}
from ind_long l join latest_bar b on l.token = b.token and cast(l.timestamp as date) = b.trade_date
group by l.token""")
register("ind_wide", ["token_master", "latest_bar", "ind_pivot"], f"""
select t.token, t.name as symbol_name, b.trade_date,
       {", ".join(f"cast(cast(p.{c} as decimal(18,6)) as double) as {c}" for c in WIDE_INDICATOR_COLUMNS)},
       cast(b.last_close as double) as last_close, b.last_volume
from token_master t join latest_bar b on t.token = b.token left join ind_pivot p on t.token = p.token
where t.token_type = 'EQUITY'""")


@query("indicator_pivot_wide", with_ctes("ind_pivot") + "select * from ind_pivot")
def q_indicator_pivot_wide(spark, d):
    b = _bars(spark, d)
    return ind.indicator_pivot_wide(ind.indicators_long(b), ind.latest_bar_per_token(b))


def _tm_equity(spark, d):
    tm = tk.build_token_master(adapters.raw_instruments(spark, d)).drop("created_at")
    return tm.where(F.col("token_type") == tk.TYPE_EQUITY)


@query("indicators_wide", with_ctes("ind_wide") + "select * from ind_wide")
def q_indicators_wide(spark, d):
    return ind.indicators_wide(_tm_equity(spark, d), _bars(spark, d))


@query("indicators_wide_from_long", with_ctes("ind_wide") + "select * from ind_wide")
def q_indicators_wide_from_long(spark, d):
    b = _bars(spark, d)
    return ind.indicators_wide(_tm_equity(spark, d), b, ind.indicators_long(b))


register("coverage", ["token_master", "ind_long"], f"""
select c.indicator_name, c.period, count(l.token) as success, count(*) filter (where l.token is null) as errors,
       count(*) as total, round(count(l.token) * 100.0 / count(*), 2) as success_rate
from (select t.token, x.indicator_name, x.period from token_master t
      cross join (values {", ".join(f"('{n}', {p})" for n, p in ind.ALL_CONFIGS)}) x(indicator_name, period)
      where t.token_type = 'EQUITY') c
left join (select distinct token, indicator_name, period from ind_long) l
  on c.token = l.token and c.indicator_name = l.indicator_name and c.period = l.period
group by 1, 2""")


@query("indicator_coverage", with_ctes("coverage") + "select * from coverage")
def q_indicator_coverage(spark, d):
    return ind.indicator_coverage(_tm_equity(spark, d), ind.indicators_long(_bars(spark, d)))


@query("indicator_coverage_total", with_ctes("coverage") + """
select cast(sum(success) as bigint) as overall_success, cast(sum(errors) as bigint) as overall_errors,
       count(*) as indicators_processed from coverage""")
def q_indicator_coverage_total(spark, d):
    return ind.coverage_totals(ind.indicator_coverage(_tm_equity(spark, d), ind.indicators_long(_bars(spark, d))))


@query("lookup_indicator_value", with_ctes("ind_long") + """
select token, indicator_name, period, value, timestamp from ind_long
where token = 'E4' and indicator_name = 'ema' and period = 50 order by timestamp desc limit 1""")
def q_lookup_indicator_value(spark, d):
    return ind.lookup_indicator_value(ind.indicators_long(_bars(spark, d)), "E4", "ema", 50)


@query("bars_per_token", with_ctes("bars") + """
select token, n_bars, sample_rank, timestamp, cast(close as double) as close from (
  select token, timestamp, close, count(*) over (partition by token) as n_bars,
         row_number() over (partition by token order by timestamp desc) as sample_rank from bars)
where sample_rank <= 2""")
def q_bars_per_token(spark, d):
    return ind.bars_per_token(_bars(spark, d), 2)


@query("filter_history_range", with_ctes("bars") + """
select token, timestamp, cast(close as double) as close from bars
where timestamp between timestamp '1995-01-01 09:15:00' and timestamp '1997-06-30 15:30:00'""")
def q_filter_history_range(spark, d):
    b = ind.filter_history_range(_bars(spark, d), "1995-01-01 09:15:00", "1997-07-01 10:00:00")
    return b.select("token", "timestamp", "close")
