"""DuckDB text of the adapter views, used as WITH-prefixes by oracle SQL.

Each CTE mirrors one function of ``quantbeam.sources.adapters`` so an
oracle query can run on the same parquet tables the driver registers.
"""

from __future__ import annotations

_CTES: dict[str, tuple[list[str], str]] = {}


def _add(name: str, deps: list[str], body: str) -> None:
    _CTES[name] = (deps, body.strip())


_add("underlyings", [], """
select distinct user_id as uid,
       translate(cast(user_id as varchar), '0123456789', 'ABCDEFGHIJ') as name
from events""")

_add("ticks", ["underlyings"], """
select case when e.event_type in ('view', 'error') then 'NSE' else 'NFO' end as exchange,
       u.name || case e.event_type when 'purchase' then '27MAR25FUT' when 'click' then '27MAR25100CE'
                                   when 'signup' then '27MAR25100PE' else '-EQ' end as trading_symbol,
       case e.event_type when 'purchase' then 'F' when 'click' then 'C'
                         when 'signup' then 'P' else 'E' end || cast(e.user_id as varchar) as symbol_token,
       cast(e.value as decimal(18,6)) as ltp,
       cast(e.value * 0.98 as decimal(18,6)) as open, cast(e.value * 1.02 as decimal(18,6)) as high,
       cast(e.value * 0.97 as decimal(18,6)) as low, cast(e.value as decimal(18,6)) as close,
       cast(null as integer) as last_trade_qty,
       cast(null as timestamp) as exch_feed_time, cast(null as timestamp) as exch_trade_time,
       cast(null as decimal(18,6)) as net_change,
       cast((e.event_id % 11) - 5 as decimal(18,6)) as percent_change,
       cast(null as decimal(18,6)) as avg_price,
       cast(e.event_id % 1000 as bigint) as trade_volume, cast(e.event_id % 97 as bigint) as opn_interest,
       cast(null as decimal(18,6)) as lower_circuit, cast(null as decimal(18,6)) as upper_circuit,
       cast(null as bigint) as tot_buy_quan, cast(null as bigint) as tot_sell_quan,
       cast(min(e.value) over (partition by e.user_id) as decimal(18,6)) as week_low_52,
       cast(max(e.value) over (partition by e.user_id) as decimal(18,6)) as week_high_52,
       e.props as depth_json, e.ts as timestamp
from events e join underlyings u on e.user_id = u.uid""")

_add("option_ticks", ["underlyings"], """
select kind || cast(part as varchar) || '_' || cast(user_id as varchar) as symbol_token, ltp, timestamp from (
  select user_id, case event_type when 'click' then 'CE' when 'signup' then 'PE' end as kind,
         user_id + (select count(*) from underlyings where uid is not null) * (event_id % 4) as part,
         cast(value as decimal(18,6)) as ltp, ts as timestamp
  from events where user_id is not null)
where kind is not null""")


def bars_sql(where: str = "true") -> str:
    """Daily bars of the lines that meet ``where``."""
    order = "l_orderkey*1000000000 + l_linenumber*100000000 + l_partkey"
    day = "cast(l_shipdate as date)"
    return f"""
select 'E' || cast(l_suppkey as varchar) as token,
       translate(cast(l_suppkey as varchar), '0123456789', 'ABCDEFGHIJ') as symbol_name,
       cast({day} as timestamp) as timestamp,
       cast(min_by(l_extendedprice, {order}) as decimal(18,6)) as open,
       cast(max(l_extendedprice) as decimal(18,6)) as high, cast(min(l_extendedprice) as decimal(18,6)) as low,
       case when l_suppkey % 5 = 0 and day({day}) = 13 then null
            when l_suppkey % 7 = 3 and day({day}) = 27 then 0
            else cast(max_by(l_extendedprice, {order}) as decimal(18,6)) end as close,
       cast(sum(l_quantity) as bigint) as volume
from lineitem where {where} group by l_suppkey, {day}"""


_add("bars", [], bars_sql())

_add("raw_instruments", ["underlyings"], """
select 'E' || cast(uid as varchar) as token, name || '-EQ' as symbol, name, '' as expiry, '-1.000000' as strike,
       '1' as lotsize, '' as instrumenttype, 'NSE' as exch_seg, '5.000000' as tick_size from underlyings
union all
select x.p || cast(uid as varchar), name || x.e || 'FUT', name, x.e, '-1.000000',
       cast(50 + 25 * (uid % 4) as varchar), 'FUTSTK', 'NFO', '5.000000'
from underlyings cross join (select 'F' as p, '27MAR2025' as e union all select 'G', '24APR2025') x
union all
select x.o || cast(p_partkey as varchar) || '_' || cast(uid as varchar),
       name || x.e || cast(p_size as varchar) || x.o, name, x.e, cast(p_size * 1000 as varchar) || '.000000',
       cast(50 + 25 * (uid % 4) as varchar), 'OPTSTK', 'NFO', '5.000000'
from part cross join (select count(*) as n from underlyings) z
     join underlyings on p_partkey % n = uid
     cross join (select 'CE' as o, '27MAR2025' as e union all select 'PE', '27MAR2025'
                 union all select 'CE', '24APR2025') x""")


def register(name: str, deps: list[str], body: str) -> None:
    """Add a derived CTE (e.g. token_master built from raw_instruments)."""
    _add(name, deps, body)


def with_ctes(*names: str) -> str:
    """WITH-prefix holding the named CTEs and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "with " + ",\n".join(f"{n} as (\n{_CTES[n][1]}\n)" for n in order) + "\n"
