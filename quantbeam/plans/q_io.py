"""Checkable upserts, sources, sinks and streams.

Sources are checked by round trips: Spark writes the derived tables in
the landing format to a scratch folder under the shared checkpoint
location, the source reads them back, and the oracle is the SQL of the
original table.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quantbeam.operators import indicators as ind
from quantbeam.operators import ticks as tk_ops
from quantbeam.operators import tokens as tk
from quantbeam.operators import upserts as up
from quantbeam.operators.filters import rows_as_json
from quantbeam.plans.catalog import query
from quantbeam.plans.oracle_ctes import bars_sql, register, with_ctes
from quantbeam.plans.q_summary import _MS, _ms_cols, build_market_summary, stored_summary
from quantbeam.functions.scalars import FEED_TIME_FORMAT
from quantbeam.schemas import (DEC, DEPTH, MARKET_SUMMARY, REALTIME_MARKET_DATA, TICK_COLUMNS, TOKEN_MASTER,
                               TOKEN_MASTER_COLUMNS, WIDE_INDICATOR_COLUMNS)
from quantbeam.session import mark, materialize, release
from quantbeam.sources import adapters, landing, sinks
from quantbeam.sources.tables import read_table
from quantbeam.streaming import ticks_stream as st

# ---- restated batches derived from the driver tables ---------------------------

register("bars_old", [], bars_sql("l_returnflag in ('N', 'A')"))
register("bars_new", [], bars_sql("l_returnflag = 'R'"))
# Two files of candles: the bars, then some of them again and bars of another size.
register("bars_batch", ["bars_new"], """
select token, symbol_name, 'ONE_DAY' as interval, timestamp, open, high, low, close, volume, 1 as seq from bars_new
union all
select token, symbol_name, 'ONE_DAY', timestamp, open, high, low, close + 1, volume + 1, 2 from bars_new where volume % 3 = 0
union all
select token, symbol_name, 'ONE_HOUR', timestamp, open, high, low, close + 2, volume, 2 from bars_new where volume % 5 = 0""")


def _bars_batch(spark, d, flags):
    li = read_table(spark, d, "lineitem").where(F.col("l_returnflag").isin(*flags))
    return adapters.bars(spark, d, lineitem=li)


def _candle_docs(b, interval: str | None = None):
    """Candle pages per (token, year): bounded by the calendar."""
    candle = F.array(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
                     *[F.col(c).cast("string") for c in ["open", "high", "low", "close", "volume"]])
    return (b.groupBy("token", F.year("timestamp").alias("y"))
             .agg(F.first("symbol_name").alias("name"), F.lit(interval).alias("interval"),
                  F.collect_list(candle).alias("data")).drop("y"))


def _land(docs, path: str) -> None:
    """Add compressed files to a landing folder, at the frame's own parallelism;
    small enough that readers, who cannot split them, have many."""
    docs.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 100_000).json(path)


_BAR_COLS = ["open", "high", "low", "close"]


@query("upsert_bars", with_ctes("bars_old", "bars_batch") + f""",
o as (select *, 'ONE_DAY' as interval from bars_old),
n as (select * from bars_batch qualify row_number() over (partition by token, interval, timestamp order by seq desc) = 1)
select coalesce(n.token, o.token) as token, coalesce(n.interval, o.interval) as interval,
       coalesce(n.timestamp, o.timestamp) as timestamp,
       case when n.token is not null then n.symbol_name else o.symbol_name end as symbol_name,
       {", ".join(f"cast(case when n.token is not null then n.{c} else o.{c} end as double) as {c}" for c in _BAR_COLS)},
       case when n.token is not null then n.volume else o.volume end as volume
from o full outer join n on o.token = n.token and o.interval = n.interval and o.timestamp = n.timestamp""")
def q_upsert_bars(spark, d):
    path, new = sinks.scratch_path(spark, "candles"), _bars_batch(spark, d, ["R"])
    _land(_candle_docs(new), path)
    again = new.where(F.col("volume") % 3 == 0).withColumns({"close": F.col("close") + 1, "volume": F.col("volume") + 1})
    hours = new.where(F.col("volume") % 5 == 0).withColumn("close", F.col("close") + 2)
    _land(_candle_docs(again).unionByName(_candle_docs(hours, "ONE_HOUR")), path)
    return up.upsert_bars(_bars_batch(spark, d, ["N", "A"]), landing.read_candles_json(spark, path, arrival=True))


# ---- quotes with all fields ------------------------------------------------------

register("quotes", ["ticks"], """
select exchange, trading_symbol, symbol_token, ltp, open, high, low, close,
       cast(trade_volume % 50 as integer) as last_trade_qty, date_trunc('second', timestamp) as exch_feed_time,
       case when trade_volume % 4 > 0 then date_trunc('second', timestamp) - interval 1 second end as exch_trade_time,
       cast(ltp - low as decimal(18,6)) as net_change, percent_change, cast(low + 1 as decimal(18,6)) as avg_price,
       trade_volume, opn_interest, cast(ltp - 5 as decimal(18,6)) as lower_circuit,
       cast(ltp + 5 as decimal(18,6)) as upper_circuit, trade_volume * 10 as tot_buy_quan,
       trade_volume * 7 as tot_sell_quan, week_low_52, week_high_52,
       case when trade_volume % 3 = 0 then '{}' else
         '{"buy":[{"price":' || cast(trade_volume % 100 + 0.25 as double) || ',"quantity":' || opn_interest ||
         ',"orders":1}],"sell":[]}' end as depth_json, timestamp
from ticks""")

#: Which answers failed, and which quotes come twice in one answer.
_FAILED = "trade_volume % 211 = 5"
_TWICE = "trade_volume % 5 = 0"
#: How quotes are restated, by column; expressions that both engines know.
_AGAIN = {"exchange": "exchange || '*'", "ltp": "cast(ltp + 1 as decimal(18,6))",
          "net_change": "cast(7 as decimal(18,6))", "percent_change": "cast(null as decimal(18,6))",
          "trade_volume": "trade_volume + 1", "week_low_52": "cast(null as decimal(18,6))", "depth_json": "'{}'"}
_LATER = {"exchange": "exchange || '#'", "ltp": "cast(ltp + 2 as decimal(18,6))", "high": "cast(null as decimal(18,6))",
          "net_change": "cast(8 as decimal(18,6))", "tot_buy_quan": "cast(1 as bigint)", "depth_json": "'{}'"}
_NEXT = {"timestamp": "timestamp + interval 1 second"}


def _changed_sql(changes: dict[str, str], where: str, seq: int, table: str = "quotes") -> str:
    cols = ", ".join(f"{changes[c]} as {c}" if c in changes else c for c in TICK_COLUMNS)
    return f"select {cols}, {seq} as seq from {table} where {where}"


def _changed(rows, changes: dict[str, str], where: str = "true"):
    """Quotes as they are restated; without the depth that goes with them."""
    new = rows.where(where).withColumns({c: F.expr(e) for c, e in changes.items()})
    return new.withColumn("depth", F.lit(None).cast(DEPTH)) if "depth_json" in changes else new


def _out(alias: str = "") -> str:
    """All columns of a tick, decimals as doubles."""
    at = f"{alias}." if alias else ""
    return ", ".join(f"cast({at}{f.name} as double) as {f.name}" if f.dataType == DEC else f"{at}{f.name}"
                     for f in REALTIME_MARKET_DATA.fields)


def _reduced_sql(batch: str) -> str:
    """A batch's rows by key: updated columns of the last, others of the first."""
    cols = ", ".join(f"{'z' if c in up.TICK_UPDATE_COLUMNS else 'a'}.{c}" for c in TICK_COLUMNS)
    one = "select * from {} qualify row_number() over (partition by symbol_token, timestamp order by seq{}) = 1"
    return (f"select {cols} from ({one.format(batch, '')}) a join ({one.format(batch, ' desc')}) z "
            "on a.symbol_token = z.symbol_token and a.timestamp = z.timestamp")


def _merged_sql(old: str, new: str) -> str:
    cols = []
    for c in TICK_COLUMNS:
        first, second = ("n", "o") if c in up.TICK_UPDATE_COLUMNS else ("o", "n")
        cols.append(f"case when {first}.symbol_token is not null then {first}.{c} else {second}.{c} end as {c}")
    return (f"select {', '.join(cols)} from {old} o full outer join {new} n "
            "on o.symbol_token = n.symbol_token and o.timestamp = n.timestamp")


def _quotes(spark, d):
    """The derived ticks with every field that a quote has, and its depth."""
    tv, oi, low = F.col("trade_volume"), F.col("opn_interest"), F.col("low")
    level = F.struct((tv % 100 + F.lit(0.25)).cast("double").alias("price"), oi.alias("quantity"),
                     F.lit(1).cast("bigint").alias("orders"))
    depth = F.when(tv % 3 != 0, F.struct(F.array(level).alias("buy"), F.array().cast(DEPTH["sell"].dataType).alias("sell")))
    second = F.date_trunc("second", "timestamp").cast("timestamp_ntz")
    return adapters.ticks(spark, d).withColumns({
        "last_trade_qty": (tv % 50).cast("int"), "exch_feed_time": second,
        "exch_trade_time": F.when(tv % 4 > 0, second - F.expr("interval 1 second")),
        "net_change": (F.col("ltp") - low).cast(DEC), "avg_price": (low + 1).cast(DEC),
        "lower_circuit": (F.col("ltp") - 5).cast(DEC), "upper_circuit": (F.col("ltp") + 5).cast(DEC),
        "tot_buy_quan": tv * 10, "tot_sell_quan": tv * 7, "depth": depth,
        "depth_json": F.coalesce(F.to_json(depth), F.lit("{}"))})


def _quote(changes: dict[str, str] | None = None):
    """A quote as it is delivered."""
    fields = []
    for field, column in landing.QUOTE_FIELDS.items():
        c = F.expr((changes or {}).get(column, column))
        if column in ("exch_feed_time", "exch_trade_time"):
            c = F.coalesce(F.date_format(c, FEED_TIME_FORMAT), F.lit(""))
        fields.append(c.alias(field))
    depth = F.lit(None).cast(DEPTH) if "depth_json" in (changes or {}) else F.col("depth")
    return F.struct(*fields, depth.alias("depth"))


def _envelopes(quotes, twice: bool = True):
    """Answers: one quote or two of one key, up to two that were not fetched,
    and answers that failed."""
    missing = F.struct("exchange", F.col("symbol_token").alias("symbolToken"), F.lit("no data").alias("message"),
                       F.lit("AB4006").alias("errorCode"))
    fetched = F.when(F.expr(_TWICE), F.array(_quote(), _quote(_AGAIN))) if twice else F.when(F.lit(False), F.array(_quote()))
    data = F.struct(fetched.otherwise(F.array(_quote())).alias("fetched"),
                    F.slice(F.array(missing, missing), F.lit(1), (F.col("opn_interest") % 3).cast("int")).alias("unfetched"))
    failed = F.expr(_FAILED) if twice else F.lit(False)
    return quotes.select((~failed).alias("status"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fetched_at"),
                         F.when(~failed, data).alias("data"))


# The quotes of all answers in order of arrival; what an upsert makes of them.
register("quotes_fetched", ["quotes"], _changed_sql({}, f"not ({_FAILED})", 0) + " union all "
         + _changed_sql(_AGAIN, f"{_TWICE} and not ({_FAILED})", 1))
register("quotes_stored", ["quotes_fetched"], _reduced_sql("quotes_fetched"))
# Two files that restate quotes; the newer is the smaller, and the reverse.
register("small_last", ["quotes"], " union all ".join((
    _changed_sql(_AGAIN, "percent_change > 0", 1), _changed_sql(_LATER, "percent_change > 3", 2),
    _changed_sql(_NEXT, "percent_change < -3", 2))))
register("large_last", ["quotes"], " union all ".join((
    _changed_sql(_LATER, "percent_change > 3", 1), _changed_sql(_AGAIN, "percent_change > 0", 2),
    _changed_sql(_NEXT, "percent_change < -3", 2))))
register("small_last_once", ["small_last"], _reduced_sql("small_last"))
register("large_last_once", ["large_last"], _reduced_sql("large_last"))
register("quotes_small_last", ["quotes", "small_last_once"], _merged_sql("quotes", "small_last_once"))
register("quotes_large_last", ["quotes_stored", "large_last_once"], _merged_sql("quotes_stored", "large_last_once"))


@query("upsert_ticks_partial", with_ctes("quotes_small_last") + f"select {_out()} from quotes_small_last")
def q_upsert_ticks_partial(spark, d):
    quotes = _quotes(spark, d)
    path = sinks.scratch_path(spark, "restated")
    for part in (_changed(quotes, _AGAIN, "percent_change > 0"),
                 _changed(quotes, _LATER, "percent_change > 3").unionByName(_changed(quotes, _NEXT, "percent_change < -3"))):
        part.select(*TICK_COLUMNS).write.mode("append").parquet(path)
    return up.upsert_ticks_partial(quotes.select(*TICK_COLUMNS), landing.read_batch(spark, path, REALTIME_MARKET_DATA))


register("rsi_old", ["ind_long"], "select * from ind_long where indicator_name = 'rsi'")
register("rsi_new", ["rsi_old"], """
select token, lower(symbol_name) as symbol_name, indicator_name, timestamp,
       cast(100 - cast(value as decimal(18,6)) as double) as value, period
from rsi_old where value > 50""")


def _rsi_old(spark, d):
    return ind.indicators_long(adapters.bars(spark, d), [("rsi", 14), ("rsi", 21)])


@query("upsert_indicators", with_ctes("rsi_old", "rsi_new") + """
select o.token, o.indicator_name, o.period, o.timestamp,
       case when n.token is not null then n.symbol_name else o.symbol_name end as symbol_name,
       case when n.token is not null then n.value else o.value end as value
from rsi_old o left join rsi_new n on o.token = n.token and o.indicator_name = n.indicator_name
     and o.period = n.period and o.timestamp = n.timestamp""")
def q_upsert_indicators(spark, d):
    old = _rsi_old(spark, d)
    new = (old.where(F.col("value") > 50).withColumn("symbol_name", F.lower("symbol_name"))
              .withColumn("value", (F.lit(100) - F.col("value")).cast("decimal(18,6)")))
    return up.upsert_indicators(old, new).select("token", "indicator_name", "period", "timestamp",
                                                 "symbol_name", "value")


def _wide(spark, d):
    tm = tk.build_token_master(adapters.raw_instruments(spark, d))
    bars = adapters.bars(spark, d)
    return ind.indicators_wide(tm.where(F.col("token_type") == tk.TYPE_EQUITY), bars)


def _wide_new(w):
    return w.where(F.col("rsi_14") > 50).withColumn("last_close", F.col("last_close") * 2)


_WIDE_OUT = ("token, symbol_name, trade_date, "
             + ", ".join(f"cast({c} as double) as {c}" for c in WIDE_INDICATOR_COLUMNS)
             + ", cast(last_close as double) as last_close, last_volume")


@query("replace_by_key", with_ctes("ind_wide_dec") + f"""
select {_WIDE_OUT} from ind_wide_dec where not coalesce(rsi_14 > 50, false)
union all
select {_WIDE_OUT.replace("cast(last_close as double)", "cast(last_close * 2 as double)")}
from ind_wide_dec where rsi_14 > 50""")
def q_replace_by_key(spark, d):
    w = _wide(spark, d)
    return up.replace_by_key(w, _wide_new(w))


@query("anti_existing", with_ctes("ind_wide_dec") + """
select token, symbol_name from ind_wide_dec where not coalesce(rsi_14 > 50, false)""")
def q_anti_existing(spark, d):
    w = _wide(spark, d)
    return up.anti_existing(w, _wide_new(w)).select("token", "symbol_name")


@query("schema_add_missing", with_ctes("eq_tm") + """
select token, symbol, cast(null as double) as strike_distance from eq_tm""")
def q_schema_add_missing(spark, d):
    r = adapters.raw_instruments(spark, d)
    e = tk.equity_tokens(r, tk.futures_tokens(r)).drop("strike_distance").select("token", "symbol")
    return up.schema_add_missing(e)


# ---- source / sink round trips ----------------------------------------------------

@query("src_instruments_json", with_ctes("raw_instruments") + "select * from raw_instruments")
def q_src_instruments_json(spark, d):
    """Files of JSON arrays, as delivered: one of some thousand records each."""
    path = sinks.scratch_path(spark, "instruments")
    raw = adapters.raw_instruments(spark, d)
    files = raw.count() // 5000 + 1
    per_file = F.pmod(F.xxhash64("token"), F.lit(files))
    arrays = raw.groupBy(per_file.alias("bucket")).agg(F.to_json(F.collect_list(F.struct(*raw.columns))).alias("value"))
    arrays.select("bucket", "value").write.partitionBy("bucket").text(path)
    return landing.read_instruments_json(spark, path).select(*raw.columns)


@query("src_candles_json", with_ctes("bars") + """
select token, symbol_name, 'ONE_DAY' as interval, timestamp, cast(open as double) as open, cast(high as double) as high,
       cast(low as double) as low, cast(close as double) as close, volume from bars""")
def q_src_candles_json(spark, d):
    path = sinks.scratch_path(spark, "candles")
    _land(_candle_docs(adapters.bars(spark, d)), path)
    return landing.read_candles_json(spark, path)


@query("src_quotes_json", with_ctes("quotes_fetched") + f"select {_out()} from quotes_fetched")
def q_src_quotes_json(spark, d):
    path = sinks.scratch_path(spark, "quotes")
    _land(_envelopes(_quotes(spark, d)), path)
    return landing.quote_rows(landing.read_quotes_json(spark, path))


@query("quote_coverage", with_ctes("quotes") + f"""
select cast(sum(case when {_TWICE} then 2 else 1 end) as bigint) as fetched,
       cast(sum(opn_interest % 3) as bigint) as unfetched from quotes where not ({_FAILED})""")
def q_quote_coverage(spark, d):
    path = sinks.scratch_path(spark, "quotes")
    _land(_envelopes(_quotes(spark, d)), path)
    return landing.quote_coverage(landing.read_quotes_json(spark, path))


@query("quote_field_map", with_ctes("quotes") + f"select {_out()} from quotes")
def q_quote_field_map(spark, d):
    """All 23 fields as text, and the time of the snapshot."""
    quotes = _quotes(spark, d)
    texts = quotes.select(_quote().alias("q"), "timestamp").select("q.*", "timestamp")
    texts = texts.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in landing.QUOTE_FIELDS], "depth", "timestamp")
    return landing.quote_field_map(texts, ts_col="timestamp")


@query("scalar_depth_json", with_ctes("quotes") + """
select symbol_token, timestamp, depth_json, cast(json_extract(depth_json, '$.buy[0].price') as double) as price,
       cast(json_extract(depth_json, '$.buy[0].quantity') as bigint) as quantity,
       case when depth_json <> '{}' then cast(json_array_length(depth_json, '$.sell') as bigint) end as n_sell from quotes""")
def q_scalar_depth_json(spark, d):
    """Depth as it is delivered -> text ('{}' without one) -> depth again."""
    rows = landing.quote_field_map(_quotes(spark, d).select(_quote().alias("q"), "timestamp").select("q.*", "timestamp"),
                                   ts_col="timestamp")
    best = F.get("depth.buy", F.lit(0))
    return landing.depth_from_json(rows).select(
        "symbol_token", "timestamp", "depth_json", best["price"].alias("price"), best["quantity"].alias("quantity"),
        F.when(F.col("depth.sell").isNotNull(), F.size("depth.sell")).cast("bigint").alias("n_sell"))


@query("sink_parquet_export", _MS + f"select {_ms_cols()} from market_summary")
def q_sink_parquet_export(spark, d):
    path = sinks.scratch_path(spark, "market_summary")
    if not sinks.export_summary(build_market_summary(spark, d), path):
        raise RuntimeError("market summary is empty; export refused")
    return sinks.read_snapshot(spark, path)


@query("src_parquet_snapshot", _MS + f"""
select {_ms_cols()} from market_summary where ltp >= 20 and sma_200_position <> 'ABOVE_SMA200'""")
def q_src_parquet_snapshot(spark, d):
    snap = sinks.read_snapshot(spark, stored_summary(spark, d))
    return snap.where((F.col("ltp") >= 20) & (F.col("sma_200_position") != "ABOVE_SMA200"))


@query("snapshot_verify", _MS + """
select true as readable, count(*) as row_count, true as schema_matches, false as other_matches from market_summary""")
def q_snapshot_verify(spark, d):
    path = stored_summary(spark, d)
    other = sinks.snapshot_verify(spark, path, TOKEN_MASTER).select(F.col("schema_matches").alias("other_matches"))
    found = sinks.snapshot_verify(spark, path, MARKET_SUMMARY).drop("path")
    return found.withColumn("other_matches", other.scalar())


@query("sink_sql_to_parquet", with_ctes("rel") + """
select trading_symbol, cast(ltp as double) as ltp from rel""")
def q_sink_sql_to_parquet(spark, d):
    adapters.ticks(spark, d).createOrReplaceTempView("realtime_market_data")
    path = sinks.scratch_path(spark, "sql_export")
    sinks.sql_to_parquet(spark, """
        select trading_symbol, ltp from (
          select trading_symbol, ltp,
                 row_number() over (partition by symbol_token order by timestamp desc) as rn
          from realtime_market_data where exchange = 'NSE') where rn = 1;""", path)
    return spark.read.parquet(path)


@query("sink_full_refresh", with_ctes("token_master") + """
select token, symbol, name, expiry, cast(strike as double) as strike, lotsize, instrumenttype, exch_seg,
       cast(tick_size as double) as tick_size, token_type, futures_token,
       cast(strike_distance as double) as strike_distance, timestamp '2025-03-12 08:00:00' as created_at
from token_master""")
def q_sink_full_refresh(spark, d):
    path = sinks.scratch_path(spark, "token_master")
    tm = tk.build_token_master(adapters.raw_instruments(spark, d)).select(*TOKEN_MASTER_COLUMNS)
    sinks.full_refresh(tm, path, as_of=F.lit("2025-03-12 08:00:00"))
    return spark.read.parquet(path)


@query("truncate_table", with_ctes("token_master") + "select token from token_master where false")
def q_truncate_table(spark, d):
    path = sinks.scratch_path(spark, "token_master")
    sinks.full_refresh(tk.build_token_master(adapters.raw_instruments(spark, d)).select(*TOKEN_MASTER_COLUMNS),
                       path)
    sinks.truncate_table(spark, path, TOKEN_MASTER)
    return spark.read.parquet(path).select("token")


@query("rows_as_json", with_ctes("rel") + """
select trading_symbol, name, cast(ltp as double) as ltp, cast(percent_change as double) as percent_change,
       cast(open as double) as open, cast(high as double) as high, cast(low as double) as low,
       cast(close as double) as close, volume, opn_interest, cast(week_low_52 as double) as week_low_52,
       cast(week_high_52 as double) as week_high_52 from rel""")
def q_rows_as_json(spark, d):
    """The records, parsed back."""
    t = adapters.ticks(spark, d, with_week52=False)
    rows = tk_ops.latest_equity_tick(t, enrich=lambda df: adapters.attach_week52(spark, d, df))
    return rows_as_json(rows).select(F.from_json("record", rows.schema).alias("r")).select("r.*")


# ---- streaming ------------------------------------------------------------------

def _land_ticks(spark, d):
    """Write the derived ticks at their own parallelism; the landing folder."""
    path = sinks.scratch_path(spark, "landing")
    adapters.ticks(spark, d).write.parquet(path)
    return path


def _files_a_trigger(files: list[str], triggers: int = 3) -> int:
    """So many files a trigger that all are read in a few triggers."""
    return max(1, -(-len(files) // triggers))


_NEWEST_SQL = with_ctes("ticks") + """
select symbol_token, exchange, trading_symbol, cast(ltp as double) as ltp, cast(open as double) as open,
       cast(high as double) as high, cast(low as double) as low, cast(close as double) as close,
       exch_feed_time, exch_trade_time, cast(net_change as double) as net_change,
       cast(percent_change as double) as percent_change, trade_volume, opn_interest,
       cast(lower_circuit as double) as lower_circuit, cast(upper_circuit as double) as upper_circuit,
       tot_buy_quan, tot_sell_quan, cast(week_low_52 as double) as week_low_52,
       cast(week_high_52 as double) as week_high_52, timestamp
from (select *, row_number() over (partition by symbol_token order by timestamp desc) as rn from ticks)
where rn = 1"""


def _newest_by_stream(spark, d, keep_state: bool):
    landing_dir = _land_ticks(spark, d)
    snap = sinks.scratch_path(spark, "latest_snapshot")
    n = _files_a_trigger(spark.read.parquet(landing_dir).inputFiles())
    q = st.start_latest_tick(spark, landing_dir, snap, os.path.basename(snap), trigger="availableNow",
                             max_files_per_trigger=n, keep_state=keep_state)
    q.awaitTermination()
    return st.read_latest_snapshot(spark, snap)


@query("stream_latest_tick", _NEWEST_SQL)
def q_stream_latest_tick(spark, d):
    return _newest_by_stream(spark, d, keep_state=True)


@query("stream_latest_tick_stateless", _NEWEST_SQL)
def q_stream_latest_tick_stateless(spark, d):
    """Without state: each micro-batch's newest rows are merged into the snapshot."""
    return _newest_by_stream(spark, d, keep_state=False)


@query("stream_ticks_append", with_ctes("quotes_stored") + f"""
select {_out()} from quotes_stored
where strftime(timestamp, '%H:%M:%S') between '09:15:00' and '19:30:00'""")
def q_stream_ticks_append(spark, d):
    """Envelopes in a few triggers; the counts of all triggers must be those of
    all envelopes."""
    landing_dir, table, coverage = (sinks.scratch_path(spark, n) for n in ("landing", "tick_table", "coverage"))
    _land(_envelopes(_quotes(spark, d)), landing_dir)
    envelopes = landing.read_quotes_json(spark, landing_dir)
    q = st.start_quote_append(spark, landing_dir, table, coverage, os.path.basename(table), trigger="availableNow",
                              max_files_per_trigger=_files_a_trigger(envelopes.inputFiles()))
    q.awaitTermination()
    return sinks.read_snapshot(spark, table, REALTIME_MARKET_DATA).select(*TICK_COLUMNS)


@query("stream_quote_coverage", with_ctes("quotes") + f"""
select cast(sum(case when {_TWICE} then 2 else 1 end) as bigint) as fetched,
       cast(sum(opn_interest % 3) as bigint) as unfetched from quotes where not ({_FAILED})""")
def q_stream_quote_coverage(spark, d):
    """Fetched and unfetched quotes, counted by trigger, over all triggers."""
    landing_dir, table, coverage = (sinks.scratch_path(spark, n) for n in ("landing", "tick_table", "coverage"))
    _land(_envelopes(_quotes(spark, d)), landing_dir)
    n = _files_a_trigger(landing.read_quotes_json(spark, landing_dir).inputFiles())
    q = st.start_quote_append(spark, landing_dir, table, coverage, os.path.basename(table), trigger="availableNow",
                              max_files_per_trigger=n)
    q.awaitTermination()
    return spark.read.parquet(coverage).agg(F.sum("fetched").alias("fetched"), F.sum("unfetched").alias("unfetched"))


@query("stream_upsert_ticks", with_ctes("quotes_large_last") + f"select {_out()} from quotes_large_last")
def q_stream_upsert_ticks(spark, d):
    landing_dir, table, coverage = (sinks.scratch_path(spark, n) for n in ("landing", "tick_table", "coverage"))
    quotes, name = _quotes(spark, d), os.path.basename(table)

    def run():
        st.start_quote_append(spark, landing_dir, table, coverage, name, trigger="availableNow", session_start="00:00:00",
                              session_end="23:59:59").awaitTermination()

    _land(_envelopes(quotes), landing_dir)
    run()
    # Two restatements land before the next trigger: the newer, larger one wins.
    _land(_envelopes(_changed(quotes, _LATER, "percent_change > 3"), twice=False), landing_dir)
    _land(_envelopes(_changed(quotes, _AGAIN, "percent_change > 0").unionByName(
        _changed(quotes, _NEXT, "percent_change < -3")), twice=False), landing_dir)
    run()
    return sinks.read_snapshot(spark, table, REALTIME_MARKET_DATA).select(*TICK_COLUMNS)


@query("stream_export_summary", _MS + f"select {_ms_cols()} from market_summary")
def q_stream_export_summary(spark, d):
    """Ticks stream in two micro-batches; after each batch the summary is
    rebuilt from the tick table and exported. The export of the last batch
    must equal the summary over all ticks."""
    landing_dir = _land_ticks(spark, d)
    table = sinks.scratch_path(spark, "tick_table")
    out = sinks.scratch_path(spark, "summary_export")

    def export(sp, batch_id):
        from quantbeam.operators.summary import market_summary
        since = mark(sp)
        raw = adapters.raw_instruments(sp, d)
        tm = materialize(tk.build_token_master(raw))
        bars = adapters.bars(sp, d)
        wide = ind.indicators_wide(tm.where(F.col("token_type") == tk.TYPE_EQUITY), bars)
        ticks = sinks.read_snapshot(sp, table, REALTIME_MARKET_DATA).drop("trade_date")
        sinks.export_summary(market_summary(tm, ticks, wide, materialize_quotes=True), os.path.join(out, f"batch={batch_id}"))
        release(sp, since)

    q = st.start_tick_append(spark, landing_dir, table, os.path.basename(table), trigger="availableNow",
                             session_start="00:00:00", session_end="23:59:59", on_batch=export)
    q.awaitTermination()
    exports = spark.read.parquet(out)
    last = exports.select(F.max("batch")).scalar()
    return exports.where(F.col("batch") == last).drop("batch")


def _unfinished_docs(b):
    """Candle pages per (token, year); the newest bar of each token is the
    unfinished intraday candle and arrives without its volume (5 fields)."""
    from pyspark.sql import Window
    newest = F.row_number().over(Window.partitionBy("token").orderBy(F.col("timestamp").desc())) == 1
    fields = [F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
              *[F.col(c).cast("string") for c in ["open", "high", "low", "close"]]]
    candle = F.when(newest, F.array(*fields)).otherwise(F.array(*fields, F.col("volume").cast("string")))
    return (b.select("token", "symbol_name", "timestamp", candle.alias("c"))
             .groupBy("token", F.year("timestamp").alias("y"))
             .agg(F.first("symbol_name").alias("name"), F.collect_list("c").alias("data")).drop("y"))


@query("valid_candle", with_ctes("bars") + """
select token, timestamp, cast(close as double) as close, volume from (
  select *, row_number() over (partition by token order by timestamp desc) as rn from bars) where rn > 1""")
def q_valid_candle(spark, d):
    path = sinks.scratch_path(spark, "candles")
    _land(_unfinished_docs(adapters.bars(spark, d)), path)
    return landing.read_candles_json(spark, path).select("token", "timestamp", "close", "volume")


@query("scalar_array_item", with_ctes("bars") + """
select token, timestamp, 5 as n_fields, cast(close as double) as close from bars""")
def q_scalar_array_item(spark, d):
    b = adapters.bars(spark, d)
    arr = F.array(*[F.col(c).cast("string") for c in ["open", "high", "low", "close", "volume"]])
    return b.select("token", "timestamp", F.size(arr).alias("n_fields"),
                    F.element_at(arr, 4).cast("decimal(18,6)").cast("double").alias("close"))
