"""Batch jobs over stored tables (the reference's refresh flow).

Tables are Parquet folders. Each job reads its inputs, computes with the
operators and writes its product beside the old one, which is then replaced,
so a table is never overwritten while it is being read.

* ``refresh_token_master``: skip when the stored master is current
  (``needs_refresh``), else rebuild from the landed instrument JSON.
* ``load_candles``: landed candle JSON -> upsert into the bars table
  (partitioned by trade year, only touched years are rewritten).
* ``refresh_indicators``: bars -> long indicator table (upserted) and the
  wide summary (replaced by token).
* ``export_market_summary``: stored tables + tick table -> summary
  snapshot (refused when empty).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quantbeam.operators import indicators as ind
from quantbeam.operators import summary as sm
from quantbeam.operators import tokens as tk
from quantbeam.operators import upserts as up
from quantbeam.schemas import TOKEN_MASTER, TOKEN_MASTER_COLUMNS
from quantbeam.sources import landing, sinks


def refresh_token_master(spark: SparkSession, instruments_path: str, table: str, as_of: str,
                         force: bool = False, pre_market_start: str = "09:00:00",
                         multi_line: bool = True) -> bool:
    """Rebuild the instrument master unless it is already current.
    Returns True when a refresh was written."""
    current = sinks.read_snapshot(spark, table, TOKEN_MASTER)
    status = tk.needs_refresh(current, as_of, pre_market_start, force).first()  # one-row aggregate
    if not status.needs_refresh:
        return False
    raw = landing.read_instruments_json(spark, instruments_path, multi_line=multi_line)
    tm = tk.build_token_master(raw).select(*TOKEN_MASTER_COLUMNS)
    sinks.full_refresh(tm, table, as_of=F.lit(as_of))
    return True


def load_candles(spark: SparkSession, candles_path: str, bars_table: str) -> None:
    """Upsert landed candles into the bars table (ON CONFLICT(token, interval,
    timestamp) update every payload column, the file that arrived last wins);
    only the touched trade years are rewritten. A table of the time before bars
    had an interval gets that column first."""
    sinks.add_key_column(spark, bars_table, "interval", "string", up.DEFAULT_INTERVAL, "trade_year")
    new = landing.read_candles_json(spark, candles_path, arrival=True).withColumn("trade_year", F.year("timestamp"))
    sinks.merge_partitions(spark, bars_table, new, "trade_year", up.BAR_KEY)


def refresh_indicators(spark: SparkSession, bars_table: str, token_table: str, long_table: str,
                       wide_table: str) -> None:
    """Long indicator table (upserted by its key, so values that newer bars
    push out of the fetch window stay) and the wide summary, where rows of
    the recomputed tokens are replaced."""
    bars = up.with_interval(spark.read.parquet(bars_table)).where(F.col("interval") == up.DEFAULT_INTERVAL)
    bars = bars.drop("trade_year", "interval")
    tm = spark.read.parquet(token_table)
    equity = tm.where(F.col("token_type") == tk.TYPE_EQUITY)
    fresh = ind.indicators_long(bars)
    if sinks._exists(spark, long_table):
        old = spark.read.parquet(long_table)
        fresh = up.upsert_indicators(old, fresh.select(*old.columns))
    sinks.publish(fresh, long_table, allow_empty=True)
    wide = ind.indicators_wide(equity, bars)
    if sinks._exists(spark, wide_table):
        wide = up.replace_by_key(spark.read.parquet(wide_table), wide)
    sinks.publish(wide, wide_table, allow_empty=True)


def export_market_summary(spark: SparkSession, token_table: str, ticks_table: str, wide_table: str,
                          out_path: str) -> bool:
    tm = spark.read.parquet(token_table)
    ticks = spark.read.parquet(ticks_table)
    if "trade_date" in ticks.columns:
        ticks = ticks.drop("trade_date")
    wide = spark.read.parquet(wide_table)
    return sinks.export_summary(sm.market_summary(tm, ticks, wide), out_path)


def table_paths(root: str) -> dict[str, str]:
    """Conventional table folders under one root."""
    names = ["token_master", "historical_data", "realtime_market_data", "technical_indicators",
             "technical_indicators_summary", "market_summary"]
    return {n: os.path.join(root, n) for n in names}


