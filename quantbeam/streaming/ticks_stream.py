"""Structured Streaming for quote snapshots.

Quotes are polled every 60 s; here the answers land as files and a file-source
stream processes them:

* ``start_quote_append``: JSON envelopes with fetched and unfetched quotes.
  Each trigger stores how many of both it met, and upserts the fetched ones
  like ``start_tick_append``.
* ``start_tick_append``: rows of the table's shape; market-hours filter, then a
  ``foreachBatch`` upsert (partial update on (symbol_token, timestamp)) into the
  tick table, overwriting only the trade-date partitions the batch touches. Of
  rows with one key the one that arrived last wins, whatever the sizes of the
  files. Re-running a batch gives the same table, so a retried batch after an
  executor loss is harmless.
* ``start_latest_tick``: stateful ``groupBy(symbol_token)`` with
  ``max_by(struct, (timestamp, ...))`` in update mode; each batch's
  changed keys are merged into a snapshot bucketed by symbol hash, so a
  trigger rewrites only the touched buckets, never the whole state.
* ``on_batch_export``: a hook that rebuilds and exports the summary after
  each successful batch.

State and checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quantbeam.operators.ticks import LATEST_TICK_ALL_COLUMNS, filter_market_hours
from quantbeam.operators.upserts import TICK_KEY, TICK_UPDATE_COLUMNS
from quantbeam.schemas import QUOTES_JSON, REALTIME_MARKET_DATA
from quantbeam.session import checkpoint_dir, mark, materialize, release
from quantbeam.sources import landing
from quantbeam.sources.sinks import _stored, merge_partitions, read_snapshot

SNAPSHOT_BUCKETS = 64


def _file_stream(spark: SparkSession, landing_dir: str, schema, fmt: str, max_files_per_trigger: int | None) -> DataFrame:
    """Landed files as a stream whose rows know where they were read."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing_dir).select("*", landing.file_place().alias(landing.PLACE))


def tick_stream(spark: SparkSession, landing_dir: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    return _file_stream(spark, landing_dir, REALTIME_MARKET_DATA, fmt, max_files_per_trigger)


def quote_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return _file_stream(spark, landing_dir, QUOTES_JSON, "json", max_files_per_trigger)


def _trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _append(spark: SparkSession, ticks: DataFrame, table: str, session_start: str, session_end: str) -> None:
    """Upsert a micro-batch's ticks of the market's hours."""
    open_hours = filter_market_hours(ticks, session_start, session_end).withColumn("trade_date", F.to_date("timestamp"))
    merge_partitions(spark, table, open_hours, "trade_date", TICK_KEY, TICK_UPDATE_COLUMNS)


def _start(spark: SparkSession, stream: DataFrame, name: str, trigger: str,
           each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    return _trigger(stream.writeStream.foreachBatch(each).option("checkpointLocation", ckpt), trigger).start()


def start_tick_append(spark: SparkSession, landing_dir: str, table: str, name: str,
                      trigger: str = "60 seconds", session_start: str = "09:15:00",
                      session_end: str = "19:30:00", max_files_per_trigger: int | None = None,
                      on_batch: Callable[[SparkSession, int], None] | None = None) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        _append(spark, landing.with_arrival(batch), table, session_start, session_end)
        if on_batch is not None:
            on_batch(spark, batch_id)

    return _start(spark, tick_stream(spark, landing_dir, max_files_per_trigger=max_files_per_trigger), name, trigger, each)


def start_quote_append(spark: SparkSession, landing_dir: str, table: str, coverage: str, name: str,
                       trigger: str = "60 seconds", session_start: str = "09:15:00",
                       session_end: str = "19:30:00", max_files_per_trigger: int | None = None,
                       on_batch: Callable[[SparkSession, int], None] | None = None) -> StreamingQuery:
    """Quote envelopes into the tick table. ``coverage`` gets one row per
    trigger, (batch_id, fetched, unfetched); a batch that is run again writes
    its row again."""
    def each(batch: DataFrame, batch_id: int) -> None:
        envelopes = landing.with_arrival(batch)
        (landing.quote_coverage(envelopes).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(coverage))
        _append(spark, landing.quote_rows(envelopes), table, session_start, session_end)
        if on_batch is not None:
            on_batch(spark, batch_id)

    return _start(spark, quote_stream(spark, landing_dir, max_files_per_trigger), name, trigger, each)


def latest_tick_state(stream: DataFrame) -> DataFrame:
    """Running newest tick per symbol_token (state = one row per symbol)."""
    payload = [c for c in LATEST_TICK_ALL_COLUMNS]
    row = F.max_by(F.struct(*payload), F.struct("timestamp")).alias("_r")
    return stream.groupBy("symbol_token").agg(row).select(
        "symbol_token", *[F.col(f"_r.{c}").alias(c) for c in payload])


def _merge_newest(spark: SparkSession, snapshot: str, batch: DataFrame) -> None:
    """Keep, per symbol, the newer of the stored and the incoming row;
    only the hash buckets present in the batch are rewritten."""
    from quantbeam.operators.latest import latest_per_key
    since = mark(spark)
    b = batch.withColumn("bucket", F.pmod(F.xxhash64("symbol_token"), F.lit(SNAPSHOT_BUCKETS)))
    if _stored(spark, snapshot):
        old = spark.read.parquet(snapshot).join(b.select("bucket").distinct(), "bucket", "left_semi")
        b = old.select(*b.columns).unionByName(b)
    newest = latest_per_key(b, ["symbol_token"], ["timestamp"], [c for c in b.columns if c != "symbol_token"])
    frozen = materialize(newest.hint("rebalance", "bucket"), "latest")
    (frozen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("bucket").parquet(snapshot))
    release(spark, since)


def start_latest_tick(spark: SparkSession, landing_dir: str, snapshot: str, name: str,
                      trigger: str = "60 seconds", max_files_per_trigger: int | None = None,
                      keep_state: bool = True) -> StreamingQuery:
    """Maintain the newest tick per symbol in ``snapshot``.

    By default state holds one row per symbol for the life of the stream.
    With ``keep_state=False`` there is no state: each micro-batch's own newest
    rows are merged into the snapshot. Neither drops a late row."""
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    src = tick_stream(spark, landing_dir, max_files_per_trigger=max_files_per_trigger).drop(landing.PLACE)
    state, mode = (latest_tick_state(src), "update") if keep_state else (
        src.select("symbol_token", *LATEST_TICK_ALL_COLUMNS), "append")

    def each(batch: DataFrame, batch_id: int) -> None:
        if keep_state:
            b = batch.withColumn("bucket", F.pmod(F.xxhash64("symbol_token"), F.lit(SNAPSHOT_BUCKETS)))
            merge_partitions(spark, snapshot, b, "bucket", ["symbol_token"])
        else:
            _merge_newest(spark, snapshot, batch)

    w = state.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", ckpt)
    return _trigger(w, trigger).start()


def read_latest_snapshot(spark: SparkSession, snapshot: str) -> DataFrame:
    row = T.StructType([REALTIME_MARKET_DATA[c] for c in ["symbol_token", *LATEST_TICK_ALL_COLUMNS]])
    return read_snapshot(spark, snapshot, row).select(*row.names)
