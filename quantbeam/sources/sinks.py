"""Sinks and snapshot reads (Parquet)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantbeam.operators.upserts import ARRIVAL, reduce_batch, schema_add_missing, upsert_by_key
from quantbeam.session import delete_path, mark, materialize, release, scratch_path  # noqa: F401  (scratch_path: for callers)


def publish(df: DataFrame, path: str, allow_empty: bool = False, partition_by: str | None = None) -> bool:
    """Replace the Parquet folder ``path`` by ``df``; False, with the old folder
    left as it is, if ``df`` is empty and must not be.

    The plan runs once, into a folder beside ``path``; a failure leaves the old
    folder alone. Two renames then put the new one in its place: readers may
    find no folder between them, but never half of one.
    """
    spark = df.sparkSession
    fresh, past = (f"{path.rstrip('/')}.{k}-{uuid.uuid4().hex}" for k in ("next", "past"))
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(fresh)
    if not allow_empty and spark.read.schema(df.schema).parquet(fresh).isEmpty():
        delete_path(spark, fresh)
        return False
    name = spark._jvm.org.apache.hadoop.fs.Path
    fs = name(path).getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = fs.exists(name(path))
    if replaced and not fs.rename(name(path), name(past)):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(name(fresh), name(path)):
        raise OSError(f"cannot publish {fresh} as {path}")
    if replaced:
        delete_path(spark, past)
    spark.catalog.refreshByPath(path)
    return True


def export_parquet(df: DataFrame, path: str) -> bool:
    """Publish a Parquet snapshot; refuse (return False) when ``df`` is empty."""
    return publish(df, path)


def export_summary(df: DataFrame, path: str) -> bool:
    """Publish the market summary laid out for its filters: by classes of
    price, doubling from one to the next, then by symbol, over files and inside
    them, so that row groups have narrow bounds of both."""
    return export_by_range(df, path, F.floor(F.log2("ltp")), F.col("symbol"))


def export_by_range(df: DataFrame, path: str, *layout: Column) -> bool:
    """Publish a snapshot, refused when empty, whose files are ranges of
    ``layout``. Ranges are found by a sample, for which a plan's last stages
    would run twice: the rows are written once before."""
    spark = df.sparkSession
    since = mark(spark)
    rows = materialize(df, "unordered", compression="zstd")
    done = publish(rows.repartitionByRange(*layout).sortWithinPartitions(*layout), path)
    release(spark, since)
    return done


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _stored(spark: SparkSession, path: str) -> bool:
    """Whether Spark has stored files or partitions in a folder. What an empty
    batch leaves of a partitioned table is a folder without any, of which no
    schema can be read."""
    if not _exists(spark, path):
        return False
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(hpath)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet snapshot; an empty frame (with ``schema``) if missing."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema or T.StructType([]))
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def snapshot_verify(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One row: whether the snapshot is readable, its row count, and whether
    its columns have the names, order and types of ``schema``."""
    shape = lambda s: [(f.name, f.dataType.simpleString()) for f in s.fields]
    if not _exists(spark, path):
        return spark.createDataFrame([(path, False, 0, False)],
                                     "path string, readable boolean, row_count bigint, schema_matches boolean")
    df = spark.read.parquet(path)
    matches = schema is None or shape(df.schema) == shape(schema)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(path).alias("path"), F.lit(True).alias("readable"), "row_count", F.lit(matches).alias("schema_matches"))


def sql_to_parquet(spark: SparkSession, sql_text: str, path: str) -> bool:
    """Run a SQL text against the session catalog and write the result."""
    return export_parquet(spark.sql(sql_text.strip().rstrip(";")), path)


def full_refresh(df: DataFrame, path: str, as_of=None) -> None:
    """Replace the whole table, stamping ``created_at``; see ``publish``."""
    ts = as_of if as_of is not None else F.current_timestamp()
    publish(df.withColumn("created_at", ts.cast("timestamp_ntz")), path, allow_empty=True)


def truncate_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def add_key_column(spark: SparkSession, table: str, column: str, dtype: str, value, part_col: str) -> bool:
    """Give a stored partitioned table that was written without ``column`` that
    column, filled with ``value``; True if it was rewritten. The table is
    replaced by rename, so a failure leaves the old one."""
    if not _exists(spark, table):
        return False
    stored = spark.read.parquet(table)
    if column in stored.columns:
        return False
    filled = schema_add_missing(stored, column=column, dtype=dtype, value=value)
    return publish(filled.hint("rebalance", part_col), table, allow_empty=True, partition_by=part_col)


def merge_partitions(spark: SparkSession, table: str, batch: DataFrame, part_col: str, keys: Sequence[str],
                     update_columns: Sequence[str] | None = None) -> None:
    """Upsert ``batch`` into the partitioned Parquet ``table``: read and rewrite
    only the partitions that the batch touches, one set of files each.

    The batch is evaluated once (written under the shared checkpoint folder),
    the merge is written there before the table's files are replaced, and both
    copies are deleted afterwards. A first load is reduced to one row per key
    like any other batch; it replaces nothing and needs no copies. The order of
    arrival is the batch's column ``ARRIVAL``, or the order of its rows before
    they are shuffled.
    """
    since = mark(spark)
    columns = [c for c in batch.columns if c != ARRIVAL]
    if ARRIVAL not in batch.columns:
        batch = batch.withColumn(ARRIVAL, F.monotonically_increasing_id())
    if _stored(spark, table):
        batch = materialize(batch, "batch", compression="zstd")
        # A semi-join on the partition column: dynamic partition pruning.
        touched = batch.select(part_col).distinct()
        old = spark.read.parquet(table).join(touched, part_col, "left_semi")
        merged = upsert_by_key(old.select(*columns), batch, keys, update_columns).hint("rebalance", part_col)
        merged = materialize(merged, "merge", compression="zstd")
    else:
        merged = reduce_batch(batch, keys, update_columns).hint("rebalance", part_col)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(table))
    release(spark, since)
