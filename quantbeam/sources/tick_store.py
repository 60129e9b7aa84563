"""Stored ticks laid out for reading the ticks of some tokens.

The table is partitioned by a hash bucket of ``symbol_token`` and sorted by token
inside files. A join with a token set on bucket and token lets Spark prune the
partitions at run time by the buckets that the set has (where it broadcasts the
set, by its size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "token_bucket"
BUCKETS = 256


def bucket(token: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def write_ticks(ticks: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Replace the store at ``path``; files of one bucket are written together."""
    placed = ticks.withColumn(BUCKET, bucket("symbol_token", buckets)).hint("rebalance", BUCKET)
    placed.sortWithinPartitions(BUCKET, "symbol_token").write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def ticks_of(spark: SparkSession, path: str, tokens: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The stored ticks of the tokens in ``tokens`` (column ``token``)."""
    wanted = tokens.where(F.col("token").isNotNull()).select(
        bucket("token", buckets).alias(BUCKET), F.col("token").alias("symbol_token")).distinct()
    return spark.read.parquet(path).join(wanted, [BUCKET, "symbol_token"], "left_semi").drop(BUCKET)
