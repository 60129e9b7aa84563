"""Latest-row-per-key selection.

``groupBy(keys).agg(max_by(struct(payload), struct(order)))`` gives a
partial (map-side) aggregate: each task keeps one row per key before the
shuffle, so a key holding a third of the table costs one row of shuffle
per task, not a third of the table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str] | None = None, newest: bool = True) -> DataFrame:
    """Row with the greatest (or least) ``order`` tuple per ``keys``.

    Ties on the ordering tuple must be broken by the caller adding columns
    to ``order``; NULL ordering fields sort lowest (as DESC NULLS LAST).
    """
    keys = list(keys)
    payload = [c for c in (columns or df.columns) if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if newest else F.min_by
    row = pick(F.struct(*[F.col(c) for c in payload]), ordering).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])
