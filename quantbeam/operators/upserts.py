"""Key-based upserts and replacements without a MERGE-capable table format.

``upsert_by_key`` is a full outer join of the stored rows and the new
batch on the key with presence flags: listed columns come from the batch
when the key is in it (a NULL there is kept), other columns keep the
first-written value. A batch may hold a key several times: ``reduce_batch``
brings it to one row per key first, as if its rows had arrived one by one. Which
row arrived later is told by the column ``ARRIVAL``, which readers of landed files
add (``quantbeam.sources.landing``). The result can be written to just the
partitions the batch touches (``quantbeam.sources.sinks.merge_partitions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Orderable column of a batch: of two rows, the greater one arrived later.
ARRIVAL = "_arrival"

# Columns an incoming quote may overwrite on conflict.
TICK_UPDATE_COLUMNS = ["ltp", "open", "high", "low", "close", "last_trade_qty", "net_change",
                       "percent_change", "avg_price", "trade_volume", "opn_interest", "depth_json"]
TICK_KEY = ["symbol_token", "timestamp"]
#: Bars of several sizes of one token and time live side by side.
BAR_KEY = ["token", "interval", "timestamp"]
DEFAULT_INTERVAL = "ONE_DAY"
INDICATOR_KEY = ["token", "indicator_name", "period", "timestamp"]


def reduce_batch(new: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None,
                 order: Column | None = None) -> DataFrame:
    """One row per key: the last arrival's updated columns, the first one's
    others. ``order`` tells arrivals apart: by default the column ``ARRIVAL``,
    which is dropped, or without one the order of the rows in the frame (which
    is no order of arrival for rows read from several files)."""
    if ARRIVAL in new.columns:
        order = F.col(ARRIVAL) if order is None else order
    columns = [c for c in new.columns if c != ARRIVAL]
    cols = [c for c in columns if c not in keys]
    upd = [c for c in cols if update_columns is None or c in update_columns]
    kept = [c for c in cols if c not in upd]
    at = F.monotonically_increasing_id() if order is None else order
    aggs = [f(F.struct(*part), "_at").alias(name)
            for f, part, name in ((F.max_by, upd, "_last"), (F.min_by, kept, "_first")) if part]
    if not aggs:
        return new.select(*columns).distinct()
    return (new.withColumn("_at", at).groupBy(*keys).agg(*aggs)
            .select(*keys, *[F.col(f"_last.{c}") for c in upd], *[F.col(f"_first.{c}") for c in kept])
            .select(*columns))


def upsert_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  update_columns: Sequence[str] | None = None, order: Column | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT(keys) DO UPDATE SET <update_columns>.

    ``update_columns=None`` updates every non-key column. ``order``: see
    ``reduce_batch``, which the batch goes through.
    """
    new = reduce_batch(new, keys, update_columns, order)
    keys = list(keys)
    cols = [c for c in old.columns if c not in keys]
    upd = set(cols if update_columns is None else update_columns)
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_in_old"))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full_outer")
    in_new = F.col("_in_new").isNotNull()
    in_old = F.col("_in_old").isNotNull()
    out = []
    for c in cols:
        if c in upd:
            out.append(F.when(in_new, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
        else:
            out.append(F.when(in_old, F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")).alias(c))
    return j.select(*keys, *out).select(*old.columns)


def with_interval(bars: DataFrame, interval: str = DEFAULT_INTERVAL) -> DataFrame:
    """Bars with the key column ``interval``: what is absent or NULL there is
    of the size ``interval``."""
    return schema_add_missing(bars, column="interval", dtype="string", value=interval)


def upsert_bars(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert_by_key(with_interval(old), with_interval(new), BAR_KEY)


def upsert_ticks_partial(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert_by_key(old, new, TICK_KEY, TICK_UPDATE_COLUMNS)


def upsert_indicators(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert_by_key(old, new, INDICATOR_KEY, ["symbol_name", "value"])


def anti_existing(old: DataFrame, new: DataFrame, key: str = "token") -> DataFrame:
    """Rows of ``old`` whose key is absent from ``new``."""
    return old.join(new.select(key).distinct(), key, "left_anti")


def replace_by_key(old: DataFrame, new: DataFrame, key: str = "token") -> DataFrame:
    """DELETE old rows for the keys in ``new``, then INSERT ``new`` (by name)."""
    return anti_existing(old, new, key).unionByName(new.select(*old.columns))


def schema_add_missing(df: DataFrame, target: DataFrame | None = None, column: str = "strike_distance",
                       dtype: str = "decimal(18,6)", value=None) -> DataFrame:
    """Add an absent column as typed NULL (frame variant), or align with
    ``target`` by name, filling missing columns with NULL. With a ``value`` that
    one is filled in, also for NULLs of a column that is there."""
    if target is not None:
        return target.limit(0).unionByName(df, allowMissingColumns=True)
    filled = F.lit(value).cast(dtype)
    if column not in df.columns:
        return df.withColumn(column, filled)
    return df if value is None else df.withColumn(column, F.coalesce(F.col(column), filled))
