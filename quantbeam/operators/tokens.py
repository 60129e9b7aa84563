"""Instrument dimension: futures, options, equities -> token_master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantbeam.functions.scalars import (concat_eq, parse_expiry, strip_eq, to_decimal, to_int)
from quantbeam.schemas import DEC, TOKEN_MASTER

# Instrument types, exchange segments and token-type tags.
FUTURES_STOCK = "FUTSTK"
OPTIONS_STOCK = "OPTSTK"
SEG_NFO = "NFO"
SEG_NSE = "NSE"
TYPE_FUTURES = "FUTURES"
TYPE_OPTIONS = "OPTIONS"
TYPE_EQUITY = "EQUITY"
OPTION_STRIKE_SCALE = 100  # option strikes arrive multiplied by 100


def filter_futures(raw: DataFrame) -> DataFrame:
    return raw.where((F.col("instrumenttype") == FUTURES_STOCK) & (F.col("exch_seg") == SEG_NFO))


def filter_options(raw: DataFrame) -> DataFrame:
    return raw.where((F.col("instrumenttype") == OPTIONS_STOCK) & (F.col("exch_seg") == SEG_NFO))


def min_expiry(df: DataFrame) -> DataFrame:
    """Global minimum parsed expiry (one row)."""
    return df.select(F.min(parse_expiry("expiry")).alias("min_expiry"))


def distinct_expiries(df: DataFrame) -> DataFrame:
    """The expiry texts, sorted."""
    return df.select("expiry").distinct().orderBy("expiry")


def nearest_expiry(df: DataFrame) -> DataFrame:
    """Rows whose parsed expiry equals the global minimum (a scalar
    subquery: one partial-min pass, no single-partition window).
    Adds ``expiry_date``."""
    d = df.withColumn("expiry_date", parse_expiry("expiry"))
    m = d.select(F.min("expiry_date")).scalar()
    return d.where(F.col("expiry_date") == m)


def coerce_numeric(df: DataFrame) -> DataFrame:
    """strike / tick_size -> DECIMAL(18,6), lotsize -> INT; invalid -> NULL."""
    return df.withColumns({"strike": to_decimal("strike"), "lotsize": to_int("lotsize"),
                           "tick_size": to_decimal("tick_size")})


def normalize_strike(df: DataFrame) -> DataFrame:
    return df.withColumn("strike", (F.col("strike") / F.lit(OPTION_STRIKE_SCALE)).cast(DEC))


def _shape(df: DataFrame, token_type: str, futures_token: Column | None = None,
           strike_distance: Column | None = None) -> DataFrame:
    cols = {
        "token_type": F.lit(token_type),
        "futures_token": futures_token if futures_token is not None else F.lit(None).cast("string"),
        "strike_distance": strike_distance if strike_distance is not None else F.lit(None).cast(DEC),
    }
    out = []
    for f in TOKEN_MASTER.fields:
        if f.name == "created_at":
            continue
        c = cols[f.name] if f.name in cols else F.col(f.name)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def futures_tokens(raw: DataFrame) -> DataFrame:
    f = coerce_numeric(nearest_expiry(filter_futures(raw)))
    return _shape(f.withColumn("expiry", F.col("expiry_date")), TYPE_FUTURES)


def strike_distance(options: DataFrame) -> DataFrame:
    """Per name: most common gap between adjacent distinct strikes,
    rounded to 2 places; ties go to the gap met first (lowest strike).
    Names with a single strike get no row (-> NULL after the join)."""
    s = options.where(F.col("strike").isNotNull()).select("name", "strike").distinct()
    w = Window.partitionBy("name").orderBy("strike")
    gaps = (s.withColumn("diff", F.round(F.lead("strike").over(w) - F.col("strike"), 2))
             .where(F.col("diff").isNotNull()))
    counts = gaps.groupBy("name", "diff").agg(F.count(F.lit(1)).alias("cnt"),
                                              F.min("strike").alias("first_at"))
    pick = F.min_by("diff", F.struct((-F.col("cnt")).alias("k"), F.col("first_at")))
    return counts.groupBy("name").agg(pick.cast(DEC).alias("strike_distance"))


def options_tokens(raw: DataFrame) -> DataFrame:
    """Options at the nearest expiry with their strike spacing.

    The option chain is the largest dimension, so it is scanned twice only:
    one pass writes the small distinct (name, expiry, strike) grid, from
    which the global nearest expiry and the spacing per name are read; the
    second pass keeps the nearest-expiry rows and joins the spacing."""
    from quantbeam.session import materialize
    o = normalize_strike(coerce_numeric(filter_options(raw))).withColumn("expiry_date", parse_expiry("expiry"))
    grid = materialize(o.select("name", "expiry_date", "strike").distinct(), "strike_grid")
    nearest = grid.select(F.min("expiry_date")).scalar()
    dist = strike_distance(grid.where(F.col("expiry_date") == nearest))
    o = (o.where(F.col("expiry_date") == nearest).withColumn("expiry", F.col("expiry_date"))
          .drop("strike_distance").join(dist, "name", "left"))
    return _shape(o, TYPE_OPTIONS, strike_distance=F.col("strike_distance"))


def equity_of_futures(raw: DataFrame, futures: DataFrame) -> DataFrame:
    """NSE rows whose symbol is some futures name + '-EQ' (semi-join)."""
    wanted = futures.select(concat_eq("name").alias("symbol")).distinct()
    return raw.where(F.col("exch_seg") == SEG_NSE).join(wanted, "symbol", "left_semi")


def futures_token_by_name(futures: DataFrame) -> DataFrame:
    """name -> futures token; duplicate names resolve to the greatest token."""
    return futures.groupBy("name").agg(F.max("token").alias("futures_token"))


def map_futures_token(equity: DataFrame, futures: DataFrame) -> DataFrame:
    m = futures_token_by_name(futures).withColumnRenamed("name", "base_name")
    return (equity.withColumn("base_name", strip_eq("symbol"))
                  .join(m, "base_name", "left").drop("base_name"))


def equity_tokens(raw: DataFrame, futures: DataFrame) -> DataFrame:
    e = map_futures_token(equity_of_futures(raw, futures), futures)
    e = coerce_numeric(e).withColumns({"strike": F.lit(0).cast(DEC), "expiry": F.lit(None).cast("date")})
    return _shape(e, TYPE_EQUITY, futures_token=F.col("futures_token"))


def stage_instruments(raw: DataFrame) -> DataFrame:
    """Land the raw master once as Parquet (shared checkpoint folder),
    clustered by instrument type inside each file: the futures, option and
    equity passes then read pruned columns and skip row groups through the
    pushed ``instrumenttype`` filter instead of re-running the source.
    (Directory partitioning is avoided: it would turn the equities' empty
    instrument type into NULL.)"""
    from quantbeam.session import materialize
    return materialize(raw.sortWithinPartitions("instrumenttype", "exch_seg"), "instruments")


def build_token_master(raw: DataFrame, as_of: Column | None = None, staged: bool = True) -> DataFrame:
    """futures ∪ options ∪ equity (bag union by name) + created_at."""
    if staged:
        raw = stage_instruments(raw)
    fut = futures_tokens(raw)
    tm = fut.unionByName(options_tokens(raw)).unionByName(equity_tokens(raw, fut))
    ts = as_of if as_of is not None else F.current_timestamp()
    return tm.withColumn("created_at", ts.cast("timestamp_ntz"))


def tokens_by_type(tm: DataFrame, token_type: str, limit: int | None = None) -> DataFrame:
    out = tm.where(F.col("token_type") == token_type).select("token", "name", "exch_seg")
    if limit is not None:
        out = out.orderBy("token").limit(limit)
    return out


def options_sorted(tm: DataFrame, limit: int | None = None) -> DataFrame:
    """Options ordered by (name, strike, expiry, token); top-n when limited."""
    out = tm.where(F.col("token_type") == TYPE_OPTIONS).orderBy("name", "strike", "expiry", "token")
    return out.limit(limit) if limit is not None else out


def sample_rows(tm: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` rows per token type by token (a sampling report)."""
    w = Window.partitionBy("token_type").orderBy("token")
    return (tm.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn"))


def strike_stats(options: DataFrame) -> DataFrame:
    return options.groupBy("name").agg(F.count(F.lit(1)).alias("n_options"),
                                       F.min("strike").alias("min_strike"),
                                       F.max("strike").alias("max_strike"))


def strike_distance_sample(tm: DataFrame) -> DataFrame:
    return (tm.where(F.col("strike_distance").isNotNull())
              .select("name", "strike_distance").distinct())


def options_null_distance(tm: DataFrame) -> DataFrame:
    o = tm.where(F.col("token_type") == TYPE_OPTIONS)
    return o.agg(F.count_if(F.col("strike_distance").isNull()).alias("null_distance"),
                 F.count_if(F.col("strike_distance").isNotNull()).alias("with_distance"))


def table_status(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts_col).alias("last_update"))


REQUEST_BATCH = 50  # fixed value: tokens per quote request


_NUMBERING_BUCKETS = 1024


def tokens_by_exchange(tm: DataFrame, batch_size: int = REQUEST_BATCH) -> DataFrame:
    """exchange -> token lists in request batches: all of ``batch_size`` but an
    exchange's last.

    Tokens are numbered inside hash buckets and buckets are offset by the
    counts of those before them, so no task numbers a whole exchange and the
    batches do not depend on the session's settings.
    """
    dealt = tm.select("exch_seg", "token").withColumn(
        "_bucket", F.pmod(F.xxhash64("token"), F.lit(_NUMBERING_BUCKETS)))
    counts = dealt.groupBy("exch_seg", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("exch_seg").orderBy("_bucket")
    offsets = counts.select(F.col("exch_seg").alias("_exch"), F.col("_bucket").alias("_b"), (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("exch_seg", "_bucket").orderBy("token")
    placed = (dealt.withColumn("_at", F.row_number().over(inside) - 1)
              .join(offsets, F.col("exch_seg").eqNullSafe(F.col("_exch")) & (F.col("_bucket") == F.col("_b")))
              .select("exch_seg", "token", F.floor((F.col("_before") + F.col("_at")) / batch_size).alias("batch_id")))
    return (placed.groupBy("exch_seg", "batch_id").agg(F.sort_array(F.collect_list("token")).alias("tokens")))


def needs_refresh(tm: DataFrame, as_of: str, pre_market_start: str = "09:00:00",
                  force: bool = False) -> DataFrame:
    """One row: refresh when forced, table empty, or newest created_at is
    before today's pre-market start (``as_of`` is the current time)."""
    cutoff = F.to_timestamp(F.concat(F.date_format(F.lit(as_of).cast("timestamp_ntz"), "yyyy-MM-dd"),
                                     F.lit(" "), F.lit(pre_market_start))).cast("timestamp_ntz")
    last = F.max("created_at")
    return tm.agg(F.count(F.lit(1)).alias("row_count"), last.alias("last_update"),
                  (F.lit(force) | F.coalesce(last < cutoff, F.lit(True))).alias("needs_refresh"))
