"""Adapters: reshape the driver's tables into the reference data model.

The driver ships TPC-H-like tables plus an ``events`` stream. These
functions derive the reference's tables from them (instrument master,
quote ticks, daily bars) so every operator runs on data whose size grows
with the inputs. All adapters are plain DataFrame plans: joins are
equi-joins (AQE picks broadcast only from measured sizes), fan-outs over
fixed literal lists are ``explode`` generators, not joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantbeam.functions.scalars import digits_to_letters
from quantbeam.schemas import DEC, REALTIME_MARKET_DATA
from quantbeam.sources.tables import read_table

# Fixed values of the adapter mapping (event type -> instrument class).
EXCHANGE_NSE_EVENTS = ["view", "error"]
EVENT_SUFFIX = {"purchase": "27MAR25FUT", "click": "27MAR25100CE", "signup": "27MAR25100PE"}
EVENT_TOKEN_PREFIX = {"purchase": "F", "click": "C", "signup": "P"}
# Futures expiries (token prefix, expiry text) and option variants (type, expiry).
FUTURES_VARIANTS = [("F", "27MAR2025"), ("G", "24APR2025")]
#: Lines that a task turns into bars at most, keys being spread evenly.
LINES_A_TASK = 500_000
OPTION_VARIANTS = [("CE", "27MAR2025"), ("PE", "27MAR2025"), ("CE", "24APR2025")]


def underlyings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct events.user_id: (uid, name)."""
    ev = read_table(spark, sf_dir, "events")
    return (ev.select(F.col("user_id").alias("uid")).distinct()
              .withColumn("name", digits_to_letters("uid")))


def _case_map(col, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


def week52(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user 52-week range of the adapter (uid, week_low_52, week_high_52):
    one partial aggregate over two columns of ``events``."""
    ev = read_table(spark, sf_dir, "events").where(F.col("user_id").isNotNull())
    return ev.groupBy(F.col("user_id").alias("uid")).agg(F.min("value").cast(DEC).alias("week_low_52"),
                                                       F.max("value").cast(DEC).alias("week_high_52"))


def ticks(spark: SparkSession, sf_dir: str, with_week52: bool = True) -> DataFrame:
    """``realtime_market_data`` played by ``events`` (ltp = value, timestamp = ts).

    The 52-week range is a per-user min/max: computed as a partial
    aggregate and joined back on user_id (a hot user is reduced map-side
    and AQE splits its join partition). ``with_week52=False`` leaves the
    two columns NULL so a caller that first reduces the ticks (e.g. to the
    newest row per instrument) can attach them afterwards with
    ``attach_week52`` on a few rows instead of every tick.
    """
    ev = read_table(spark, sf_dir, "events").where(F.col("user_id").isNotNull())
    et = F.col("event_type")
    name = digits_to_letters("user_id")
    cols = {
        "exchange": F.when(et.isin(*EXCHANGE_NSE_EVENTS), F.lit("NSE")).otherwise(F.lit("NFO")),
        "trading_symbol": F.concat(name, _case_map(et, EVENT_SUFFIX, "-EQ")),
        "symbol_token": F.concat(_case_map(et, EVENT_TOKEN_PREFIX, "E"), F.col("user_id").cast("string")),
        "ltp": F.col("value").cast(DEC),
        "open": (F.col("value") * 0.98).cast(DEC),
        "high": (F.col("value") * 1.02).cast(DEC),
        "low": (F.col("value") * 0.97).cast(DEC),
        "close": F.col("value").cast(DEC),
        "percent_change": ((F.col("event_id") % 11) - 5).cast(DEC),
        "trade_volume": (F.col("event_id") % 1000).cast("bigint"),
        "opn_interest": (F.col("event_id") % 97).cast("bigint"),
        "depth_json": F.col("props"),
        "timestamp": F.col("ts").cast("timestamp_ntz"),
    }
    if with_week52:
        ev = ev.join(week52(spark, sf_dir).withColumnRenamed("uid", "user_id"), "user_id", "inner")
        cols["week_low_52"] = F.col("week_low_52")
        cols["week_high_52"] = F.col("week_high_52")
    out = [cols[f.name].alias(f.name) if f.name in cols else F.lit(None).cast(f.dataType).alias(f.name)
           for f in REALTIME_MARKET_DATA.fields]
    return ev.select(*out)


def option_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of option contracts of several strikes per underlying: clicks (CE)
    and signups (PE) of ``events``, each on one of four contracts of its user."""
    ev = read_table(spark, sf_dir, "events").where(F.col("user_id").isNotNull())
    n = ev.select(F.count_distinct("user_id")).scalar()
    kind = _case_map(F.col("event_type"), {"click": "CE", "signup": "PE"}, None)
    part = F.col("user_id") + n * (F.col("event_id") % 4)
    rows = ev.withColumns({"kind": kind, "part": part}).where(F.col("kind").isNotNull())
    cols = {
        "exchange": F.lit("NFO"),
        "trading_symbol": F.concat(digits_to_letters("user_id"), F.lit("27MAR25"), F.col("part").cast("string"), "kind"),
        "symbol_token": F.concat("kind", F.col("part").cast("string"), F.lit("_"), F.col("user_id").cast("string")),
        "ltp": F.col("value").cast(DEC), "timestamp": F.col("ts").cast("timestamp_ntz"),
    }
    return rows.select(*[(cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in REALTIME_MARKET_DATA.fields])


def attach_week52(spark: SparkSession, sf_dir: str, df: DataFrame, token_col: str = "symbol_token") -> DataFrame:
    """Fill week_low_52 / week_high_52 of (reduced) tick rows from the
    per-user range; the user id is the numeric part of the adapter token."""
    uid = F.col(token_col).substr(F.lit(2), F.length(token_col) - 1).try_cast("bigint")
    rng = week52(spark, sf_dir)
    base = df.drop("week_low_52", "week_high_52").withColumn("_uid", uid)
    j = base.join(rng, base["_uid"] == rng["uid"], "left").drop("_uid", "uid")
    return j.select(*df.columns)


def bars(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """``historical_data``: one daily OHLCV bar per (supplier, ship date).

    Open/close are the first/last line by (orderkey, linenumber, partkey)
    (the triple, not the pair: the pair repeats in the generated data).
    The triple is packed exactly into one DECIMAL(38,0),
    orderkey * 10^18 + (linenumber * 10^12 + partkey), the inner part in
    BIGINT: lexicographic for any BIGINT orderkey, linenumber < 9*10^6 and
    partkey < 10^12. (The triple needs ~78 bits at 100 TB, so no exact BIGINT
    packing exists.) DECIMAL buffers stay mutable, so min_by/max_by keep a
    hash aggregate instead of the sort-based aggregate a struct key forces.

    A supplier has few lines a day, so map-side partials would hold about one
    entry a line of a task's whole split. The lines are dealt out by the key
    instead, into partitions of a bounded number of lines (a hot supplier's by
    the day), which are aggregated where they are.

    Some closes are missing (every fifth supplier, on the 13th) or zero (every
    seventh, on the 27th), so that indicators meet gaps.
    """
    li = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    d38 = "decimal(38,0)"
    low = F.col("l_linenumber").cast("bigint") * F.lit(10 ** 12) + F.col("l_partkey")
    order = F.col("l_orderkey").cast(d38) * F.lit(str(10 ** 18)).cast(d38) + low.cast(d38)
    n, most = li.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(n // LINES_A_TASK, min(most, n // (LINES_A_TASK // 10))) + 2   # by key, also of few lines
    lines = li.select("l_suppkey", F.to_date("l_shipdate").alias("trade_date"), "l_orderkey", "l_linenumber", "l_partkey",
                      "l_extendedprice", "l_quantity").repartition(parts, "l_suppkey", "trade_date")
    g = (lines.groupBy("l_suppkey", "trade_date")
           .agg(F.min_by("l_extendedprice", order).alias("o"),
                F.max("l_extendedprice").alias("h"),
                F.min("l_extendedprice").alias("l"),
                F.max_by("l_extendedprice", order).alias("c"),
                F.sum("l_quantity").alias("v")))
    on = F.dayofmonth("trade_date")
    close = (F.when((F.col("l_suppkey") % 5 == 0) & (on == 13), F.lit(None))
              .when((F.col("l_suppkey") % 7 == 3) & (on == 27), F.lit(0)).otherwise(F.col("c")))
    return g.select(
        F.concat(F.lit("E"), F.col("l_suppkey").cast("string")).alias("token"),
        digits_to_letters("l_suppkey").alias("symbol_name"),
        F.col("trade_date").cast("timestamp_ntz").alias("timestamp"),
        F.col("o").cast(DEC).alias("open"), F.col("h").cast(DEC).alias("high"),
        F.col("l").cast(DEC).alias("low"), close.cast(DEC).alias("close"),
        F.col("v").cast("bigint").alias("volume"),
    )


def raw_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument master as text columns: equities, futures (two expiries), option chain.

    The distinct users are computed once and checkpointed: the three
    branches and the option-chain modulus all read that small result
    instead of re-scanning ``events``."""
    from quantbeam.session import materialize
    u = materialize(underlyings(spark, sf_dir))
    uid_s = F.col("uid").cast("string")
    lot = (F.lit(50) + F.lit(25) * (F.col("uid") % 4)).cast("string")
    equity = u.select(
        F.concat(F.lit("E"), uid_s).alias("token"), F.concat("name", F.lit("-EQ")).alias("symbol"),
        "name", F.lit("").alias("expiry"), F.lit("-1.000000").alias("strike"), F.lit("1").alias("lotsize"),
        F.lit("").alias("instrumenttype"), F.lit("NSE").alias("exch_seg"), F.lit("5.000000").alias("tick_size"))
    fut_variants = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(e).alias("e")) for p, e in FUTURES_VARIANTS])
    futures = (u.select("uid", "name", F.explode(fut_variants).alias("x"))
                .select(F.concat("x.p", uid_s).alias("token"),
                        F.concat("name", "x.e", F.lit("FUT")).alias("symbol"), "name",
                        F.col("x.e").alias("expiry"), F.lit("-1.000000").alias("strike"), lot.alias("lotsize"),
                        F.lit("FUTSTK").alias("instrumenttype"), F.lit("NFO").alias("exch_seg"),
                        F.lit("5.000000").alias("tick_size")))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    n_under = u.select(F.count(F.lit(1))).scalar()
    opt_variants = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(e).alias("e")) for o, e in OPTION_VARIANTS])
    options = (part.withColumn("uid", F.col("p_partkey") % n_under)
                   .join(u, "uid", "inner")
                   .select("*", F.explode(opt_variants).alias("x"))
                   .select(F.concat("x.o", F.col("p_partkey").cast("string"), F.lit("_"), uid_s).alias("token"),
                           F.concat("name", "x.e", F.col("p_size").cast("string"), "x.o").alias("symbol"), "name",
                           F.col("x.e").alias("expiry"),
                           F.concat((F.col("p_size") * 1000).cast("string"), F.lit(".000000")).alias("strike"),
                           lot.alias("lotsize"), F.lit("OPTSTK").alias("instrumenttype"),
                           F.lit("NFO").alias("exch_seg"), F.lit("5.000000").alias("tick_size")))
    return equity.unionByName(futures).unionByName(options)
