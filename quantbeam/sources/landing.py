"""JSON landing sources: instrument master, candles and quote envelopes.

HTTP fetching is out of scope; payloads land as files and are read with
explicit schemas (no inference), exploded and typed with native casts.

Rows keep the order in which they arrived: ``file_place`` names the file and
block that a row was read from, ``with_arrival`` adds its place among the rows
of the block. Files rank by modification time, then path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantbeam.functions.scalars import parse_feed_time, to_decimal
from quantbeam.operators.upserts import ARRIVAL, DEFAULT_INTERVAL
from quantbeam.schemas import (CANDLES_JSON, DEC, DEPTH, QUOTES_JSON, RAW_INSTRUMENTS,
                               REALTIME_MARKET_DATA)

PLACE = "_place"


def file_place() -> Column:
    """Where a row was read: comparable over files and their blocks. A stream
    carries this, as it cannot number its rows."""
    m = F.col("_metadata")
    return F.struct(m["file_modification_time"].alias("modified"), m["file_path"].alias("file"),
                    m["file_block_start"].alias("block"))


def with_arrival(rows: DataFrame) -> DataFrame:
    """Turn ``PLACE`` into ``ARRIVAL``, numbering the rows of each block. Call
    it on what was read, before any shuffle."""
    place = F.col(PLACE)
    at = F.struct(place["modified"].alias("modified"), place["file"].alias("file"), place["block"].alias("block"),
                  F.monotonically_increasing_id().alias("row"), F.lit(0).alias("item"))
    return rows.withColumn(ARRIVAL, at).drop(PLACE)


def _carried(rows: DataFrame, item: Column) -> list[Column]:
    """``ARRIVAL`` of the ``item``-th row made of a row, if there is one."""
    return [F.col(ARRIVAL).withField("item", item).alias(ARRIVAL)] if ARRIVAL in rows.columns else []


def read_batch(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Landed files of a table's shape, with their order of arrival."""
    return with_arrival(spark.read.schema(schema).format(fmt).load(path).select("*", file_place().alias(PLACE)))


def read_instruments_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Instrument master files, all fields text: JSON arrays of records
    (``multi_line``, as delivered) or JSON lines."""
    return spark.read.schema(RAW_INSTRUMENTS).option("multiLine", multi_line).json(path)


def valid_candle(candles: DataFrame) -> DataFrame:
    """Drop candle arrays with fewer than 6 fields."""
    return candles.where(F.size("candle") >= 6)


def candles_to_bars(docs: DataFrame) -> DataFrame:
    """One document per token with data = [[ts, o, h, l, c, v], ...] -> bars.
    A document without ``interval`` has daily bars."""
    c = docs.select("*", F.posexplode("data").alias("_item", "candle"))
    c = valid_candle(c)
    item = lambda i: F.element_at("candle", i + 1)
    interval = F.col("interval") if "interval" in docs.columns else F.lit(None).cast("string")
    return c.select(
        "token", F.col("name").alias("symbol_name"),
        F.coalesce(interval, F.lit(DEFAULT_INTERVAL)).alias("interval"),
        F.coalesce(F.try_to_timestamp(item(0), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                   F.try_to_timestamp(item(0))).cast("timestamp_ntz").alias("timestamp"),
        to_decimal(item(1)).alias("open"), to_decimal(item(2)).alias("high"),
        to_decimal(item(3)).alias("low"), to_decimal(item(4)).alias("close"),
        to_decimal(item(5)).cast("bigint").alias("volume"), *_carried(docs, F.col("_item")))


def read_candles_json(spark: SparkSession, path: str, arrival: bool = False) -> DataFrame:
    """Landed candles as bars; with their order of arrival for an upsert."""
    bars = candles_to_bars(read_batch(spark, path, CANDLES_JSON, "json"))
    return bars if arrival else bars.drop(ARRIVAL)


def read_quotes_json(spark: SparkSession, path: str, arrival: bool = False) -> DataFrame:
    """Raw quote envelopes {status, data: {fetched: [...], unfetched: [...]}}."""
    if arrival:
        return read_batch(spark, path, QUOTES_JSON, "json")
    return spark.read.schema(QUOTES_JSON).json(path)


def quote_rows(envelopes: DataFrame, as_of=None) -> DataFrame:
    """fetched quotes of answers that succeeded -> realtime_market_data rows
    (snake_case, typed). ``timestamp`` is the snapshot time: the ``as_of``
    column, else the envelope's, else now."""
    at = F.coalesce(F.try_to_timestamp("fetched_at"), F.current_timestamp()) if as_of is None else as_of
    q = envelopes.where("status").select(*(c for c in [ARRIVAL] if c in envelopes.columns), at.alias("_ts"),
                                         F.posexplode("data.fetched").alias("_item", "q"))
    return quote_field_map(q.select("q.*", "_ts", *_carried(q, F.col("_item"))), ts_col="_ts")


def unfetched_rows(envelopes: DataFrame) -> DataFrame:
    return envelopes.where("status").select(F.explode("data.unfetched").alias("u")).select("u.*")


def quote_coverage(envelopes: DataFrame) -> DataFrame:
    """Counts of fetched and unfetched quotes over all answers that succeeded."""
    n = lambda c: F.coalesce(F.sum(F.coalesce(F.size(c), F.lit(0))), F.lit(0)).cast("bigint")
    return envelopes.where("status").agg(n("data.fetched").alias("fetched"), n("data.unfetched").alias("unfetched"))


# Quote JSON field -> table column.
QUOTE_FIELDS = {
    "exchange": "exchange", "tradingSymbol": "trading_symbol", "symbolToken": "symbol_token",
    "ltp": "ltp", "open": "open", "high": "high", "low": "low", "close": "close",
    "lastTradeQty": "last_trade_qty", "exchFeedTime": "exch_feed_time", "exchTradeTime": "exch_trade_time",
    "netChange": "net_change", "percentChange": "percent_change", "avgPrice": "avg_price",
    "tradeVolume": "trade_volume", "opnInterest": "opn_interest", "lowerCircuit": "lower_circuit",
    "upperCircuit": "upper_circuit", "totBuyQuan": "tot_buy_quan", "totSellQuan": "tot_sell_quan",
    "52WeekLow": "week_low_52", "52WeekHigh": "week_high_52",
}


def quote_field_map(q: DataFrame, ts_col: str = "_ts") -> DataFrame:
    """camelCase quote columns -> typed snake_case table columns; absent
    fields become NULL; depth -> JSON text ('{}' when missing)."""
    present = set(q.columns)
    by_target = {v: k for k, v in QUOTE_FIELDS.items()}
    out = []
    for f in REALTIME_MARKET_DATA.fields:
        if f.name == "depth_json":
            c = F.coalesce(F.to_json("depth"), F.lit("{}")) if "depth" in present else F.lit("{}")
        elif f.name == "timestamp":
            c = F.col(ts_col).cast("timestamp_ntz")
        else:
            src = by_target[f.name]
            if src not in present:
                c = F.lit(None)
            elif f.name in ("exch_feed_time", "exch_trade_time"):
                c = parse_feed_time(F.col(f"`{src}`"))
            elif f.dataType == DEC:
                c = to_decimal(F.col(f"`{src}`"))
            elif f.dataType.typeName() in ("integer", "long"):
                c = F.col(f"`{src}`").try_cast("decimal(38,6)")
            else:
                c = F.col(f"`{src}`")
        out.append(c.cast(f.dataType).alias(f.name))
    return q.select(*out, *(c for c in [ARRIVAL] if c in present))


def depth_from_json(df: DataFrame) -> DataFrame:
    """Read the stored depth text back into a struct."""
    return df.withColumn("depth", F.from_json("depth_json", DEPTH))
