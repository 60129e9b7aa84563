"""Reference data model as Spark StructTypes."""

from pyspark.sql import types as T

DEC = T.DecimalType(18, 6)

# Instrument master as delivered (JSON array; every field is text).
RAW_INSTRUMENTS = T.StructType([
    T.StructField(n, T.StringType()) for n in
    ["token", "symbol", "name", "expiry", "strike", "lotsize",
     "instrumenttype", "exch_seg", "tick_size"]
])

TOKEN_MASTER = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("expiry", T.DateType()),
    T.StructField("strike", DEC),
    T.StructField("lotsize", T.IntegerType()),
    T.StructField("instrumenttype", T.StringType()),
    T.StructField("exch_seg", T.StringType()),
    T.StructField("tick_size", DEC),
    T.StructField("token_type", T.StringType()),
    T.StructField("futures_token", T.StringType()),
    T.StructField("strike_distance", DEC),
    T.StructField("created_at", T.TimestampNTZType()),
])
TOKEN_MASTER_COLUMNS = [f.name for f in TOKEN_MASTER.fields if f.name != "created_at"]

# Candle payload: one document per token, data = [[ts, o, h, l, c, v], ...]
CANDLES_JSON = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("interval", T.StringType()),    # bar size; daily if absent
    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
])

HISTORICAL_DATA = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("symbol_name", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("open", DEC),
    T.StructField("high", DEC),
    T.StructField("low", DEC),
    T.StructField("close", DEC),
    T.StructField("volume", T.LongType()),
])

_DEPTH_LEVEL = T.ArrayType(T.StructType([
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("orders", T.LongType()),
]))
DEPTH = T.StructType([T.StructField("buy", _DEPTH_LEVEL), T.StructField("sell", _DEPTH_LEVEL)])

QUOTE_FETCHED = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("tradingSymbol", T.StringType()),
    T.StructField("symbolToken", T.StringType()),
    T.StructField("ltp", T.StringType()),
    T.StructField("open", T.StringType()),
    T.StructField("high", T.StringType()),
    T.StructField("low", T.StringType()),
    T.StructField("close", T.StringType()),
    T.StructField("lastTradeQty", T.StringType()),
    T.StructField("exchFeedTime", T.StringType()),
    T.StructField("exchTradeTime", T.StringType()),
    T.StructField("netChange", T.StringType()),
    T.StructField("percentChange", T.StringType()),
    T.StructField("avgPrice", T.StringType()),
    T.StructField("tradeVolume", T.StringType()),
    T.StructField("opnInterest", T.StringType()),
    T.StructField("lowerCircuit", T.StringType()),
    T.StructField("upperCircuit", T.StringType()),
    T.StructField("totBuyQuan", T.StringType()),
    T.StructField("totSellQuan", T.StringType()),
    T.StructField("52WeekLow", T.StringType()),
    T.StructField("52WeekHigh", T.StringType()),
    T.StructField("depth", DEPTH),
])
QUOTE_UNFETCHED = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("symbolToken", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("errorCode", T.StringType()),
])
QUOTES_JSON = T.StructType([
    T.StructField("status", T.BooleanType()),
    T.StructField("fetched_at", T.StringType()),  # landing metadata: snapshot time
    T.StructField("data", T.StructType([
        T.StructField("fetched", T.ArrayType(QUOTE_FETCHED)),
        T.StructField("unfetched", T.ArrayType(QUOTE_UNFETCHED)),
    ])),
])

REALTIME_MARKET_DATA = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("trading_symbol", T.StringType()),
    T.StructField("symbol_token", T.StringType()),
    T.StructField("ltp", DEC),
    T.StructField("open", DEC),
    T.StructField("high", DEC),
    T.StructField("low", DEC),
    T.StructField("close", DEC),
    T.StructField("last_trade_qty", T.IntegerType()),
    T.StructField("exch_feed_time", T.TimestampNTZType()),
    T.StructField("exch_trade_time", T.TimestampNTZType()),
    T.StructField("net_change", DEC),
    T.StructField("percent_change", DEC),
    T.StructField("avg_price", DEC),
    T.StructField("trade_volume", T.LongType()),
    T.StructField("opn_interest", T.LongType()),
    T.StructField("lower_circuit", DEC),
    T.StructField("upper_circuit", DEC),
    T.StructField("tot_buy_quan", T.LongType()),
    T.StructField("tot_sell_quan", T.LongType()),
    T.StructField("week_low_52", DEC),
    T.StructField("week_high_52", DEC),
    T.StructField("depth_json", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
TICK_COLUMNS = [f.name for f in REALTIME_MARKET_DATA.fields]

TECHNICAL_INDICATORS = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("symbol_name", T.StringType()),
    T.StructField("indicator_name", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("value", DEC),
    T.StructField("period", T.IntegerType()),
])

# Indicator configuration (name, periods) and the fetch multiplier.
INDICATOR_PERIODS = {
    "sma": [50, 100, 200],
    "ema": [20, 50, 200],
    "rsi": [14, 21],
    "volatility": [21, 200],
}
FETCH_MULTIPLIER = 1.5
WIDE_INDICATOR_COLUMNS = [f"{k}_{p}" for k, ps in INDICATOR_PERIODS.items() for p in ps]

TECHNICAL_INDICATORS_SUMMARY = T.StructType(
    [T.StructField("token", T.StringType()),
     T.StructField("symbol_name", T.StringType()),
     T.StructField("trade_date", T.DateType())]
    + [T.StructField(c, DEC) for c in WIDE_INDICATOR_COLUMNS]
    + [T.StructField("last_close", DEC), T.StructField("last_volume", T.LongType())]
)

MARKET_SUMMARY_COLUMNS = [
    "token", "symbol", "name", "futures_token", "lotsize", "expiry",
    "ltp", "percent_change", "open", "high", "low", "close", "volume", "opn_interest",
    "week_low_52", "week_high_52",
    "futures_ltp", "futures_percent_change", "futures_volume", "futures_oi",
    "atm_price", "atm_price_per_lot", "position_metric",
    "sma_50", "sma_100", "sma_200", "ema_20", "ema_50", "ema_200",
    "rsi_14", "rsi_21", "volatility_21", "volatility_200",
    "sma_200_position", "ma_crossover_status", "sma_200_percent_diff",
]

_SUMMARY_TYPES = {
    **dict.fromkeys(["token", "symbol", "name", "futures_token", "sma_200_position", "ma_crossover_status"], T.StringType()),
    **dict.fromkeys(["volume", "opn_interest", "futures_volume", "futures_oi"], T.LongType()),
    **dict.fromkeys(["position_metric", "sma_200_percent_diff"], T.DoubleType()),
    "lotsize": T.IntegerType(), "expiry": T.DateType(),
    "atm_price": T.DecimalType(28, 6), "atm_price_per_lot": T.DecimalType(38, 6),
}
MARKET_SUMMARY = T.StructType([T.StructField(c, _SUMMARY_TYPES.get(c, DEC)) for c in MARKET_SUMMARY_COLUMNS])
