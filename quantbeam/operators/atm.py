"""At-the-money option selection from futures prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantbeam.functions.scalars import option_type_regex
from quantbeam.operators.tokens import TYPE_EQUITY, TYPE_FUTURES, TYPE_OPTIONS
from quantbeam.session import materialize

# Default strike spacing when none is known (NULL or 0).
DEFAULT_DISTANCE = {"NIFTY": 50, "BANKNIFTY": 100}
DEFAULT_STOCK_DISTANCE = 5


def futures_price_by_name(quotes: DataFrame, tm: DataFrame) -> DataFrame:
    """Futures quotes -> (name, futures_price); the newest quote per name wins.

    ``quotes`` needs symbol_token, ltp and timestamp. They are reduced to the
    newest of each token (a hash aggregate with map-side partials) before they
    meet the master.
    """
    fut = tm.where(F.col("token_type") == TYPE_FUTURES).select(F.col("token").alias("symbol_token"), "name")
    j = newest_price(quotes).join(fut, "symbol_token", "inner")
    return j.groupBy("name").agg(
        F.max_by("ltp", F.struct("timestamp", "symbol_token")).alias("futures_price"))


def newest_price(quotes: DataFrame) -> DataFrame:
    """(symbol_token, ltp, timestamp) of each token's newest quote."""
    return quotes.groupBy("symbol_token").agg(F.max_by("ltp", "timestamp").alias("ltp"), F.max("timestamp").alias("timestamp"))


def strike_spacing(name_col, dist_col):
    """Strike spacing of an option: its own when known and non-zero, else
    the default for the underlying."""
    expr = F.when(dist_col.isNotNull() & (dist_col != 0), dist_col)
    for n, v in DEFAULT_DISTANCE.items():
        expr = expr.when(name_col == n, F.lit(v))
    return expr.otherwise(F.lit(DEFAULT_STOCK_DISTANCE))


def near_atm_options(tm: DataFrame, prices: DataFrame, strike_buffer: int = 1) -> DataFrame:
    """Options within ``strike_buffer`` strike spacings of the futures price
    (inclusive). Compared as |fut - strike| <= buffer * spacing, exact in
    decimals. Options without a price, name or strike are dropped."""
    o = tm.where(F.col("token_type") == TYPE_OPTIONS).where(F.col("strike").isNotNull())
    j = o.join(prices, "name", "inner")
    dist = strike_spacing(F.col("name"), F.col("strike_distance"))
    keep = F.abs(F.col("futures_price") - F.col("strike")) <= F.lit(strike_buffer) * dist
    return j.where(keep).select(*tm.columns)


def closest_strikes(tm: DataFrame, prices: DataFrame) -> DataFrame:
    """Per (name, CE/PE): the single closest strike with its ``atm_distance``;
    ties -> lower strike, then earlier expiry, then token. Symbols without CE/PE
    are dropped."""
    o = (tm.where(F.col("token_type") == TYPE_OPTIONS).where(F.col("strike").isNotNull())
           .withColumn("option_type", option_type_regex("symbol"))
           .where(F.col("option_type").isNotNull()))
    j = o.join(prices, "name", "inner").withColumn(
        "atm_distance", F.abs(F.col("strike") - F.col("futures_price")))
    cols = [*(c for c in tm.columns if c != "name"), "atm_distance"]
    key = F.struct("atm_distance", "strike", "expiry", "token")
    best = j.groupBy("name", "option_type").agg(F.min_by(F.struct(*cols), key).alias("_r"))
    return best.select("name", "option_type", *[F.col(f"_r.{c}").alias(c) for c in cols])


def exact_atm_options(tm: DataFrame, prices: DataFrame) -> DataFrame:
    """The options of ``closest_strikes``."""
    return closest_strikes(tm, prices).drop("atm_distance")


def straddle_by_contract(tm: DataFrame, prices: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per underlying: the newest prices of the very contracts at the money,
    matched by token, and their sum (of what is quoted; NULL if neither is).
    Unlike a straddle by symbol text it does not mix strikes, and holds for
    names with digits."""
    legs = exact_atm_options(tm, prices).select("name", "option_type", "strike", F.col("token").alias("symbol_token"))
    priced = legs.join(newest_price(quotes).select("symbol_token", "ltp"), "symbol_token", "left")
    leg = lambda kind, c: F.max(F.when(F.col("option_type") == kind, F.col(c)))
    return priced.groupBy("name").agg(
        leg("CE", "strike").alias("ce_strike"), leg("PE", "strike").alias("pe_strike"),
        leg("CE", "ltp").alias("ce_price"), leg("PE", "ltp").alias("pe_price"), F.sum("ltp").alias("atm_price"))


def _first(df: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """The first ``limit`` rows by a total order; all without a limit."""
    return df if limit is None else df.orderBy(*order).limit(limit)


def union_fetch_set(tm: DataFrame, options: DataFrame, equity_limit: int | None = None,
                    options_limit: int | None = None) -> DataFrame:
    """Second-pass quote set: equities ∪ selected options (futures came first),
    each cut to its limit: equities by token, options by name, strike, expiry
    and token."""
    eq = _first(tm.where(F.col("token_type") == TYPE_EQUITY), ["token"], equity_limit)
    opt = _first(options, ["name", "strike", "expiry", "token"], options_limit)
    columns = ["token", "name", "exch_seg", "token_type"]
    return eq.select(*columns).unionByName(opt.select(*columns))


def first_pass_tokens(tm: DataFrame, futures_limit: int | None = None) -> DataFrame:
    """The futures whose quotes give the prices, cut to the limit by token."""
    return _first(tm.where(F.col("token_type") == TYPE_FUTURES), ["token"], futures_limit)


def atm_two_pass(tm: DataFrame, futures_quotes: DataFrame, strike_buffer: int = 1, exact_atm_only: bool = False,
                 atm_only: bool = True, equity_limit: int | None = None, options_limit: int | None = None,
                 futures_limit: int | None = None) -> DataFrame:
    """Both passes: futures quotes -> prices -> options -> the token set of the
    second request pass. Without ``atm_only``, or if no futures quote came in,
    all options are asked for."""
    options = tm.where(F.col("token_type") == TYPE_OPTIONS)
    if atm_only:
        wanted = first_pass_tokens(tm, futures_limit).select(F.col("token").alias("symbol_token"))
        # One row per future: written, as the choice below and the plan both read it.
        prices = materialize(futures_price_by_name(futures_quotes.join(wanted, "symbol_token", "left_semi"), tm)
                             if futures_limit is not None else futures_price_by_name(futures_quotes, tm), "futures-prices")
        if not prices.isEmpty():
            options = exact_atm_options(tm, prices) if exact_atm_only else near_atm_options(tm, prices, strike_buffer)
    return union_fetch_set(tm, options, equity_limit, options_limit)
