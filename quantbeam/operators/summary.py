"""The market summary: one row per equity with quotes, futures, ATM
straddle and indicators (36 columns), plus the legacy summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantbeam.functions import derived as dv
from quantbeam.operators import ticks as tk
from quantbeam.operators.tokens import TYPE_EQUITY, TYPE_FUTURES
from quantbeam.schemas import MARKET_SUMMARY_COLUMNS, WIDE_INDICATOR_COLUMNS


def equity_master(tm: DataFrame) -> DataFrame:
    return tm.where(F.col("token_type") == TYPE_EQUITY).select("token", "symbol", "name", "futures_token")


def futures_master(tm: DataFrame) -> DataFrame:
    return (tm.where(F.col("token_type") == TYPE_FUTURES)
              .select(F.col("token").alias("fm_token"), F.col("expiry").cast("date").alias("expiry"),
                      "lotsize"))


def assemble_summary(tm: DataFrame, rel: DataFrame, rfl: DataFrame, rol: DataFrame,
                     indicators_wide: DataFrame) -> DataFrame:
    """The equities of the master with their facts, each a frame keyed by one
    of the equity's own columns: its futures contract (terms and newest quote),
    its newest quote and its straddle by name, its indicators by token; then the
    36-column projection with the derived metrics.

    Every frame of facts is one row per key (a reduced aggregate or a
    dimension), so the joins run on dimension-sized inputs; AQE turns them
    into broadcast joins only when the measured side is small.
    """
    contracts = (futures_master(tm).join(rfl.drop("trading_symbol"), F.col("fm_token") == F.col("symbol_token"), "left")
                 .drop("symbol_token").withColumnRenamed("fm_token", "futures_token"))
    facts = [("futures_token", contracts), ("name", rel.drop("trading_symbol")),
             ("name", rol.withColumnRenamed("underlying_name", "name")),
             ("token", indicators_wide.select("token", *WIDE_INDICATOR_COLUMNS))]
    j = equity_master(tm)
    for key, of_key in facts:
        j = j.join(of_key, key, "left")
    derived = {
        "atm_price_per_lot": dv.atm_price_per_lot(),
        "position_metric": dv.position_metric(),
        "sma_200_position": dv.sma_200_position(),
        "ma_crossover_status": dv.ma_crossover_status(),
        "sma_200_percent_diff": dv.sma_200_percent_diff(),
    }
    return j.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in MARKET_SUMMARY_COLUMNS])


def market_summary(tm: DataFrame, ticks: DataFrame, indicators_wide: DataFrame,
                   materialize_quotes: bool = False) -> DataFrame:
    """The summary view. Latest equity / futures / option quotes come from
    one aggregate over the ticks (``latest_quotes``); with
    ``materialize_quotes`` that small aggregate is checkpointed so its
    three consumers share a single scan of the tick table."""
    q = tk.latest_quotes(ticks)
    if materialize_quotes:
        from quantbeam.session import materialize
        q = materialize(q)
    return market_summary_from_quotes(tm, q, indicators_wide)


def market_summary_from_quotes(tm: DataFrame, quotes: DataFrame, indicators_wide: DataFrame) -> DataFrame:
    """The summary from an already reduced ``latest_quotes`` frame."""
    return assemble_summary(tm, tk.equity_from_quotes(quotes), tk.futures_from_quotes(quotes),
                            tk.straddle_from_quotes(quotes), indicators_wide)


def legacy_summary(tm: DataFrame, ticks: DataFrame, enrich=None) -> DataFrame:
    """Intent of the legacy view: latest equity tick ⋈ token (inner),
    ⟕ latest futures tick, ⟕ latest CE / PE option tick by underlying
    name; missing option prices count as 0; ordered by symbol."""
    last = tk.latest_tick_all(ticks, enrich).select("symbol_token", "ltp", "percent_change",
                                                    "week_high_52", "week_low_52")
    eq = (tm.where(F.col("token_type") == TYPE_EQUITY)
            .join(last, F.col("token") == F.col("symbol_token"), "inner")
            .select(F.col("token").alias("equity_token"), F.col("symbol").alias("equity_symbol"),
                    F.col("name").alias("equity_name"), "futures_token",
                    F.col("ltp").alias("equity_price"), F.col("percent_change").alias("equity_percent_change"),
                    F.col("week_high_52").alias("equity_52w_high"), F.col("week_low_52").alias("equity_52w_low")))
    fut = (tm.where(F.col("token_type") == TYPE_FUTURES)
             .join(last, F.col("token") == F.col("symbol_token"), "inner")
             .select(F.col("token").alias("f_token"), F.col("ltp").alias("futures_price"),
                     F.col("percent_change").alias("futures_percent_change")))
    opt = tk.latest_option_by_type(ticks)
    ce = opt.where(F.col("option_type") == "CE").select(F.col("underlying_name").alias("ce_name"),
                                                        F.col("ltp").alias("atm_ce"))
    pe = opt.where(F.col("option_type") == "PE").select(F.col("underlying_name").alias("pe_name"),
                                                        F.col("ltp").alias("atm_pe"))
    j = (eq.join(fut, F.col("futures_token") == F.col("f_token"), "left")
           .join(ce, F.col("equity_name") == F.col("ce_name"), "left")
           .join(pe, F.col("equity_name") == F.col("pe_name"), "left"))
    zero = F.lit(0).cast("decimal(18,6)")
    return (j.select("equity_token", "equity_symbol", "equity_name", "equity_price", "equity_percent_change",
                     "equity_52w_high", "equity_52w_low", "futures_price", "futures_percent_change",
                     (F.coalesce("atm_ce", zero) + F.coalesce("atm_pe", zero)).alias("atm_total_price"),
                     F.coalesce("atm_ce", zero).alias("atm_ce_price"),
                     F.coalesce("atm_pe", zero).alias("atm_pe_price"))
             .orderBy("equity_symbol"))


def legacy_tick_join(tm: DataFrame, ticks: DataFrame, token_type: str = TYPE_FUTURES) -> DataFrame:
    """LEFT JOIN + WHERE on the tick side == inner join of tokens and latest ticks."""
    last = tk.latest_tick_all(ticks)
    return (tm.where(F.col("token_type") == token_type).select("token", "symbol", "name")
              .join(last, F.col("token") == F.col("symbol_token"), "inner")
              .select("token", "symbol", "name", "ltp", "percent_change", "timestamp"))

