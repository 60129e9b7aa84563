"""Searches and conjunctive filters over the market summary and the
indicator summary. Every predicate is a plain Column so it reaches the
Parquet scan as a pushed filter when the input is a snapshot read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantbeam.functions.scalars import contains_ci, like_literal


def _and(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def search_symbol_ci(df: DataFrame, needle: str | None) -> DataFrame:
    """Case-insensitive literal substring on symbol or name."""
    if not needle:
        return df
    return df.where(contains_ci("symbol", needle) | contains_ci("name", needle))


def search_symbol_cs(df: DataFrame, needle: str | None) -> DataFrame:
    """Case-sensitive literal substring on symbol or name (LIKE '%s%')."""
    if not needle:
        return df
    return df.where(like_literal("symbol", needle) | like_literal("name", needle))


def search_indicator_summary(wide: DataFrame, token: str | None = None,
                             symbol: str | None = None) -> DataFrame:
    preds = []
    if token:
        preds.append(F.col("token") == token)
    if symbol:
        preds.append(like_literal("symbol_name", symbol))
    p = _and(preds)
    out = wide.where(p) if p is not None else wide
    return out.orderBy("symbol_name", "token")


def lookup_symbol_exact(df: DataFrame, symbol: str) -> DataFrame:
    """First row whose symbol equals ``symbol`` (deterministic: lowest token)."""
    return df.where(F.col("symbol") == symbol).orderBy("token").limit(1)


def _range(col: str, lo, hi) -> list[Column]:
    out = []
    if lo is not None:
        out.append(F.col(col) >= F.lit(lo))
    if hi is not None:
        out.append(F.col(col) <= F.lit(hi))
    return out


def filter_price_range(df: DataFrame, min_ltp=None, max_ltp=None,
                       min_percent_change=None, max_percent_change=None) -> DataFrame:
    """Inclusive optional bounds; a NULL value fails any bound given."""
    p = _and(_range("ltp", min_ltp, max_ltp) + _range("percent_change", min_percent_change, max_percent_change))
    return df.where(p) if p is not None else df


def filter_technical(df: DataFrame, sma_position: str | None = None, crossover_status: str | None = None,
                     min_rsi=None, max_rsi=None, min_volatility=None, max_volatility=None) -> DataFrame:
    preds = []
    if sma_position:
        preds.append(F.col("sma_200_position") == sma_position)
    if crossover_status:
        preds.append(F.col("ma_crossover_status") == crossover_status)
    preds += _range("rsi_14", min_rsi, max_rsi) + _range("volatility_21", min_volatility, max_volatility)
    p = _and(preds)
    return df.where(p) if p is not None else df


def order_by_symbol(df: DataFrame, col: str = "symbol") -> DataFrame:
    return df.orderBy(col, "token") if "token" in df.columns and col != "token" else df.orderBy(col)


def rows_as_json(df: DataFrame) -> DataFrame:
    """One JSON record per row (consumers' list-of-records form)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"))
