"""Derived market-summary metrics (final projection)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantbeam.functions.scalars import safe_div

# Category labels of the summary.
ABOVE_SMA200, BELOW_SMA200, AT_SMA200 = "ABOVE_SMA200", "BELOW_SMA200", "AT_SMA200"
BULLISH, BEARISH, NEUTRAL = "BULLISH_CROSSOVER", "BEARISH_CROSSOVER", "NEUTRAL"


def atm_price_per_lot(atm_price: str = "atm_price", lotsize: str = "lotsize") -> Column:
    return F.col(atm_price) * F.col(lotsize)


def position_metric(ltp: str = "ltp", low: str = "week_low_52", high: str = "week_high_52") -> Column:
    """Position of ltp inside the 52-week range scaled to [-100, 100];
    NULL when the range is empty (high = low)."""
    frac = safe_div(F.col(ltp) - F.col(low), F.col(high) - F.col(low))
    return F.round(frac * F.lit(200.0) - F.lit(100.0), 2)


def sma_200_position(ltp: str = "ltp", sma: str = "sma_200") -> Column:
    """ABOVE / BELOW, and AT for equality or any NULL."""
    return (F.when(F.col(ltp) > F.col(sma), F.lit(ABOVE_SMA200))
             .when(F.col(ltp) < F.col(sma), F.lit(BELOW_SMA200))
             .otherwise(F.lit(AT_SMA200)))


def ma_crossover_status(fast: str = "sma_50", slow: str = "sma_200") -> Column:
    return (F.when(F.col(fast) > F.col(slow), F.lit(BULLISH))
             .when(F.col(fast) < F.col(slow), F.lit(BEARISH))
             .otherwise(F.lit(NEUTRAL)))


def sma_200_percent_diff(ltp: str = "ltp", sma: str = "sma_200") -> Column:
    return F.round(safe_div(F.col(ltp) - F.col(sma), F.col(sma)) * F.lit(100.0), 2)


def atm_total_price(ce: str = "atm_ce_price", pe: str = "atm_pe_price") -> Column:
    return F.coalesce(F.col(ce), F.lit(0)) + F.coalesce(F.col(pe), F.lit(0))
