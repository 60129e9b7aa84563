"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantbeam.schemas import DEC

# date/time formats of the instrument master and quote feed.
EXPIRY_FORMAT = "ddMMMyyyy"            # e.g. 27MAR2025
DB_DATE_FORMAT = "yyyy-MM-dd"
FEED_TIME_FORMAT = "dd-MMM-yyyy HH:mm:ss"  # e.g. 12-Mar-2025 15:29:59


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_expiry(x) -> Column:
    """Expiry text -> DATE; anything unparseable (incl. '') -> NULL."""
    return F.try_to_date(_c(x), EXPIRY_FORMAT)


def format_date(x) -> Column:
    return F.date_format(_c(x), DB_DATE_FORMAT)


def parse_feed_time(x) -> Column:
    """Quote feed time text -> TIMESTAMP_NTZ; empty/invalid -> NULL."""
    return F.try_to_timestamp(F.nullif(_c(x), F.lit("")), F.lit(FEED_TIME_FORMAT)).cast("timestamp_ntz")


def to_decimal(x) -> Column:
    """Numeric coercion: text/number -> DECIMAL(18,6), invalid -> NULL."""
    return _c(x).try_cast(DEC)


def to_int(x) -> Column:
    return _c(x).try_cast("decimal(38,6)").try_cast("int")


def strip_last3(x) -> Column:
    """substr(s, 1, length(s) - 3): equity symbol 'ABC-EQ' -> 'ABC'."""
    c = _c(x)
    return c.substr(F.lit(1), F.length(c) - 3)


def strip_eq(x) -> Column:
    """Remove every '-EQ' occurrence (literal replace)."""
    return F.replace(_c(x), F.lit("-EQ"), F.lit(""))


def concat_eq(x) -> Column:
    return F.concat(_c(x), F.lit("-EQ"))


def option_type_suffix(x) -> Column:
    """Last two characters of a trading symbol (CE / PE / UT ...)."""
    return _c(x).substr(-2, 2)


def option_type_regex(x) -> Column:
    """'CE'/'PE' when the symbol ends with one of them, else NULL."""
    return F.nullif(F.regexp_extract(_c(x), r"(CE|PE)$", 1), F.lit(""))


def underlying(x) -> Column:
    """Leading non-digit run of a symbol; '' when the symbol starts with a digit."""
    return F.regexp_extract(_c(x), r"^([^0-9]+)", 1)


def digits_to_letters(x) -> Column:
    """Adapter helper: 123 -> 'BCD' (keeps names free of digits)."""
    return F.translate(_c(x).cast("string"), "0123456789", "ABCDEFGHIJ")


def safe_div(a, b) -> Column:
    """a / b as DOUBLE with NULL on zero or NULL divisor."""
    return F.try_divide(_c(a).cast("double"), F.nullif(_c(b).cast("double"), F.lit(0.0)))


def default_if_null_or_zero(x, default) -> Column:
    c = _c(x)
    return F.when(c.isNull() | (c == 0), F.lit(default)).otherwise(c)


def like_literal(x, needle: str) -> Column:
    """Case-sensitive substring test with the needle taken literally."""
    return F.contains(_c(x), F.lit(needle))


def contains_ci(x, needle: str) -> Column:
    """Case-insensitive literal substring test (no regex)."""
    return F.contains(F.lower(_c(x)), F.lit(needle.lower()))
