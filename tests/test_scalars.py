import datetime as dt

from pyspark.sql import functions as F

from quantbeam.functions import scalars as sc


def test_parse_expiry_and_format(spark):
    df = spark.createDataFrame([("27MAR2025",), ("24Apr2025",), ("",), ("bad",)], "e string")
    out = df.select(sc.parse_expiry("e").alias("d"), sc.format_date(sc.parse_expiry("e")).alias("s")).collect()
    assert out[0].d == dt.date(2025, 3, 27) and out[0].s == "2025-03-27"
    assert out[1].d == dt.date(2025, 4, 24)
    assert out[2].d is None and out[3].d is None


def test_parse_feed_time(spark):
    df = spark.createDataFrame([("12-Mar-2025 15:29:59",), ("",), (None,)], "t string")
    out = [r[0] for r in df.select(sc.parse_feed_time("t")).collect()]
    assert out == [dt.datetime(2025, 3, 12, 15, 29, 59), None, None]


def test_underlying_and_option_type(spark):
    df = spark.createDataFrame([("3MINDIA27MAR25FUT",), ("ABC27MAR25100CE",), ("RELIANCE-EQ",)], "s string")
    out = df.select(sc.underlying("s").alias("u"), sc.option_type_regex("s").alias("o"),
                    sc.option_type_suffix("s").alias("x")).collect()
    assert [r.u for r in out] == ["", "ABC", "RELIANCE-EQ"]
    assert [r.o for r in out] == [None, "CE", None]
    assert [r.x for r in out] == ["UT", "CE", "EQ"]


def test_strip_suffixes(spark):
    df = spark.createDataFrame([("ABC-EQ",), ("X-EQ-EQ",)], "s string")
    out = df.select(sc.strip_last3("s").alias("a"), sc.strip_eq("s").alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [("ABC", "ABC"), ("X-EQ", "X")]


def test_literal_search_special_chars(spark):
    df = spark.createDataFrame([("A%B",), ("AxB",), ("a.b",), ("a&b",), ("A_B",), (None,)], "s string")
    def hits(needle, ci):
        f = sc.contains_ci if ci else sc.like_literal
        return sorted(r.s for r in df.where(f("s", needle)).collect())
    assert hits("%", False) == ["A%B"]
    assert hits("_", False) == ["A_B"]
    assert hits(".", False) == ["a.b"]
    assert hits("&", True) == ["a&b"]
    assert hits("a%b", True) == ["A%B"]


def test_safe_div_and_default(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (3.0, 2.0, 0.0), (1.0, None, 7.0)], "a double, b double, c double")
    out = df.select(sc.safe_div("a", "b").alias("q"), sc.default_if_null_or_zero("c", 5).alias("d")).collect()
    assert [r.q for r in out] == [None, 1.5, None]
    assert [r.d for r in out] == [5.0, 5.0, 7.0]
