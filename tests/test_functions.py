"""Column builders on literal edge cases."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import (bucketize, clamp_min, clean_header, clean_text, late_flag, lower_text,
                              map_lookup, null_if_before, null_nonpositive, pad_code, round_half_up,
                              safe_corr, to_decimal, to_int, to_timestamp, upper_text)


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_text(spark):
    assert col_values(spark, [" a ", "  ", None, "\ta"], clean_text) == ["a", None, None, "\ta"]
    assert col_values(spark, [" Ab "], lower_text) == ["ab"]
    assert col_values(spark, [" sp "], upper_text) == ["SP"]


def test_pad_code(spark):
    assert col_values(spark, ["123", "1234567", None, " 42 "], pad_code) == ["00123", "12345", None, "00042"]


def test_to_int(spark):
    vals = ["40", "40.0", "40.7", "-0.5", "1e12", "NaN", "abc", None]
    assert col_values(spark, vals, to_int) == [40, 40, 40, 0, None, None, None, None]


def test_to_decimal(spark):
    vals = ["12.345", "-1.005", "99999999999", "1e2", " 3 ", ""]
    expect = [Decimal("12.35"), Decimal("-1.01"), None, Decimal("100.00"), Decimal("3.00"), None]
    assert col_values(spark, vals, to_decimal) == expect


def test_to_timestamp(spark):
    vals = ["2017-10-02 10:56:33", "2017-10-02", "02/10/2017", "2017-02-30", ""]
    got = col_values(spark, vals, to_timestamp)
    assert got == [dt.datetime(2017, 10, 2, 10, 56, 33), dt.datetime(2017, 10, 2), None, None, None]


def test_clamp_and_nonpositive(spark):
    assert col_values(spark, [0, -2, 3, None], lambda c: clamp_min(c, 1), "int") == [1, 1, 3, None]
    assert col_values(spark, [0, -1, 5, None], null_nonpositive, "int") == [None, None, 5, None]


def test_null_if_before(spark):
    df = spark.createDataFrame([(1, 5), (5, 1), (None, 1), (3, None)], "a int, b int")
    got = [r[0] for r in df.select(null_if_before("a", "b")).collect()]
    assert got == [None, 5, None, 3]


def test_bucketize(spark):
    bounds = [(0, "1"), (3, "2"), (7, "3"), (14, "4")]
    vals = [0, 1, 3, 4, 7, 8, 14, 15, None]
    assert col_values(spark, vals, lambda c: bucketize(c, bounds, "5"), "int") == \
        ["1", "2", "2", "3", "3", "4", "4", "5", None]
    assert col_values(spark, vals, lambda c: bucketize(c, bounds, "5", null_to_else=True), "int")[-1] == "5"
    # exclusive bounds
    assert col_values(spark, [49, 50, 500], lambda c: bucketize(c, [(50, "a"), (500, "b")], "c", inclusive=False),
                      "int") == ["a", "b", "c"]


def test_map_lookup(spark):
    m = {"SP": "Sudeste", "AM": "Norte"}
    assert col_values(spark, ["SP", "XX", None], lambda c: map_lookup(c, m)) == ["Sudeste", None, None]


def test_late_flag(spark):
    assert col_values(spark, [-1, 0, 1, None], late_flag, "int") == [False, False, True, None]


def test_round_half_up(spark):
    assert col_values(spark, [1.005, 2.675, -1.005, 0.125], lambda c: round_half_up(c, 2), "double") == \
        [1.01, 2.68, -1.01, 0.13]


def test_safe_corr(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert one.agg(safe_corr("x", "y")).first()[0] is None
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert const.agg(safe_corr("x", "y")).first()[0] is None
    vary = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0)], "x double, y double")
    assert 0.98 < vary.agg(safe_corr("x", "y")).first()[0] <= 1.0


def test_clean_header():
    assert clean_header("\ufeffcustomer_id ") == "customer_id"
    assert clean_header(" price") == "price"


def test_date_key_is_as_formatted(spark):
    from strata.functions.columns import date_key
    days = ["0001-01-01", "0999-12-31", "1996-02-29", "2024-10-05 23:59:59.999999", "9999-12-31", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("d"))
    rows = df.select(date_key("d"), F.date_format("d", "yyyyMMdd").cast("int")).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] == [10101, 9991231, 19960229, 20241005, 99991231, None]
    far = spark.sql("SELECT make_date(12345, 6, 7) AS d")
    assert far.select(date_key("d")).first()[0] == far.select(F.date_format("d", "yyyyMMdd").cast("int")).first()[0]
