import math

from pyspark.sql import functions as F

from tradelens.functions import (
    coerce_amount,
    format_date,
    parse_month,
    parse_year,
    pct_change,
    round_half_even,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_year(spark):
    got = one_col(spark, ["2024년", "  2024년  ", "01월", "invalid", "", "2024년 합계", "20245년"], parse_year)
    assert got == ["2024", "2024", None, None, None, "2024", None]


def test_parse_month(spark):
    got = one_col(spark, ["01월", "1월", "  01월  ", "9월", "12월", "2024년", "123월", "총계"], parse_month)
    assert got == ["01", "01", "01", "09", "12", None, None, None]


def test_format_date(spark):
    df = spark.createDataFrame([("2024", "1"), ("2024", "01"), ("2024", "12")], "y string, m string")
    got = [r[0] for r in df.select(format_date("y", "m")).collect()]
    assert got == ["2024-01", "2024-01", "2024-12"]


def test_amount_coercion(spark):
    values = [None, "1,234", " 12 ", "1e3", "1.5d", "", "1_000", "-2.5", ".5", "inf", "-Infinity", "nan", "abc"]
    got = one_col(spark, values, lambda c: coerce_amount(c))
    assert got[:9] == [0.0, 0.0, 12.0, 1000.0, 0.0, 0.0, 1000.0, -2.5, 0.5]
    assert got[9] == math.inf and got[10] == -math.inf
    assert got[11] is None  # NaN contributes nothing to a sum
    assert got[12] == 0.0


def test_pct_change_scalar_cases(spark):
    df = spark.createDataFrame([(150.0, 100.0), (80.0, 100.0), (100.0, 100.0), (100.0, 0.0), (100.0, 3.0)], "c double, p double")
    got = [r[0] for r in df.select(pct_change("c", "p")).collect()]
    assert got == [50.0, -20.0, 0.0, None, 3233.33]


def test_pct_change_ieee_zero_base(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (1.0, None)], "c double, p double")
    got = [r[0] for r in df.select(pct_change("c", "p", digits=2, zero_base="ieee", form="ratio")).collect()]
    assert got[0] == math.inf and math.isnan(got[1]) and got[2] == -math.inf and got[3] is None


def test_half_even_rounding(spark):
    got = one_col(spark, [0.125, 2.5, 3.5, -2.5, 0.375], lambda c: round_half_even(c, 2), "double")
    assert got == [0.12, 2.5, 3.5, -2.5, 0.38]
    got0 = one_col(spark, [2.5, 3.5, -2.5, 0.5, 1.5], lambda c: round_half_even(c, 0), "double")
    assert got0 == [2.0, 4.0, -2.0, 0.0, 2.0]
