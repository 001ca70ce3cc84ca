import pytest
from pyspark.sql import functions as F

from tradelens.functions import normalize_date, quarter_key, quarter_label, year_month_key
from tradelens.functions.periods import quarter_of_ym
from tradelens.operators.aggregate import aggregate_by_date, aggregate_by_quarter, count_records, sort_by_date
from tradelens.operators.growth import filter_by_year, process_quarterly

from conftest import rows


def test_period_keys(spark):
    df = spark.createDataFrame([("2024-03",), ("2024/11",), ("2024-1",), ("2024-13",), ("x024-01",), ("2024-+1",), (None,)], "d string")
    got = [tuple(r) for r in df.select(year_month_key("d"), quarter_key("d"), normalize_date("d")).collect()]
    assert got == [
        (202403, 20241, "2024-03"),
        (202411, 20244, "2024-11"),
        (202401, 20241, "2024-1"),
        (202413, None, "2024-13"),
        (None, None, "x024-01"),
        (None, None, "2024-+1"),
        (None, None, None),
    ]
    labels = [r[0] for r in spark.createDataFrame([(20241,), (19994,)], "q int").select(quarter_label("q")).collect()]
    assert labels == ["2024Q1", "1999Q4"]
    assert [r[0] for r in spark.createDataFrame([(202412,), (202400,)], "y int").select(quarter_of_ym("y")).collect()] == [20244, None]


def test_decimal_sums_are_exact_and_nan_counts_zero(spark):
    dec = spark.createDataFrame([("2024-01", "0.10"), ("2024-01", "0.20"), ("2024-01", None)], "date string, a string").select(
        "date", F.col("a").cast("decimal(18,2)").alias("export_amount")
    )
    assert rows(aggregate_by_date(dec)) == [("2024-01", 0.3)]  # 0.1 + 0.2 in DECIMAL, then double
    dbl = spark.createDataFrame([("2024-01", float("nan")), ("2024-02", float("nan")), ("2024-02", 2.0)], "date string, export_amount double")
    assert rows(aggregate_by_date(dbl)) == [("2024-01", 0.0), ("2024-02", 2.0)]
    q = rows(aggregate_by_quarter(dbl), "quarter", "export_amount")
    assert q == [("2024Q1", 2.0)]


def test_unreadable_periods_fail_loudly(spark):
    df = spark.createDataFrame([("2023-13", 5.0), ("2024-01", 10.0)], "date string, export_amount double")
    with pytest.raises(Exception, match="no quarter for date 2023-13"):
        process_quarterly(df).collect()
    with pytest.raises(Exception, match="no year in x"):
        filter_by_year(spark.createDataFrame([("x", 1.0)], df.schema), 2000, 2030).collect()


def test_counts_and_sorting(spark):
    df = spark.createDataFrame([("a", "2024Q2"), ("a", "2024Q1"), ("b", "2023Q4")], "s string, quarter string")
    assert rows(count_records(df)) == [(3,)]
    assert rows(count_records(df, ["s"])) == [("a", 2), ("b", 1)]
    assert [r.quarter for r in sort_by_date(df, ["s"], "quarter").collect()] == ["2024Q1", "2024Q2", "2023Q4"]
