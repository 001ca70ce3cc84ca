from tradelens.operators.aggregate import aggregate_by_date, latest_per_group, sort_by_date
from tradelens.operators.growth import (
    filter_by_year,
    filter_quarterly_by_year,
    monthly_growth,
    process_quarterly,
    with_mom,
    with_yoy,
)

from conftest import rows

SCHEMA = "s string, date string, export_amount double"


def test_mom_positional(spark):
    df = spark.createDataFrame([("a", "2024-01", 100.0), ("a", "2024-02", 110.0), ("a", "2024-03", 121.0)], SCHEMA)
    assert rows(with_mom(df, ["s"]), "date", "export_mom") == [("2024-01", None), ("2024-02", 10.0), ("2024-03", 10.0)]


def test_yoy_calendar(spark):
    df = spark.createDataFrame([("a", "2022-01", 80.0), ("a", "2023-01", 100.0), ("a", "2024-01", 150.0)], SCHEMA)
    assert rows(with_yoy(df, ["s"]), "date", "export_yoy") == [("2022-01", None), ("2023-01", 25.0), ("2024-01", 50.0)]


def test_yoy_keeps_incoming_mom(spark):
    df = spark.createDataFrame([("2023-01", 100.0, None), ("2024-01", 150.0, 99.99)], "date string, export_amount double, export_mom double")
    out = with_yoy(df)
    assert rows(out, "date", "export_mom", "export_yoy") == [("2023-01", None, None), ("2024-01", 99.99, 50.0)]


def test_growth_gap_golden(spark):
    data = [("a", "2023-01", 100.0), ("a", "2023-02", 110.0), ("a", "2024-01", 150.0), ("a", "2024-02", 165.0)]
    out = monthly_growth(spark.createDataFrame(data, SCHEMA), ["s"])
    assert rows(out, "date", "export_mom", "export_yoy") == [
        ("2023-01", None, None),
        ("2023-02", 10.0, None),
        ("2024-01", 36.36, 50.0),
        ("2024-02", 10.0, 50.0),
    ]


def test_series_isolated(spark):
    data = [("a", "2023-01", 100.0), ("b", "2023-02", 300.0), ("a", "2023-02", 200.0), ("b", "2024-02", 600.0)]
    out = monthly_growth(spark.createDataFrame(data, SCHEMA).repartition(3), ["s"])
    assert rows(out, "s", "date", "export_mom", "export_yoy") == [
        ("a", "2023-01", None, None),
        ("a", "2023-02", 100.0, None),
        ("b", "2023-02", None, None),
        ("b", "2024-02", 100.0, 100.0),
    ]


def test_zero_base_monthly_is_null(spark):
    data = [("a", "2023-01", 0.0), ("a", "2023-02", 10.0), ("a", "2024-01", 5.0)]
    out = monthly_growth(spark.createDataFrame(data, SCHEMA), ["s"])
    assert rows(out, "date", "export_mom", "export_yoy") == [("2023-01", None, None), ("2023-02", None, None), ("2024-01", -50.0, None)]


def test_aggregate_sum_and_sort(spark):
    df = spark.createDataFrame([("2024-01", 100.0), ("2024-01", 50.0), ("2024-02", 200.0), ("2024-03", None)], "date string, export_amount double")
    out = aggregate_by_date(df)
    assert rows(out) == [("2024-01", 150.0), ("2024-02", 200.0), ("2024-03", 0.0)]
    assert [r.date for r in sort_by_date(out).collect()] == ["2024-01", "2024-02", "2024-03"]


def test_aggregate_missing_column(spark):
    import pytest

    df = spark.createDataFrame([("2024-01",)], "date string")
    with pytest.raises(ValueError, match="must have"):
        aggregate_by_date(df)


def test_quarterly_golden(spark):
    m = [(f"2023-{i:02d}", 100.0) for i in (1, 2, 3)] + [(f"2023-{i:02d}", 200.0) for i in (4, 5, 6)]
    m += [(f"2024-{i:02d}", 150.0) for i in (1, 2, 3)]
    out = process_quarterly(spark.createDataFrame(m, "date string, export_amount double"))
    assert rows(out) == [("2023Q1", 300.0, None, None), ("2023Q2", 600.0, 100.0, None), ("2024Q1", 450.0, -25.0, 50.0)]


def test_quarterly_zero_base_ieee(spark):
    import math

    m = [("2023-01", 0.0), ("2023-04", 5.0), ("2024-01", 0.0), ("2024-04", 0.0)]
    out = {r.quarter: r for r in process_quarterly(spark.createDataFrame(m, "date string, export_amount double")).collect()}
    assert out["2023Q2"].export_qoq == math.inf
    assert out["2024Q1"].export_qoq == -100.0 and math.isnan(out["2024Q1"].export_yoy)
    assert math.isnan(out["2024Q2"].export_qoq) and out["2024Q2"].export_yoy == -100.0


def test_year_filters_after_rates(spark):
    data = [("a", "2023-01", 100.0), ("a", "2024-01", 150.0), ("a", "2025-01", 300.0)]
    g = monthly_growth(spark.createDataFrame(data, SCHEMA), ["s"])
    assert rows(filter_by_year(g, 2024, 2024), "date", "export_yoy") == [("2024-01", 50.0)]
    q = process_quarterly(spark.createDataFrame(data, SCHEMA), ["s"])
    assert rows(filter_quarterly_by_year(q, 2024, 2025), "quarter") == [("2024Q1",), ("2025Q1",)]


def test_latest_per_group(spark):
    df = spark.createDataFrame([("a", "f1", 10), ("a", "f2", 30), ("b", "f3", 5)], "g string, path string, t long")
    assert rows(latest_per_group(df, ["g"], "path", "t"), "g", "latest_path") == [("a", "f2"), ("b", "f3")]


def test_quarterly_dates_unique_path_matches(spark):
    data = [("a", f"{y}-{m:02d}", float(y * m % 97)) for y in (2022, 2023, 2024) for m in range(1, 13) if (y + m) % 4]
    data += [("b", "2023-02", None), ("b", "2023-05", float("nan")), ("b", "2024-05", 3.0)]
    df = spark.createDataFrame(data, SCHEMA)
    fast, full = rows(process_quarterly(df, ["s"], dates_unique=True)), rows(process_quarterly(df, ["s"]))
    assert list(map(repr, fast)) == list(map(repr, full))  # repr: NaN-aware
