import math

from tradelens.operators.calendar import fixed_date_holidays, with_business_days
from tradelens.operators.dashboard import DASHBOARD_LABELS, dashboard_labels, enrich_data

from conftest import rows

SCHEMA = "s string, date string, export_amount double"


def test_business_days_weekdays_and_holidays(spark):
    df = spark.createDataFrame([("2024-01",), ("2024/03",), ("2024-1",), ("2024-13",), ("2024-02",)], "date string")
    plain = dict(rows(with_business_days(df, holidays=None)))
    assert plain == {"2024-01": 23, "2024/03": 21, "2024-1": 0, "2024-13": 0, "2024-02": 21}
    hol = fixed_date_holidays(spark, 2024, 2024)
    # 2024-01-01 (Mon) and 2024-03-01 (Fri) are fixed-date holidays on weekdays.
    with_hol = dict(rows(with_business_days(df, holidays=hol)))
    assert with_hol["2024-01"] == 22 and with_hol["2024/03"] == 20 and with_hol["2024-02"] == 21
    assert dict(rows(with_business_days(df))) == with_hol  # the default: the same days in closed form


def test_fixed_holidays_hold_in_any_year(spark):
    months = [f"{y}-{m:02d}" for y in (1985, 2024, 2031, 2077) for m in range(1, 13)]
    df = spark.createDataFrame([(m,) for m in months], "date string")
    table = fixed_date_holidays(spark, 1980, 2080)
    got = rows(with_business_days(df))
    assert got == rows(with_business_days(df, holidays=table)) and dict(got)["2031-01"] == 22


def test_daily_average_half_even_and_zero_days(spark):
    # 2024-02 has 21 weekdays: 52.5 -> 52 (half-even), 73.5 -> 74
    df = spark.createDataFrame([("a", "2024-02", 52.5 * 21), ("b", "2024-02", 73.5 * 21), ("c", "2024-1", 100.0)], SCHEMA)
    out = enrich_data(df, ["s"])
    assert rows(out, "s", "business_days", "daily_avg") == [("a", 21, 52), ("b", 21, 74), ("c", 0, 0)]


def test_quarter_stats_placement_and_partial_quarter(spark):
    # 2023Q1 complete, 2023Q2 ends at May (partial: no stats), 2023Q3 only September.
    data = [("a", d, 2100.0) for d in ("2023-01", "2023-02", "2023-03", "2023-04", "2023-05", "2023-09")]
    out = {r.date: r for r in enrich_data(spark.createDataFrame(data, SCHEMA), ["s"]).collect()}
    assert out["2023-01"].quarter_b is None and out["2023-02"].quarter_c is None
    q1 = out["2023-03"]
    assert q1.quarter_b == out["2023-01"].daily_avg + out["2023-02"].daily_avg + out["2023-03"].daily_avg
    assert q1.quarter_c == float(round(q1.quarter_b / 3)) and q1.quarter_d is None
    assert out["2023-05"].quarter_b is None  # latest month of Q2 is May
    q3 = out["2023-09"]
    assert q3.quarter_b == out["2023-09"].daily_avg and q3.quarter_c == float(round(q3.quarter_b / 3))
    # QoQ of Q3 compares with Q2 (observed, even though Q2 shows nothing)
    q2_c = round((out["2023-04"].daily_avg + out["2023-05"].daily_avg) / 3)
    assert q3.quarter_d == float(round((q3.quarter_c / q2_c - 1) * 100))


def test_quarter_e_is_four_observed_quarters(spark):
    # Quarters 2022Q1, 2022Q3, 2022Q4, 2023Q1, 2023Q2 (2022Q2 missing):
    # quarter_e of 2023Q2 compares with 2022Q1 (four observed back), while the
    # calendar rule would look for 2022Q2.
    months = ["2022-03", "2022-09", "2022-12", "2023-03", "2023-06"]
    amounts = [2200.0, 4400.0, 6600.0, 8800.0, 11000.0]
    data = [("a", d, a) for d, a in zip(months, amounts)]
    out = {r.date: r for r in enrich_data(spark.createDataFrame(data, SCHEMA), ["s"]).collect()}
    first, last = out["2022-03"], out["2023-06"]
    assert last.quarter_e == float(round((last.quarter_c / first.quarter_c - 1) * 100))
    assert out["2023-03"].quarter_e is None


def test_daily_rates(spark):
    data = [("a", "2023-01", 2200.0), ("a", "2023-02", 0.0), ("a", "2023-03", 2300.0), ("a", "2024-01", 4600.0)]
    out = {r.date: r for r in enrich_data(spark.createDataFrame(data, SCHEMA), ["s"], holidays=None).collect()}
    assert out["2023-01"].daily_avg == 100 and out["2023-02"].daily_avg == 0
    assert out["2023-02"].daily_avg_mom == -100.0
    assert out["2023-03"].daily_avg_mom == math.inf  # float division by a zero base
    assert out["2024-01"].daily_avg_yoy == 100.0  # 200 vs 100 one calendar year back
    assert out["2023-03"].daily_avg_yoy is None


def test_labels(spark):
    df = spark.createDataFrame([("2024-01", 1.0, "x")], "date string, export_amount double, extra string")
    assert dashboard_labels(df).columns == [DASHBOARD_LABELS["date"], DASHBOARD_LABELS["export_amount"], "extra"]
