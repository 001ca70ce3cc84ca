import pytest

from tradelens.operators.validate import (
    BUSINESS_METRICS_RULES,
    TRADE_RECORD_RULES,
    enforce_rules,
    from_json_rows,
    safe_aggregate_by_date,
    split_valid,
    to_json_rows,
)

from conftest import rows


def test_split_valid_and_reasons(spark):
    df = spark.createDataFrame(
        [("2024-01", 100.0), ("2024-02", 150.0), ("invalid-date", 1.0), ("2024/01", 1.0), ("24-01", 1.0), ("2024-03", -100.0), ("2024-04", None)],
        "date string, export_amount double",
    )
    out = split_valid(df, TRADE_RECORD_RULES)
    assert rows(out.valid) == [("2024-01", 100.0), ("2024-02", 150.0)]
    reasons = dict(rows(out.rejects, "date", "reason"))
    assert reasons["2024/01"] == "date must match YYYY-MM with a month from 01 to 12"
    assert reasons["2024-03"] == "export_amount must be a finite number >= 0"
    assert reasons["2024-04"] == "export_amount must be a finite number >= 0"
    assert len(reasons) == 5


def test_missing_column_is_plan_time_error(spark):
    df = spark.createDataFrame([("2024-01",)], "date string")
    with pytest.raises(ValueError, match="Missing required columns"):
        split_valid(df, TRADE_RECORD_RULES)
    out = safe_aggregate_by_date(df)
    assert out.rejects.collect()[0].reason.startswith("Missing required columns")


def test_strict_raises(spark):
    df = spark.createDataFrame([("2024-01", -1.0)], "date string, export_amount double")
    with pytest.raises(Exception, match="export_amount must be"):
        enforce_rules(df, TRADE_RECORD_RULES).collect()


def test_business_metrics_rules_and_json_round_trip(spark):
    schema = "date string, export_amount double, business_days int, daily_avg double, daily_avg_mom double, daily_avg_yoy double"
    df = spark.createDataFrame([("2024-01", 20000.0, 20, 1000.0, 5.0, 15.0), ("2024-02", 1.0, -5, 1.0, None, None)], schema)
    out = split_valid(df, BUSINESS_METRICS_RULES)
    assert rows(out.valid, "date") == [("2024-01",)]
    assert rows(out.rejects, "reason") == [("business_days must be >= 0",)]
    back = from_json_rows(to_json_rows(df), df.schema)
    assert rows(back) == rows(df)
    assert '"daily_avg_mom":null' in to_json_rows(df).collect()[1].json


def test_non_finite_amounts_and_13th_months_are_rejected(spark):
    df = spark.createDataFrame([("2024-13", 1.0), ("2024-00", 1.0), ("2024-05", float("inf")), ("2024-12", 2.0)], "date string, export_amount double")
    out = split_valid(df, TRADE_RECORD_RULES)
    assert rows(out.valid, "date") == [("2024-12",)] and out.rejects.count() == 3


def test_outcome_alternatives(spark):
    good = spark.createDataFrame([("2024-01", 1.0)], "date string, export_amount double")
    bad = spark.createDataFrame([("x", 1.0)], "date string, export_amount double")
    default = good.limit(0)
    assert split_valid(good, TRADE_RECORD_RULES).value_or(default).count() == 1
    out = split_valid(good.union(bad), TRADE_RECORD_RULES)
    assert out.failed() and out.value_or(default).count() == 0
    assert rows(out.alt(lambda r: r.select("reason")).rejects)[0][0].startswith("date must match")


def test_safe_pipeline_never_reaches_across_a_bad_month(spark):
    from tradelens.operators.validate import process_trade_data_safe

    raw = [("a", 1, "2024년", "0"), ("a", 2, "1월", "100"), ("a", 3, "2월", "-50"), ("a", 4, "3월", "200")]
    raw += [("b", 1, "2024년", "0"), ("b", 2, "1월", "100"), ("b", 3, "2월", "150")]
    raw += [("c", 1, "2024년", "0"), ("c", 2, "12월", "100"), ("c", 3, "13월", "900")]
    df = spark.createDataFrame(raw, "series string, row_no long, period_raw string, export_amount string")
    out = process_trade_data_safe(df, ["series"])
    assert rows(out.valid, "series", "date", "export_mom") == [("b", "2024-01", None), ("b", "2024-02", 50.0)]
    got = rows(out.rejects, "series", "date", "reason")
    assert len(got) == 5 and sum("another month" in r for _, _, r in got) == 3
    # monthly total = valid + rejects
    assert sum(a for (a,) in rows(out.rejects, "export_amount")) == 1250.0


def test_both_sides_of_a_split_come_from_one_evaluation(spark):
    from pyspark.sql import functions as F

    from tradelens.operators.validate import TRADE_RECORD_RULES, split_valid

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("2024-01", 1.0), ("x", 2.0), ("2024-02", -1.0)], "date string, export_amount double")
    out = split_valid(df.mapInArrow(count, df.schema), TRADE_RECORD_RULES)
    assert (out.valid.count(), out.rejects.count(), out.valid.agg(F.sum("export_amount")).first()[0]) == (1, 2, 1.0)
    assert seen.value == 3
    again = split_valid(df, TRADE_RECORD_RULES, once=False)
    assert sorted(map(tuple, again.rejects.collect())) == sorted(map(tuple, out.rejects.collect()))
    assert again.valid.columns == out.valid.columns == df.columns
