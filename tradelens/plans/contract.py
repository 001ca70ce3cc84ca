"""Contract queries: every operator bound to the given tables, each paired
with an independent DuckDB SQL statement computing the same result.

The Spark side only calls library operators; the SQL side states the
semantics directly (GROUP BY, lag, self-joins on shifted keys, round_even).
Both sides keep money exact (DECIMAL sums) and alias every column the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.functions.coercion import coerce_amount
from tradelens.functions.periods import normalize_date, with_period_keys
from tradelens.operators.aggregate import aggregate_by_date, count_records, latest_per_group, sort_by_date
from tradelens.operators.calendar import business_days_table
from tradelens.operators.dashboard import (
    dashboard_labels,
    enrich_data,
    with_daily_average,
    with_daily_rates,
    with_quarter_stats,
)
from tradelens.operators.growth import (
    filter_by_year,
    filter_quarterly_by_year,
    monthly_growth,
    process_quarterly,
    with_mom,
    with_yoy,
)
from tradelens.operators.pages import grid_rows, list_links, option_dimension
from tradelens.operators.parse import parse_period_rows, process_trade_data
from tradelens.operators.select import strategy_totals
from tradelens.operators.validate import (
    ANALYSIS_RESULT_RULES,
    TRADE_RECORD_RULES,
    from_json_rows,
    process_trade_data_safe,
    safe_aggregate_by_date,
    split_valid,
    to_json_rows,
)
from tradelens.plans.verbs import dashboard_table, report_tables
from tradelens.plans import captured
from tradelens.sources import tables as T
from tradelens.sources.strategies import validate_items

# Year range of the report/dashboard views (inclusive).
YEAR_FROM, YEAR_TO = 1997, 1999

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- Spark side


def dense_monthly(spark, d):
    """Monthly sums per order priority (5 dense series)."""
    return aggregate_by_date(T.orders_facts(spark, d, "o_orderpriority"), ["series"])


def sparse_monthly(spark, d):
    """Monthly sums per customer (every customer; natural gaps)."""
    return aggregate_by_date(T.orders_facts(spark, d, "o_custkey"), ["series"])


def q_aggregate_by_date(spark, d):
    return dense_monthly(spark, d)


def q_monthly_mom(spark, d):
    return with_mom(dense_monthly(spark, d), ["series"])


def q_monthly_yoy(spark, d):
    return with_yoy(dense_monthly(spark, d), ["series"])


def q_monthly_growth(spark, d):
    return monthly_growth(dense_monthly(spark, d), ["series"])


def q_monthly_growth_gaps(spark, d):
    return monthly_growth(sparse_monthly(spark, d), ["series"])


def q_monthly_growth_zero_base(spark, d):
    o = T.load(spark, d, "orders")
    facts = o.select(
        F.col("o_custkey").cast("string").alias("series"),
        T.year_month("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("decimal(18,2)"))
        .otherwise(T.money("o_totalprice"))
        .alias("export_amount"),
    )
    return monthly_growth(aggregate_by_date(facts, ["series"]), ["series"])


def q_filter_by_year(spark, d):
    return filter_by_year(q_monthly_growth(spark, d), YEAR_FROM, YEAR_TO)


def q_record_counts(spark, d):
    return count_records(q_filter_by_year(spark, d), ["series"])


def q_quarterly_growth(spark, d):
    # Quarter sums straight from the facts: the same totals as summing the
    # monthly rows, with one aggregation and exact DECIMAL money.
    return process_quarterly(T.orders_facts(spark, d, "o_orderpriority"), ["series"])


def q_quarterly_growth_gaps(spark, d):
    return process_quarterly(T.orders_facts(spark, d, "o_custkey"), ["series"])


def q_quarterly_filter_by_year(spark, d):
    return filter_quarterly_by_year(q_quarterly_growth(spark, d), YEAR_FROM, YEAR_TO)


def q_business_days(spark, d):
    months = T.orders_facts(spark, d).select("date")
    return business_days_table(months, "date")


def q_daily_average(spark, d):
    return with_daily_average(dense_monthly(spark, d), ["series"])


def _sparse_daily(spark, d):
    return with_daily_average(sparse_monthly(spark, d), ["series"])


def q_daily_avg_mom(spark, d):
    return with_daily_rates(_sparse_daily(spark, d), ["series"]).select(
        "series", "date", "daily_avg", "daily_avg_mom"
    )


def q_daily_avg_yoy(spark, d):
    return with_daily_rates(_sparse_daily(spark, d), ["series"]).select(
        "series", "date", "daily_avg", "daily_avg_yoy"
    )


def q_quarter_stats(spark, d):
    return with_quarter_stats(_sparse_daily(spark, d), ["series"]).select(
        "series", "date", "daily_avg", "quarter_b", "quarter_c", "quarter_d", "quarter_e"
    )


def _dashboard(monthly, keys):
    """Growth + enrichment sharing one set of period keys (one sort)."""
    keyed, added = with_period_keys(monthly)
    return enrich_data(monthly_growth(keyed, keys), keys).drop(*added)


def q_dashboard_enriched(spark, d):
    return _dashboard(dense_monthly(spark, d), ["series"])


def q_dashboard_labels(spark, d):
    return dashboard_labels(filter_by_year(q_dashboard_enriched(spark, d), YEAR_FROM, YEAR_TO))


def q_parse_period_rows(spark, d):
    return parse_period_rows(T.raw_report(spark, d), ["series"])


def q_process_raw_report(spark, d):
    return process_trade_data(T.raw_report(spark, d), ["series"])


def _returns_report(spark, d):
    """Per-customer report where large pending orders are returns (negative)."""
    return T.raw_report(spark, d, series="o_custkey", returns_over=400_000)


def q_safe_report_valid(spark, d):
    return process_trade_data_safe(_returns_report(spark, d), ["series"]).valid


def q_safe_report_rejects(spark, d):
    return process_trade_data_safe(_returns_report(spark, d), ["series"]).rejects


def q_safe_series_status(spark, d):
    """How each series of the safe pipeline ended, with its months."""
    out = process_trade_data_safe(_returns_report(spark, d), ["series"])
    count = F.count(F.lit(1)).alias("months")
    good = out.valid.groupBy("series").agg(count).withColumn("status", F.lit("valid"))
    return good.union(out.rejects.groupBy("series").agg(count).withColumn("status", F.lit("rejected")))


def q_bad_month_rejects(spark, d):
    """Reports with a 13th month (December's pending orders booked there):
    the bad row and every month of its series are rejected."""
    raw = T.raw_report(spark, d, series="o_custkey")
    december = F.col("period_raw").rlike("^ 12")
    raw = raw.withColumn("period_raw", F.when(december, F.lit("13월")).otherwise(F.col("period_raw")))
    return process_trade_data_safe(raw, ["series"]).rejects


def q_report_tables_monthly(spark, d):
    """C8 data part: the report verb's monthly table."""
    return report_tables(q_monthly_growth(spark, d), ["series"], YEAR_FROM, YEAR_TO).monthly


def q_report_tables_quarterly(spark, d):
    """C8 data part: the report verb's quarterly table."""
    return report_tables(q_monthly_growth(spark, d), ["series"], YEAR_FROM, YEAR_TO).quarterly


def q_dashboard_verb(spark, d):
    """C9 data part: the dashboard verb's table over a processed raw report."""
    monthly = process_trade_data(T.raw_report(spark, d), ["series"])
    return dashboard_table(monthly, ["series"], YEAR_FROM, YEAR_TO)


def q_safe_aggregate(spark, d):
    return safe_aggregate_by_date(T.orders_facts(spark, d), ["series"]).valid


def q_sorted_by_date(spark, d):
    return sort_by_date(dense_monthly(spark, d), ["series"])


def q_custom_columns(spark, d):
    """Other column names for series, date and value."""
    facts = T.orders_facts(spark, d, "o_orderpriority").toDF("grp", "ym", "amt")
    return monthly_growth(aggregate_by_date(facts, ["grp"], "ym", "amt"), ["grp"], "ym", "amt")


def q_separators(spark, d):
    """``YYYY/MM`` dates of pending orders meet ``YYYY-MM`` ones."""
    o = T.load(spark, d, "orders")
    slash = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM"))
    date = normalize_date(F.coalesce(slash, F.date_format("o_orderdate", "yyyy-MM")))
    facts = o.select(F.col("o_orderpriority").alias("series"), date.alias("date"), T.money("o_totalprice").alias("export_amount"))
    return aggregate_by_date(facts, ["series"])


def q_quarterly_zero_base(spark, d):
    """C4 on a zero base: IEEE rates, infinities and NaN as text."""
    o = T.load(spark, d, "orders")
    kept = F.when(F.col("o_orderstatus") == "P", T.money("o_totalprice")).otherwise(F.lit(0).cast("decimal(18,2)"))
    facts = o.select(F.col("o_custkey").cast("string").alias("series"), T.year_month("o_orderdate").alias("date"), kept.alias("export_amount"))
    q = process_quarterly(facts, ["series"])

    def text(c):
        v = F.col(c)
        odd = F.when(F.isnan(v), "nan").when(v == float("inf"), "inf").when(v == float("-inf"), "-inf")
        return F.when(v.isNotNull(), F.coalesce(odd, F.round(v * 100).cast("decimal(38,0)").cast("string"))).alias(c)

    return q.select("series", "quarter", "export_amount", text("export_qoq"), text("export_yoy"))


def q_analysis_rejects(spark, d):
    """V4: growth rows, of which those of 1998 carry a slash date."""
    g = q_monthly_growth(spark, d)
    date = F.when(F.col("date").startswith("1998"), F.replace(F.col("date"), F.lit("-"), F.lit("/"))).otherwise(F.col("date"))
    return split_valid(g.withColumn("date", date), ANALYSIS_RESULT_RULES).rejects


def amount_texts(spark, d) -> DataFrame:
    """Amount texts in five shapes, chosen by order priority."""
    o = T.load(spark, d, "orders")
    dec = T.money("o_totalprice").cast("string")
    whole = F.floor("o_totalprice").cast("string")
    p = F.col("o_orderpriority")
    text = (
        F.when(p == "1-URGENT", dec)
        .when(p == "2-HIGH", F.concat(F.lit("  "), dec, F.lit(" ")))
        .when(p == "3-MEDIUM", F.concat(dec, F.lit("e0")))
        .when(p == "4-NOT SPECIFIED", F.format_number("o_totalprice", 2))
        .otherwise(F.regexp_replace(whole, r"([0-9])([0-9]{3})$", "$1_$2"))
    )
    return o.select("o_orderkey", "o_orderpriority", text.alias("amount_text"))


def q_amount_coercion(spark, d):
    t = amount_texts(spark, d)
    return t.select("o_orderkey", "o_orderpriority", coerce_amount("amount_text").alias("amount"))


def _records(spark, d):
    o = T.load(spark, d, "orders")
    date = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    amount = (T.money("o_totalprice") - F.lit(50000)).cast("double")
    return o.select("o_orderkey", date.alias("date"), amount.alias("export_amount"))


def q_valid_records(spark, d):
    return split_valid(_records(spark, d), TRADE_RECORD_RULES).valid


def q_rejected_records(spark, d):
    return split_valid(_records(spark, d), TRADE_RECORD_RULES).rejects


def q_strategy_items(spark, d):
    valid = validate_items(T.part_strategy_items(spark, d)).valid
    return valid.select("strategy", "item", "hs_code", F.size("filters").alias("n_filters"))


def q_strategy_rejects(spark, d):
    return validate_items(T.part_strategy_items(spark, d)).rejects


def strategy_monthly(spark, d):
    return strategy_totals(T.line_facts(spark, d), validate_items(T.part_strategy_items(spark, d)).valid)


def q_strategy_select(spark, d):
    return strategy_monthly(spark, d)


def q_strategy_monthly_growth(spark, d):
    return monthly_growth(strategy_monthly(spark, d), ["strategy", "item"])


def q_strategy_dashboard(spark, d):
    """C10 dashboard part: every strategy item enriched, then the year range."""
    keys = ["strategy", "item"]
    return filter_by_year(_dashboard(strategy_monthly(spark, d), keys), YEAR_FROM, YEAR_TO)


def q_strategy_quarterly_growth(spark, d):
    return process_quarterly(strategy_monthly(spark, d), ["strategy", "item"], dates_unique=True)


def q_strategy_long_lists(spark, d):
    """Items whose filters list half of all suppliers' names."""
    return strategy_totals(T.line_facts(spark, d), T.long_list_items(spark, d), long_lists=True)


def q_strategy_contains(spark, d):
    """Filters by a part of the office's name."""
    items = T.long_list_items(spark, d, prefix=True)
    return strategy_totals(T.line_facts(spark, d), items, match="contains", long_lists=True)


def q_latest_per_series(spark, d):
    o = T.load(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("series"),
        F.col("o_totalprice").alias("amount"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias(
            "order_stamp"
        ),
    )
    return latest_per_group(o, ["series"], "amount", "order_stamp", name="latest_amount")


def q_result_json(spark, d):
    g = q_monthly_growth(spark, d)
    return from_json_rows(to_json_rows(g), g.schema)


def q_grid_rows(spark, d):
    return grid_rows(captured.grid_pages(spark, d))


def q_page_links(spark, d):
    return list_links(T.load(spark, d, "pages"))


def q_option_dimension(spark, d):
    return option_dimension(captured.option_pages(spark, d))


QUERIES: dict[str, Query] = {
    "aggregate_by_date": q_aggregate_by_date,
    "monthly_mom": q_monthly_mom,
    "monthly_yoy": q_monthly_yoy,
    "monthly_growth": q_monthly_growth,
    "monthly_growth_gaps": q_monthly_growth_gaps,
    "monthly_growth_zero_base": q_monthly_growth_zero_base,
    "filter_by_year": q_filter_by_year,
    "record_counts": q_record_counts,
    "quarterly_growth": q_quarterly_growth,
    "quarterly_growth_gaps": q_quarterly_growth_gaps,
    "quarterly_filter_by_year": q_quarterly_filter_by_year,
    "business_days": q_business_days,
    "daily_average": q_daily_average,
    "daily_avg_mom": q_daily_avg_mom,
    "daily_avg_yoy": q_daily_avg_yoy,
    "quarter_stats": q_quarter_stats,
    "dashboard_enriched": q_dashboard_enriched,
    "dashboard_labels": q_dashboard_labels,
    "parse_period_rows": q_parse_period_rows,
    "process_raw_report": q_process_raw_report,
    "safe_report_valid": q_safe_report_valid,
    "safe_report_rejects": q_safe_report_rejects,
    "safe_series_status": q_safe_series_status,
    "bad_month_rejects": q_bad_month_rejects,
    "report_tables_monthly": q_report_tables_monthly,
    "report_tables_quarterly": q_report_tables_quarterly,
    "dashboard_verb": q_dashboard_verb,
    "safe_aggregate": q_safe_aggregate,
    "sorted_by_date": q_sorted_by_date,
    "custom_columns": q_custom_columns,
    "separators": q_separators,
    "quarterly_zero_base": q_quarterly_zero_base,
    "analysis_rejects": q_analysis_rejects,
    "page_links": q_page_links,
    "amount_coercion": q_amount_coercion,
    "valid_records": q_valid_records,
    "rejected_records": q_rejected_records,
    "strategy_items": q_strategy_items,
    "strategy_rejects": q_strategy_rejects,
    "strategy_select": q_strategy_select,
    "strategy_monthly_growth": q_strategy_monthly_growth,
    "strategy_quarterly_growth": q_strategy_quarterly_growth,
    "strategy_dashboard": q_strategy_dashboard,
    "strategy_long_lists": q_strategy_long_lists,
    "strategy_contains": q_strategy_contains,
    "latest_per_series": q_latest_per_series,
    "result_json": q_result_json,
    "grid_rows": q_grid_rows,
    "option_dimension": q_option_dimension,
}
