"""Growth-rate windows: monthly MoM/YoY (W2-W4), quarterly QoQ/YoY (C4),
year-range filters (P4/P5).

Every window is ``partitionBy(series)``.  These operators run *after* the
per-period aggregation, so a window partition holds one row per observed
month (or quarter) of one series: tens to hundreds of rows, however many raw
rows fed the series.  Positional rates use ``lag``; calendar rates use a
range frame on an integer period key (no self-join).  All monthly windows
share the spec ``(series | _ym)`` so a chain of them costs one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.periods import YM_KEY, with_period_keys
from tradelens.functions.rates import pct_change
from tradelens.operators._common import Series, as_list, require_columns
from tradelens.operators.aggregate import aggregate_by_quarter

MONTHLY_COLUMNS = ["date", "export_amount", "export_mom", "export_yoy"]
QUARTERLY_COLUMNS = ["quarter", "export_amount", "export_qoq", "export_yoy"]


def series_window(series: list[str], order: str):
    """``partitionBy(series).orderBy(order)``; without series the whole input
    is one series (the reference's one-file case)."""
    if series:
        return Window.partitionBy(*series).orderBy(order)
    return Window.partitionBy(F.lit(0)).orderBy(order)


def _prev_month(value: str, w) -> F.Column:
    return F.lag(F.col(value), 1).over(w)


def _prev_year_month(value: str, w) -> F.Column:
    return F.when(F.col(YM_KEY).isNotNull(), F.last(F.col(value)).over(w.rangeBetween(-100, -100)))


def with_mom(
    df: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
    out: str = "export_mom",
) -> DataFrame:
    """Change vs the previous *observed* month of the series (2 dp, NULL on zero base)."""
    series = as_list(series)
    require_columns(df, [date, value, *series])
    df, added = with_period_keys(df, date)
    w = series_window(series, YM_KEY)
    return (
        df.withColumn("_prev", _prev_month(value, w))
        .withColumn(out, pct_change(value, "_prev", digits=2, zero_base="null"))
        .drop("_prev", *added)
    )


def with_yoy(
    df: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
    out: str = "export_yoy",
) -> DataFrame:
    """Change vs the same month one calendar year back; NULL when that month is absent.

    Expects one row per (series, date) — the output of ``aggregate_by_date``.
    """
    series = as_list(series)
    require_columns(df, [date, value, *series])
    df, added = with_period_keys(df, date)
    w = series_window(series, YM_KEY)
    return (
        df.withColumn("_prev", _prev_year_month(value, w))
        .withColumn(out, pct_change(value, "_prev", digits=2, zero_base="null"))
        .drop("_prev", *added)
    )


def monthly_growth(
    df: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
) -> DataFrame:
    """MoM and YoY in one window pass (one exchange by series, one sort).

    Output: the input columns plus ``export_mom``, ``export_yoy``.
    """
    series = as_list(series)
    require_columns(df, [date, value, *series])
    df, added = with_period_keys(df, date)
    w = series_window(series, YM_KEY)
    return (
        df.withColumns({"_pm": _prev_month(value, w), "_py": _prev_year_month(value, w)})
        .withColumns(
            {
                "export_mom": pct_change(value, "_pm", digits=2, zero_base="null"),
                "export_yoy": pct_change(value, "_py", digits=2, zero_base="null"),
            }
        )
        .drop("_pm", "_py", *added)
    )


def process_quarterly(
    monthly: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
    zero_base: str = "ieee",
    dates_unique: bool = False,
) -> DataFrame:
    """C4: quarterly sums with QoQ (previous observed quarter) and YoY
    (same quarter one calendar year back), 2 dp, float division on a zero base.

    A date without a quarter (a month outside 1..12) fails the job.
    Output: ``*series, quarter, value, export_qoq, export_yoy``.
    """
    series = as_list(series)
    q = aggregate_by_quarter(monthly, series, date, value, dates_unique=dates_unique)
    w = series_window(series, "qk")
    return (
        q.withColumns(
            {
                "_pq": F.lag(F.col(value), 1).over(w),
                "_py": F.last(F.col(value)).over(w.rangeBetween(-10, -10)),
            }
        )
        .select(
            *series,
            "quarter",
            value,
            pct_change(value, "_pq", digits=2, zero_base=zero_base, form="ratio").alias("export_qoq"),
            pct_change(value, "_py", digits=2, zero_base=zero_base, form="diff").alias("export_yoy"),
        )
    )


def _readable_year(column: str) -> F.Column:
    """Year of the text; a text without one fails the job instead of vanishing."""
    year = F.substring(F.col(column), 1, 4).try_cast("int")
    message = F.concat(F.lit("no year in "), F.coalesce(F.col(column), F.lit("NULL")))
    return F.coalesce(year, F.raise_error(message).cast("int"))


def filter_by_year(df: DataFrame, start_year: int, end_year: int, date: str = "date") -> DataFrame:
    """Keep rows whose ``date`` year is in [start, end].  Apply *after* rate windows."""
    require_columns(df, [date])
    return df.where(_readable_year(date).between(int(start_year), int(end_year)))


def filter_quarterly_by_year(
    df: DataFrame, start_year: int, end_year: int, quarter: str = "quarter"
) -> DataFrame:
    """P5: same on the first four characters of ``quarter``."""
    require_columns(df, [quarter])
    return df.where(_readable_year(quarter).between(int(start_year), int(end_year)))
