"""Dashboard enrichment (C5-C7): business days, daily averages and their
rates, quarter statistics on the last month of each quarter; display labels (P3).

The whole enrichment is window-only over ``partitionBy(series).orderBy(_ym)``
— the same spec as the monthly growth windows — so after the monthly
aggregation there is one exchange (by series), one sort, and no join, except
with a holiday table given by the user (joined by month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.periods import QK_KEY, YM_KEY, month_of, with_period_keys
from tradelens.functions.rates import daily_average, pct_change, quarter_average
from tradelens.operators._common import Series, as_list, require_columns
from tradelens.operators.calendar import FIXED, with_business_days
from tradelens.operators.growth import series_window

ENRICHED_COLUMNS = [
    "date",
    "export_amount",
    "export_mom",
    "export_yoy",
    "business_days",
    "daily_avg",
    "daily_avg_mom",
    "daily_avg_yoy",
    "quarter_b",
    "quarter_c",
    "quarter_d",
    "quarter_e",
]

# Display labels of the dashboard table; fixed values that must equal the
# reference's column labels, in the reference's column order.
DASHBOARD_LABELS = {
    "date": "날짜",
    "export_amount": "수출액(달러)",
    "export_mom": "MoM(%)",
    "export_yoy": "YoY(%)",
    "business_days": "영업일",
    "daily_avg": "일평균(달러)",
    "daily_avg_mom": "일평균 MoM(%)",
    "daily_avg_yoy": "일평균 YoY(%)",
    "quarter_b": "분기합계(B)",
    "quarter_c": "분기평균(C)",
    "quarter_d": "QoQ(%)",
    "quarter_e": "분기 YoY(%)",
}


def with_daily_average(
    df: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
    holidays: DataFrame | str | None = FIXED,
) -> DataFrame:
    """``business_days`` (INT) and ``daily_avg`` = round(amount / days) as LONG."""
    require_columns(df, [date, value, *as_list(series)])
    out = with_business_days(df, date, holidays)
    return out.withColumn("daily_avg", daily_average(F.col(value), F.col("business_days")))


def with_daily_rates(df: DataFrame, series: Series | None = None, date: str = "date") -> DataFrame:
    """W7 + W8: ``daily_avg_mom`` (previous observed month) and ``daily_avg_yoy``
    (same month a calendar year back), 0 dp, float division on a zero base."""
    series = as_list(series)
    require_columns(df, [date, "daily_avg", *series])
    df, added = with_period_keys(df, date)
    w = series_window(series, YM_KEY)
    da = F.col("daily_avg")
    return (
        df.withColumns(
            {
                "_dpm": F.lag(da, 1).over(w),
                "_dpy": F.when(F.col(YM_KEY).isNotNull(), F.last(da).over(w.rangeBetween(-100, -100))),
            }
        )
        .withColumns(
            {
                "daily_avg_mom": pct_change("daily_avg", "_dpm", digits=0, zero_base="ieee", form="ratio"),
                "daily_avg_yoy": pct_change("daily_avg", "_dpy", digits=0, zero_base="ieee", form="diff"),
            }
        )
        .drop("_dpm", "_dpy", *added)
    )


def with_quarter_stats(df: DataFrame, series: Series | None = None, date: str = "date") -> DataFrame:
    """C6 (A5, F13, W9-W11, J4) as three window passes over one sort.

    Per observed quarter: ``quarter_b`` = sum of the rounded daily averages,
    ``quarter_c`` = round(b / 3), ``quarter_d`` = change of c vs the previous
    *observed* quarter, ``quarter_e`` = change of c vs four *observed*
    quarters back.  The values are placed on the latest observed month of the
    quarter and only when that month is 3, 6, 9 or 12; other rows get NULL.

    All windows use ``(series | _ym)``: the quarter sum is a difference of
    running sums at quarter ends, the previous quarters are reached with
    ``lag(..) IGNORE NULLS`` over the quarter-end rows.  No join, no second
    sort, no partition larger than one series' months.
    """
    series = as_list(series)
    require_columns(df, [date, "daily_avg", *series])
    df, added = with_period_keys(df, date)
    w = series_window(series, YM_KEY)
    qk = F.col(QK_KEY)
    in_q = qk.isNotNull()
    nxt = F.col("_next_qk")
    last = in_q & (nxt.isNull() | (nxt != qk))
    staged = (
        df.withColumns(
            {
                "_cum": F.sum(F.when(in_q, F.col("daily_avg")).otherwise(F.lit(0))).over(
                    w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                ),
                "_next_qk": F.lead(qk, 1).over(w),
            }
        )
        .withColumns({"_last": last, "_cum_last": F.when(last, F.col("_cum"))})
        .withColumn("_prev_cum", F.expr("lag(_cum_last, 1) IGNORE NULLS").over(w))
        .withColumn("_qb", F.when(F.col("_last"), F.col("_cum") - F.coalesce(F.col("_prev_cum"), F.lit(0))))
        .withColumn("_qc", quarter_average("_qb"))
        .withColumns(
            {
                "_qc1": F.expr("lag(_qc, 1) IGNORE NULLS").over(w),
                "_qc4": F.expr("lag(_qc, 4) IGNORE NULLS").over(w),
            }
        )
    )
    show = F.col("_last") & (month_of(F.col(date)) % 3 == 0)
    return staged.withColumns(
        {
            "quarter_b": F.when(show, F.col("_qb")).cast("long"),
            "quarter_c": F.when(show, F.col("_qc")),
            "quarter_d": F.when(show, pct_change("_qc", "_qc1", 0, "ieee", "ratio")),
            "quarter_e": F.when(show, pct_change("_qc", "_qc4", 0, "ieee", "ratio")),
        }
    ).drop("_cum", "_next_qk", "_last", "_cum_last", "_prev_cum", "_qb", "_qc", "_qc1", "_qc4", *added)


def enrich_data(
    monthly: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
    holidays: DataFrame | str | None = FIXED,
) -> DataFrame:
    """Monthly rows -> dashboard rows (``ENRICHED_COLUMNS`` after the series keys).

    ``export_mom`` / ``export_yoy`` are carried through when present.
    """
    series = as_list(series)
    out, added = with_period_keys(monthly, date)
    out = with_daily_average(out, series, date, value, holidays)
    out = with_daily_rates(out, series, date)
    out = with_quarter_stats(out, series, date).drop(*added)
    keep = [c for c in ENRICHED_COLUMNS if c in out.columns]
    extra = [c for c in out.columns if c not in keep and c not in series]
    return out.select(*series, *keep, *extra)


def dashboard_labels(df: DataFrame, labels: dict | None = None) -> DataFrame:
    """Rename known columns to display labels; unknown columns are kept."""
    mapping = {k: v for k, v in (labels or DASHBOARD_LABELS).items() if k in df.columns}
    return df.withColumnsRenamed(mapping)
