"""Business-day calendar.

Business days of a month = weekdays (Mon-Fri) minus holidays that fall on a
weekday.  Weekdays are counted per row in closed form (JVM side, no table).  Holidays are a
user-supplied table ``(d DATE, name STRING)``; it is reduced to one count
per month and joined by month key; how is left to the planner.  The built-in
fixed-date holidays need no table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.functions.periods import YM_KEY, business_date_ok, year_month_key

# Fixed-date public holidays (month, day, name) used by the default holiday
# table.  Fixed values of the Korean calendar; holidays that move with the
# lunar calendar are not modelled (supply them as rows of your own table).
FIXED_DATE_HOLIDAYS = [
    (1, 1, "신정"),
    (3, 1, "삼일절"),
    (5, 5, "어린이날"),
    (6, 6, "현충일"),
    (8, 15, "광복절"),
    (10, 3, "개천절"),
    (10, 9, "한글날"),
    (12, 25, "기독탄신일"),
]

#: Names the fixed-date holidays where a holiday table may be given.
FIXED = "fixed"
HOLIDAY_SCHEMA = "d DATE, name STRING"


def fixed_date_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Holiday table for ``FIXED_DATE_HOLIDAYS`` in [first_year, last_year]; built by rule."""
    entries = F.array(
        *[
            F.struct(F.lit(m).alias("m"), F.lit(d).alias("dd"), F.lit(n).alias("name"))
            for m, d, n in FIXED_DATE_HOLIDAYS
        ]
    )
    return (
        spark.range(int(first_year), int(last_year) + 1)
        .select(F.col("id").cast("int").alias("y"), F.explode(entries).alias("h"))
        .select(F.make_date("y", "h.m", "h.dd").alias("d"), F.col("h.name").alias("name"))
    )


def empty_holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HOLIDAY_SCHEMA)


def weekdays_in_month(first: Column) -> Column:
    """Mon-Fri count of the month starting on the DATE ``first``.

    Closed form, no per-day array: 5 per full week, plus the weekdays among
    the remaining ``days % 7`` days, which start on the month's first weekday
    (Mon=0).  Six code-generated terms per row; pass a column reference
    (not an expression) so nothing is recomputed per term."""
    days = F.dayofmonth(F.last_day(first))
    w0 = F.weekday(first)
    rest = days % 7
    extra = sum(
        F.when((F.lit(k) < rest) & (((w0 + F.lit(k)) % 7) < 5), F.lit(1)).otherwise(F.lit(0)) for k in range(6)
    )
    return (F.floor(days / 7) * 5 + extra).cast("int")


def fixed_holidays_on_weekdays(year: Column, month: Column) -> Column:
    """How many of ``FIXED_DATE_HOLIDAYS`` fall on Mon-Fri in a month: closed
    form per row, so it holds for every year without a table."""
    total = F.lit(0)
    for m, d, _ in FIXED_DATE_HOLIDAYS:
        hit = (month == m) & (F.weekday(F.make_date(year, F.lit(m), F.lit(d))) < 5)
        total = total + F.when(hit, 1).otherwise(0)
    return total


def holiday_counts(holidays: DataFrame) -> DataFrame:
    """One row per month ``(_hym, _hdays)``: distinct holidays on a weekday."""
    d = F.col("d")
    return (
        holidays.where(d.isNotNull() & (F.weekday(d) < 5))
        .select((F.year(d) * 100 + F.month(d)).alias("_hym"), d)
        .distinct()
        .groupBy("_hym")
        .agg(F.count(F.lit(1)).alias("_hdays"))
    )


def with_business_days(
    df: DataFrame,
    date: str = "date",
    holidays: DataFrame | str | None = FIXED,
    out: str = "business_days",
) -> DataFrame:
    """A4 + J5: add ``business_days`` (INT).  0 when ``date`` is not exactly a
    seven-character year-month (``2024-1`` -> 0, ``2024-13`` -> 0).

    ``holidays``: ``FIXED`` (the fixed-date holidays, any year), a table
    ``(d, name)``, or None for weekdays only."""
    dcol = F.col(date)
    ym = F.col(YM_KEY) if YM_KEY in df.columns else year_month_key(dcol)
    # Parse once: the month key of valid business dates, then its first day.
    staged = df.withColumn("_hym", F.when(business_date_ok(dcol), ym)).withColumn(
        "_first", F.make_date(F.floor(F.col("_hym") / 100).cast("int"), (F.col("_hym") % 100).cast("int"), F.lit(1))
    )
    weekdays = F.coalesce(weekdays_in_month(F.col("_first")), F.lit(0))
    if isinstance(holidays, str):
        if holidays != FIXED:
            raise ValueError(f"holidays must be {FIXED!r}, a table or None")
        year, month = F.floor(F.col("_hym") / 100).cast("int"), F.col("_hym") % 100
        weekdays = weekdays - F.coalesce(fixed_holidays_on_weekdays(year, month), F.lit(0))
    elif holidays is not None:
        staged = staged.join(holiday_counts(holidays), on="_hym", how="left")
        weekdays = weekdays - F.coalesce(F.col("_hdays"), F.lit(0))
    return staged.withColumn(out, weekdays.cast("int")).drop("_hym", "_first", "_hdays")


def business_days_table(months: DataFrame, date: str = "date", holidays: DataFrame | str | None = FIXED) -> DataFrame:
    """Distinct months of ``months[date]`` with their business days."""
    return with_business_days(months.select(date).distinct(), date, holidays)
