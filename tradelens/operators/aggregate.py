"""Aggregations: per-period sums (A1-A3), counts (A6), arg-max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tradelens.functions.coercion import coerce_amount
from tradelens.functions.periods import quarter_key, quarter_label
from tradelens.functions.sums import money_sum, order_free_sum
from tradelens.operators._common import Series, as_list, require_columns


def sum_native(df: DataFrame, value: str):
    """Sum in the column's own type (DECIMAL stays exact, DOUBLE does not depend
    on the order of rows); NULL/NaN count as 0."""
    dtype = df.schema[value].dataType
    amount = coerce_amount(F.col(value), dtype)
    return F.sum(amount) if isinstance(dtype, DecimalType) else order_free_sum(amount)


def _as_double(total, dtype):
    if isinstance(dtype, DecimalType):
        return F.coalesce(total, F.lit(0)).cast("double")
    return F.coalesce(total.cast("double"), F.lit(0.0))


def _sum_amount(df: DataFrame, value: str):
    """Sum as DOUBLE; see ``sum_native``."""
    return _as_double(sum_native(df, value), df.schema[value].dataType)


def aggregate_by_date(
    df: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
) -> DataFrame:
    """A1: sum ``value`` per (series, date).

    Hash aggregate with map-side partial sums, so a hot series costs one
    partial row per map task, not one row per input row.  Output columns:
    ``*series, date, value`` (DOUBLE).
    """
    series = as_list(series)
    if date not in df.columns or value not in df.columns:
        raise ValueError(f"DataFrame must have '{date}' and '{value}' columns")
    require_columns(df, series, "series keys")
    return df.groupBy(*series, date).agg(_sum_amount(df, value).alias(value))


def sort_by_date(df: DataFrame, series: Series | None = None, date: str = "date") -> DataFrame:
    """O1: text order of ``date`` within each series (for output only)."""
    if date not in df.columns:
        raise ValueError(f"DataFrame must have '{date}' column")
    return df.orderBy(*as_list(series), date)


def aggregate_by_quarter(
    df: DataFrame,
    series: Series | None = None,
    date: str = "date",
    value: str = "export_amount",
    dates_unique: bool = False,
) -> DataFrame:
    """A3: sum ``value`` per (series, calendar quarter) over observed quarters.

    Two-level: sums per (series, date) first — plain hash keys, no parsing
    per input row, exact native types — then the quarter key is derived on
    those (few) rows and summed again.  A date without a quarter (a month
    outside 1..12) fails the job: its amount would be missing from the totals.
    With ``dates_unique`` (input already one row per (series,
    date), e.g. monthly output) the first level is skipped.
    Output: ``*series, qk, quarter, value``.
    """
    series = as_list(series)
    require_columns(df, [date, value, *series])
    dtype = df.schema[value].dataType
    if dates_unique:
        per_date = df.select(*series, date, coerce_amount(F.col(value), dtype).alias("_s"))
    else:
        per_date = df.groupBy(*series, date).agg(sum_native(df, value).alias("_s"))
    no_quarter = F.raise_error(F.concat(F.lit("no quarter for date "), F.coalesce(F.col(date), F.lit("NULL"))))
    return (
        per_date.withColumn("qk", F.coalesce(quarter_key(F.col(date)), no_quarter.cast("int")))
        .groupBy(*series, "qk")
        .agg((F.sum("_s") if isinstance(dtype, DecimalType) else money_sum(F.col("_s"))).alias("_s"))
        .select(*series, "qk", quarter_label("qk").alias("quarter"), _as_double(F.col("_s"), dtype).alias(value))
    )


def count_records(df: DataFrame, series: Series | None = None, name: str = "records") -> DataFrame:
    """Row counts per series (or one row overall)."""
    series = as_list(series)
    if series:
        return df.groupBy(*series).agg(F.count(F.lit(1)).alias(name))
    return df.agg(F.count(F.lit(1)).alias(name))


def latest_per_group(
    df: DataFrame,
    group: Series | None,
    pick: str,
    by: str,
    name: str | None = None,
) -> DataFrame:
    """The ``pick`` value of the row with the largest ``by`` per group
    (``max_by``; partial aggregation, no sort, no window)."""
    group = as_list(group)
    require_columns(df, [pick, by, *group])
    out = name or f"latest_{pick}"
    aggs = [F.max_by(pick, by).alias(out), F.max(by).alias(f"max_{by}")]
    if group:
        return df.groupBy(*group).agg(*aggs)
    return df.agg(*aggs)
