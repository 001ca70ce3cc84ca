"""Growth rates, half-even rounding, daily and quarter averages.

All rounding is half-to-even on the binary double (``rint``), which is what
Python's ``round`` and pandas ``Series.round`` do.  ``F.round`` rounds half
up and must not be used here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: ColumnOrName, digits: int = 0) -> Column:
    """Round to ``digits`` decimals, ties to even (``rint(x*10^d)/10^d``)."""
    c = _col(c)
    if digits == 0:
        return F.rint(c)
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def pct_change(
    cur: ColumnOrName,
    prev: ColumnOrName,
    digits: int | None = 2,
    zero_base: str = "null",
    form: str = "diff",
) -> Column:
    """Percentage change from ``prev`` to ``cur``.

    ``form='diff'``  computes ``(cur - prev) / prev * 100``;
    ``form='ratio'`` computes ``(cur / prev - 1) * 100`` (pandas ``pct_change``).
    Both round to the same value; keep the one the caller's oracle uses.

    ``zero_base='null'``: a zero base gives NULL (monthly MoM/YoY).
    ``zero_base='ieee'``: a zero base gives +inf / -inf / NaN like float
    division (quarterly and dashboard rates).  Spark's ANSI ``/`` raises on
    zero, so the zero branch is spelled out.
    A NULL ``prev`` or ``cur`` always gives NULL.
    """
    if form not in ("diff", "ratio"):
        raise ValueError(f"unknown rate form: {form!r}")
    if zero_base not in ("null", "ieee"):
        raise ValueError(f"unknown zero_base mode: {zero_base!r}")
    if isinstance(cur, str) and isinstance(prev, str):
        # Column names: one SQL expression, parsed JVM-side in a single call
        # (the Column API would cost dozens of driver round trips per rate).
        return F.expr(_pct_change_sql(f"`{cur}`", f"`{prev}`", digits, zero_base, form))
    cur, prev = _col(cur), _col(prev)
    cur_d, prev_d = cur.cast("double"), prev.cast("double")
    if form == "diff":
        rate = (cur_d - prev_d) / prev_d * F.lit(100.0)
    else:
        rate = (cur_d / prev_d - F.lit(1.0)) * F.lit(100.0)
    if digits is not None:
        rate = round_half_even(rate, digits)
    nonzero = prev_d != F.lit(0.0)
    if zero_base == "null":
        return F.when(nonzero, rate)
    ieee_zero = (
        F.when(cur_d > 0, F.lit(float("inf")))
        .when(cur_d < 0, F.lit(float("-inf")))
        .when(cur_d == 0, F.lit(float("nan")))
    )
    return F.when(prev_d.isNull() | cur_d.isNull(), F.lit(None).cast("double")).when(
        nonzero, rate
    ).otherwise(ieee_zero)


def _pct_change_sql(cur: str, prev: str, digits: int | None, zero_base: str, form: str) -> str:
    """The same expression as ``pct_change`` as SQL text."""
    c, p = f"CAST({cur} AS DOUBLE)", f"CAST({prev} AS DOUBLE)"
    rate = f"(({c} - {p}) / {p} * 100.0)" if form == "diff" else f"(({c} / {p} - 1.0) * 100.0)"
    if digits is not None:
        rate = f"rint({rate})" if digits == 0 else f"(rint({rate} * {float(10**digits)}) / {float(10**digits)})"
    if zero_base == "null":
        return f"CASE WHEN {p} != 0.0 THEN {rate} END"
    return (
        f"CASE WHEN {p} IS NULL OR {c} IS NULL THEN CAST(NULL AS DOUBLE) "
        f"WHEN {p} != 0.0 THEN {rate} "
        f"WHEN {c} > 0 THEN CAST('Infinity' AS DOUBLE) WHEN {c} < 0 THEN CAST('-Infinity' AS DOUBLE) "
        f"WHEN {c} = 0 THEN CAST('NaN' AS DOUBLE) END"
    )


def daily_average(amount: ColumnOrName, business_days: ColumnOrName) -> Column:
    """``round(amount / business_days)`` half-even as LONG; 0 when there are no days."""
    amount, days = _col(amount), _col(business_days)
    return (
        F.when(days > 0, F.rint(amount.cast("double") / days.cast("double")))
        .otherwise(F.lit(0.0))
        .cast("long")
    )


def quarter_average(quarter_sum: ColumnOrName) -> Column:
    """Quarter average: the sum divided by 3 *always* (partial quarters too), half-even."""
    return F.rint(_col(quarter_sum).cast("double") / F.lit(3.0))
