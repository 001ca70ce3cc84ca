"""Period text parsing and calendar keys.

Report exports mark periods with Korean suffixes: a year row ``2024년``
followed by month rows ``01월`` .. ``12월``.  Dates inside the engine are
``YYYY-MM`` text plus two integer keys:

- ``ym  = year * 100 + month``  (one calendar year back is ``ym - 100``; this
  equals the text rule "same month, year - 1" even for odd months like 13)
- ``qk  = year * 10 + quarter`` (one calendar year back is ``qk - 10``)

Both keys sort like the ``YYYY-MM`` / ``YYYYQn`` text they stand for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the report format (do not change):
# the year suffix, the month suffix, and the two date separators.
YEAR_SUFFIX = "년"
MONTH_SUFFIX = "월"
DATE_SEPARATORS = ("-", "/")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: ColumnOrName) -> Column:
    """Trim leading/trailing Unicode whitespace (Python ``str.strip``)."""
    return F.regexp_replace(_col(c).cast("string"), r"(?U)^\s+|\s+$", "")


def parse_year(c: ColumnOrName) -> Column:
    """``'2024년'`` -> ``'2024'``; anchored at the start only (``'2024년 합계'`` is a year)."""
    t = strip_text(c)
    return F.when(t.rlike(f"^[0-9]{{4}}{YEAR_SUFFIX}"), F.substring(t, 1, 4))


def parse_month(c: ColumnOrName) -> Column:
    """``'1월'``/``'01월'`` -> ``'01'``; one or two digits right before the suffix."""
    t = strip_text(c)
    return F.when(
        t.rlike(f"^[0-9]{{1,2}}{MONTH_SUFFIX}"),
        F.lpad(F.regexp_extract(t, f"^([0-9]{{1,2}}){MONTH_SUFFIX}", 1), 2, "0"),
    )


def format_date(year: ColumnOrName, month: ColumnOrName) -> Column:
    """``YYYY-MM``.  Months longer than two digits are kept whole (``lpad`` would cut them)."""
    m = _col(month).cast("string")
    padded = F.when(F.length(m) < 2, F.lpad(m, 2, "0")).otherwise(m)
    return F.concat_ws("-", _col(year).cast("string"), padded)


def normalize_date(c: ColumnOrName) -> Column:
    """Accept ``YYYY/MM`` as well as ``YYYY-MM``."""
    return F.regexp_replace(_col(c), "/", "-")


def _digits(c: Column) -> Column:
    """Non-empty and only ASCII digits (no regex: ``translate`` drops them)."""
    return (F.length(c) > 0) & (F.length(F.translate(c, "0123456789", "")) == 0)


def _is_year_month(d: Column) -> Column:
    """``YYYY-M``, ``YYYY-MM`` or ``YYYY/MM`` text, checked without a regex
    (this runs on every fact row before aggregation)."""
    return (
        F.length(d).between(6, 7)
        & F.substring(d, 5, 1).isin("-", "/")
        & _digits(F.substring(d, 1, 4))
        & _digits(F.substring(d, 6, 2))
    )


def year_of(date: ColumnOrName) -> Column:
    """Year of ``YYYY-MM`` / ``YYYY/MM`` / ``YYYY-M`` text; NULL otherwise."""
    d = _col(date)
    return F.when(_is_year_month(d), F.substring(d, 1, 4).cast("int"))


def month_of(date: ColumnOrName) -> Column:
    d = _col(date)
    return F.when(_is_year_month(d), F.substring(d, 6, 2).cast("int"))


def year_month_key(date: ColumnOrName) -> Column:
    """``'2024-03'`` -> ``202403``; NULL when the text is not a year-month
    (one validity check, then substring arithmetic)."""
    d = _col(date)
    return F.when(
        _is_year_month(d), F.substring(d, 1, 4).cast("int") * 100 + F.substring(d, 6, 2).cast("int")
    )


def quarter_of_ym(ym: ColumnOrName) -> Column:
    """``202405`` -> ``20242``; NULL for months outside 1..12.  Integer
    arithmetic only: derive keys from ``_ym`` instead of re-parsing text."""
    ym = _col(ym)
    m = ym % 100
    return F.when(m.between(1, 12), F.floor(ym / 100).cast("int") * 10 + F.floor((m - 1) / 3).cast("int") + 1)


def quarter_key(date: ColumnOrName) -> Column:
    """``'2024-05'`` -> ``20242``; NULL for months outside 1..12."""
    return quarter_of_ym(year_month_key(date))


def quarter_year(qk: ColumnOrName) -> Column:
    return F.floor(_col(qk) / 10).cast("int")


def quarter_label(qk: ColumnOrName) -> Column:
    """``20242`` -> ``'2024Q2'``."""
    qk = _col(qk)
    return F.concat(F.floor(qk / 10).cast("string"), F.lit("Q"), (qk % 10).cast("string"))


YM_KEY = "_ym"
QK_KEY = "_qk"


def with_period_keys(df, date: str = "date"):
    """Add the integer keys ``_ym`` / ``_qk`` once (no-op when present).

    Returns ``(df, added)``; operators drop only the keys they added, so a
    chain of operators shares one key column and Spark sorts once."""
    cols = df.columns
    added = []
    if YM_KEY not in cols:
        df = df.withColumn(YM_KEY, year_month_key(F.col(date)))
        added.append(YM_KEY)
    if QK_KEY not in cols:
        df = df.withColumn(QK_KEY, quarter_of_ym(F.col(YM_KEY)))
        added.append(QK_KEY)
    return df, added


def business_date_ok(date: ColumnOrName) -> Column:
    """The business-day rule only counts dates of exactly seven characters
    (``2024-01`` / ``2024/01``) with a real month; everything else gets 0 days."""
    d = _col(date)
    return (F.length(d) == 7) & _is_year_month(d) & F.substring(d, 6, 2).cast("int").between(1, 12)
