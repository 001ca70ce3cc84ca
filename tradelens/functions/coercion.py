"""Amount coercion: text or number -> double, with Python ``float(x)`` rules.

Rules (the reference converts with ``float(x)`` and uses 0.0 on failure):

- NULL -> 0.0
- surrounding whitespace is ignored: ``' 12 '`` -> 12.0
- plain decimals and exponents: ``'1e3'`` -> 1000.0, ``'.5'`` -> 0.5
- underscores between digits: ``'1_000'`` -> 1000.0
- ``inf`` / ``infinity`` (any case, signed) -> +-inf
- ``nan`` -> NULL; a NaN amount contributes nothing to a sum, like pandas
- anything else (``'1,234'``, ``'1.5d'``, ``''``) -> 0.0
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, NumericType

from tradelens.functions.periods import strip_text

ColumnOrName = Column | str

_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_TEXT = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
INF_TEXT = r"(?i)^[+-]?(?:inf|infinity)$"
NAN_TEXT = r"(?i)^[+-]?nan$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_float_text(c: ColumnOrName) -> Column:
    return strip_text(c).rlike(FLOAT_TEXT)


def coerce_amount(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """Coerce an amount column to DOUBLE (NULL only for NaN, see module doc).

    Pass ``dtype`` (the column's Spark type) when known: numeric columns skip
    the text path and keep exactness for decimals.
    """
    c = _col(c)
    if isinstance(dtype, DecimalType):
        return F.coalesce(c, F.lit(0).cast(dtype))
    if isinstance(dtype, (DoubleType, FloatType)):
        d = c.cast("double")
        return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(F.coalesce(d, F.lit(0.0)))
    if isinstance(dtype, NumericType):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    t = strip_text(c)
    return (
        F.when(t.rlike(FLOAT_TEXT), F.regexp_replace(t, "_", "").try_cast("double"))
        .when(t.rlike(INF_TEXT), F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(t.rlike(NAN_TEXT), F.lit(None).cast("double"))
        .otherwise(F.lit(0.0))
    )


#: Text amounts with up to 20 digits before and 6 after the point (an exponent
#: of 0 to 9 moves it) are summed exactly, as decimals.
EXACT_TEXT = r"^[+-]?(?:[0-9]{1,20}(?:\.[0-9]{0,6})?|\.[0-9]{1,6})(?:[eE]\+?0*[0-9])?$"
EXACT_TYPE = "decimal(36,6)"


def amount_parts(c: ColumnOrName, dtype: DataType | None = None) -> tuple[Column, Column]:
    """``(exact, approximate)``: an amount as a decimal where its text allows,
    else as a double (the other part is 0).  Sums of the exact parts do not
    depend on the order of rows; what remains are infinities, fine fractions
    and huge numbers."""
    c = _col(c)
    zero = F.lit(0).cast(EXACT_TYPE)
    if isinstance(dtype, DecimalType):
        return F.coalesce(c, F.lit(0).cast(dtype)), F.lit(0.0)
    if isinstance(dtype, NumericType):
        return zero, coerce_amount(c, dtype)
    t = F.regexp_replace(strip_text(c), "_", "")
    exact = F.when(strip_text(c).rlike(FLOAT_TEXT) & t.rlike(EXACT_TEXT), t.try_cast(EXACT_TYPE))
    return F.coalesce(exact, zero), F.when(exact.isNull(), coerce_amount(c, dtype)).otherwise(0.0)
