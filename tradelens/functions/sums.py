"""Sums of doubles that do not depend on the order of rows.

A double is cut at fixed powers of two into integers; integers are summed
exactly, in any order and any number of partial sums, and put together at the
end.  The same rows therefore give the same bits on any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exponents of the parts' units, smallest first; a part has 26 bits (the top
#: one 62), so 2^37 rows a group can be summed.  Bits below 2^-60 are not counted.
EXPONENTS = (-60, -34, -8, 18, 44)
#: Amounts from 2^106 (8e31) on, and infinities, are added as doubles.
LARGE = 2.0**106


def order_free_sum(x: Column) -> Column:
    """Aggregate: the sum of a DOUBLE column, 0.0 without non-NULL rows."""
    usual = F.abs(x) < LARGE
    total = F.lit(0.0)
    above = [2.0**e for e in EXPONENTS[1:]] + [None]
    for exponent, bound in zip(EXPONENTS, above, strict=True):
        rest = x if bound is None else x % bound  # exact, with the sign of x
        part = F.when(usual, (rest / 2.0**exponent).cast("bigint"))
        total = total + F.coalesce(F.sum(part), F.lit(0)).cast("double") * 2.0**exponent
    return total + F.coalesce(F.sum(F.when(~usual, x)), F.lit(0.0))


def money_sum(x: Column) -> Column:
    """``order_free_sum`` for few rows: amounts with up to six decimals (those
    that come back from DECIMAL unchanged) are added as decimals, as written."""
    exact = F.when(F.abs(x) < 1e20, x).cast("decimal(38,6)")
    as_written = exact.cast("double") == x
    total = F.coalesce(F.sum(F.when(as_written, exact)), F.lit(0)).cast("double")
    return total + order_free_sum(F.when(~F.coalesce(as_written, F.lit(False)), x))
