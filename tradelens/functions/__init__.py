"""Pure Column expressions: no DataFrame, no action, no Python UDF."""

from tradelens.functions.coercion import coerce_amount, is_float_text
from tradelens.functions.periods import (
    business_date_ok,
    format_date,
    month_of,
    normalize_date,
    parse_month,
    parse_year,
    quarter_key,
    quarter_label,
    quarter_year,
    strip_text,
    year_month_key,
    year_of,
)
from tradelens.functions.rates import daily_average, pct_change, quarter_average, round_half_even

__all__ = [
    "business_date_ok",
    "coerce_amount",
    "daily_average",
    "format_date",
    "is_float_text",
    "month_of",
    "normalize_date",
    "parse_month",
    "parse_year",
    "pct_change",
    "quarter_average",
    "quarter_key",
    "quarter_label",
    "quarter_year",
    "round_half_even",
    "strip_text",
    "year_month_key",
    "year_of",
]
