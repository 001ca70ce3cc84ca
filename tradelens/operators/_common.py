"""Shared helpers for operators: column checks, series keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

Series = Sequence[str]

def as_list(series: Series | str | None) -> list[str]:
    if series is None:
        return []
    if isinstance(series, str):
        return [series]
    return list(series)


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "DataFrame") -> None:
    """Plan-time column check; raises ``ValueError`` naming what is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {sorted(missing)} ({what})")
