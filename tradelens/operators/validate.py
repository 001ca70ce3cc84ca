"""Row validation and the valid/rejects channel.

Rules are data: a list of ``(name, message, ok_expression)``.  One pass
computes ``reasons ARRAY<STRING>`` per row; valid rows have none.  The strict
mode (``enforce_rules``) fails the job on the first bad row with the rule's
message (``raise_error``), the safe mode (``split_valid``) returns both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradelens.operators._common import require_columns
from tradelens.session import ensure_checkpoint_dir

Rule = tuple[str, str, Callable[[], Column]]

DATE_PATTERN = r"^[0-9]{4}-(?:0[1-9]|1[0-2])$"


def _date_ok() -> Column:
    return F.col("date").isNotNull() & F.col("date").rlike(DATE_PATTERN)


def _nonneg(name: str) -> Callable[[], Column]:
    def ok() -> Column:
        c = F.col(name).cast("double")
        return c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c < float("inf"))

    return ok


def _opt_number(name: str) -> Callable[[], Column]:
    def ok() -> Column:
        return F.col(name).isNull() | F.col(name).cast("double").isNotNull()

    return ok


# TradeRecord: date YYYY-MM (a real month), finite export_amount >= 0.
TRADE_RECORD_RULES: list[Rule] = [
    ("date", "date must match YYYY-MM with a month from 01 to 12", _date_ok),
    ("export_amount", "export_amount must be a finite number >= 0", _nonneg("export_amount")),
]

# AnalysisResult: TradeRecord + nullable rates.
ANALYSIS_RESULT_RULES: list[Rule] = TRADE_RECORD_RULES + [
    ("export_mom", "export_mom must be a number or NULL", _opt_number("export_mom")),
    ("export_yoy", "export_yoy must be a number or NULL", _opt_number("export_yoy")),
]

# BusinessMetrics: TradeRecord + business_days >= 0, daily_avg >= 0, nullable rates.
BUSINESS_METRICS_RULES: list[Rule] = TRADE_RECORD_RULES + [
    ("business_days", "business_days must be >= 0", _nonneg("business_days")),
    ("daily_avg", "daily_avg must be >= 0", _nonneg("daily_avg")),
    ("daily_avg_mom", "daily_avg_mom must be a number or NULL", _opt_number("daily_avg_mom")),
    ("daily_avg_yoy", "daily_avg_yoy must be a number or NULL", _opt_number("daily_avg_yoy")),
]


OPTIONAL_COLUMNS = {"export_mom", "export_yoy", "daily_avg_mom", "daily_avg_yoy"}


def _applicable(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Plan-time check: required columns must exist; rules on absent optional
    (nullable) columns are skipped."""
    require_columns(df, sorted({n for n, _, _ in rules if n not in OPTIONAL_COLUMNS}), "validation")
    return [r for r in rules if r[0] in df.columns]


def reasons_column(rules: list[Rule]) -> Column:
    """ARRAY<STRING> of the messages of every failed rule (empty when valid)."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok(), F.lit(False)), F.lit(msg)) for _, msg, ok in rules]))


def enforce_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """V1 strict: pass rows through; the first invalid row fails the job."""
    reasons = reasons_column(_applicable(df, rules))
    guard = F.when(F.size(reasons) == 0, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Invalid data at row: "), F.array_join(reasons, "; ")))
    )
    return df.where(guard)


@dataclass(frozen=True)
class Outcome:
    """A (valid, rejects) pair (U2).  ``map`` transforms the valid side,
    ``alt`` the rejects; ``value_or`` gives the valid side of a success and the
    default of a failure (an outcome with rejects; asking runs a job)."""

    valid: DataFrame
    rejects: DataFrame

    def map(self, f: Callable[[DataFrame], DataFrame]) -> "Outcome":
        return Outcome(f(self.valid), self.rejects)

    def alt(self, f: Callable[[DataFrame], DataFrame]) -> "Outcome":
        return Outcome(self.valid, f(self.rejects))

    def failed(self) -> bool:
        return not self.rejects.isEmpty()

    def value_or(self, default: DataFrame) -> DataFrame:
        return default if self.failed() else self.valid


def split_valid(df: DataFrame, rules: list[Rule], reason_col: str = "reason", once: bool = True) -> Outcome:
    """V2 safe: one pass tags rows; valid rows keep their columns, rejects get
    ``reason`` (the failed messages joined with ``'; '``).

    The tagged rows are written once to the shared folder, the two sides in
    folders of their own, and each side reads only its own; the input is not
    evaluated again.  ``once=False`` leaves that out, for inputs that are cheap
    to evaluate twice.
    """
    tagged = df.withColumn("_reasons", reasons_column(_applicable(df, rules)))
    if once:
        spark = df.sparkSession
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tradelens/split-{uuid.uuid4().hex}"
        tagged.withColumn("_ok", F.size("_reasons") == 0).write.partitionBy("_ok").parquet(path)
        tagged = spark.read.schema(tagged.withColumn("_ok", F.lit(True)).schema).parquet(path)
    else:
        tagged = tagged.withColumn("_ok", F.size("_reasons") == 0)
    valid = tagged.where(F.col("_ok")).select(*[F.col(f"`{c}`") for c in df.columns])
    rejects = tagged.where(~F.col("_ok")).withColumn(reason_col, F.array_join("_reasons", "; ")).drop("_reasons", "_ok")
    return Outcome(valid, rejects)


def safe_aggregate_by_date(df: DataFrame, series=None) -> Outcome:
    """A2: ``aggregate_by_date`` with the error channel; a missing column is a
    plan-time failure reported in ``rejects`` (one row, ``reason``)."""
    from tradelens.operators.aggregate import aggregate_by_date

    missing = [c for c in ("date", "export_amount") if c not in df.columns]
    if missing:
        spark = df.sparkSession
        err = spark.createDataFrame([("Missing required columns: date or export_amount",)], "reason string")
        return Outcome(df.limit(0), err)
    empty = df.sparkSession.createDataFrame([], "reason string")
    return Outcome(aggregate_by_date(df, series), empty)


def process_trade_data_safe(raw: DataFrame, series=None, **kw) -> Outcome:
    """C1 -> V2 -> W4 -> P2, per series.

    A series with a bad month fails as a whole, as a run over it alone would:
    none of its rates is published (they would reach across the bad month), and
    all its rows go to ``rejects`` with the reason.  The monthly table is
    written once to the shared folder; both sides read it.
    """
    from tradelens.operators._common import as_list
    from tradelens.operators.growth import monthly_growth
    from tradelens.operators.parse import parse_and_aggregate

    series = as_list(series)
    monthly = parse_and_aggregate(raw, series, **kw)
    own = reasons_column(_applicable(monthly, TRADE_RECORD_RULES))
    w = Window.partitionBy(*series) if series else Window.partitionBy(F.lit(0))  # one row per month
    tagged = monthly.withColumn("_own", own).withColumn("_bad", F.max(F.size("_own")).over(w))
    ensure_checkpoint_dir(raw.sparkSession)
    tagged = tagged.checkpoint()
    valid = tagged.where("_bad = 0").drop("_own", "_bad")
    other = F.lit("another month of the series is invalid")
    reason = F.when(F.size("_own") > 0, F.array_join("_own", "; ")).otherwise(other)
    rejects = tagged.where("_bad > 0").withColumn("reason", reason).drop("_own", "_bad")
    columns = [*series, "date", "export_amount", "export_mom", "export_yoy"]
    return Outcome(monthly_growth(valid, series).select(*columns), rejects)


def to_json_rows(df: DataFrame, out: str = "json") -> DataFrame:
    """V6: one JSON object per row; NULL fields are kept as ``null``."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias(out))


def from_json_rows(df: DataFrame, schema: StructType, col: str = "json") -> DataFrame:
    """V6: parse JSON rows back with an explicit schema."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")
