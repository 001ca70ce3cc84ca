"""Sinks (K1-K4).  All writes are distributed (one file set per task) and
idempotent per output folder (``mode='overwrite'``), so a lost executor's
tasks are simply re-run."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tradelens.operators.dashboard import DASHBOARD_LABELS, dashboard_labels


#: Folders of a written table: their number does not grow with the series.
BUCKETS = 64


def _clustered(df: DataFrame, series: list[str] | None, seen: Observation | None = None) -> DataFrameWriter:
    """A writer with the rows of each series together, in bucket folders.

    Tasks are ranges of (bucket, series, year) of about equal size, cut by
    Spark's sample of the keys: their number follows the data, not the folders,
    and a hot series is cut between its years."""
    count = F.count(F.lit(1)).alias("records")

    def observed(rows: DataFrame) -> DataFrame:
        return rows if seen is None else rows.observe(seen, count)

    if not series:
        return observed(df).write
    bucketed = df.withColumn("bucket", F.pmod(F.xxhash64(*series), F.lit(BUCKETS)).cast("int"))
    period = next((c for c in ("date", "quarter", DASHBOARD_LABELS["date"]) if c in df.columns), None)
    years = [F.substring(period, 1, 4)] if period else []
    ranges = bucketed.repartitionByRange("bucket", *series, *years)
    ordered = ranges.sortWithinPartitions("bucket", *series, *([period] if period else []))
    return observed(ordered).write.partitionBy("bucket")


def write_report(
    monthly: DataFrame,
    quarterly: DataFrame,
    out: str,
    series: list[str] | None = None,
    fmt: str = "parquet",
) -> dict[str, int]:
    """K1 + K3: two tables ``out/monthly`` and ``out/quarterly``; the rows of a
    series lie together in one of ``BUCKETS`` folders.

    Returns the record counts of the two tables (A6), observed while they are
    written."""
    counts = {}
    for name, df in (("monthly", monthly), ("quarterly", quarterly)):
        seen = Observation(name)
        w = _clustered(df, series, seen).mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(f"{out}/{name}")
        counts[name] = seen.get["records"]
    return counts


def write_dashboard(
    enriched: DataFrame,
    out: str,
    source: str | None = None,
    series: list[str] | None = None,
    fmt: str = "csv",
) -> None:
    """K2: labelled dashboard rows with a ``title`` column
    (``Dashboard - <source file name>``, or the series' keys)."""
    df = enriched
    if source is not None:
        df = df.withColumn("title", F.concat(F.lit("Dashboard - "), F.substring_index(F.lit(source), "/", -1)))
    elif "source_file" in df.columns:
        df = df.withColumn("title", F.concat(F.lit("Dashboard - "), F.substring_index("source_file", "/", -1)))
    elif series:
        df = df.withColumn("title", F.concat(F.lit("Dashboard - "), F.concat_ws(" ", *series)))
    labelled = dashboard_labels(df)
    w = _clustered(labelled, series).mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(out)


def convert_format(spark: SparkSession, src: str, src_fmt: str, out: str, out_fmt: str, **read_opts) -> None:
    """K4: bulk format conversion; sources are kept (never deleted)."""
    df = spark.read.format(src_fmt).options(**read_opts).load(src)
    w = df.write.mode("overwrite").format(out_fmt)
    if out_fmt == "csv":
        w = w.option("header", True)
    w.save(out)
