"""User verbs (C8 report, C9 dashboard, C10 full) over many series at once.

Each verb builds one plan: read -> parse/select -> monthly aggregate (one
exchange, map-side partial sums) -> series windows (one exchange by series,
one sort) -> year filter -> write.  The year filter is applied *after* the
windows so the first shown year keeps its year-over-year rates.

When a verb writes two outputs from the same monthly table, the table is
materialised once with ``checkpoint()`` into the cluster's shared
``spark.checkpoint.dir`` (never a machine-local folder): both writes read it,
and a lost executor does not force the scan and aggregation to run again.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tradelens.functions.periods import with_period_keys
from tradelens.operators._common import as_list
from tradelens.operators.calendar import FIXED
from tradelens.operators.dashboard import enrich_data
from tradelens.operators.growth import filter_by_year, filter_quarterly_by_year, monthly_growth, process_quarterly
from tradelens.operators.parse import process_trade_data
from tradelens.operators.select import strategy_totals
from tradelens.session import ensure_checkpoint_dir
from tradelens.sources.reports import DEFAULT_SKIP_ROWS, is_processed_report, latest_file, read_report_rows
from tradelens.sources.sinks import write_dashboard, write_report

DEFAULT_YEARS = (2024, 2025)
#: Where the verbs look for the newest export if no path is given.
DEFAULT_DATA_DIR = "data"


@dataclass(frozen=True)
class ReportTables:
    monthly: DataFrame
    quarterly: DataFrame
    #: Record counts observed while the tables were written.
    written: dict[str, int] | None = None

    def counts(self) -> tuple[int, int]:
        """Record counts of the two tables; runs jobs only if they were not
        written."""
        if self.written is not None:
            return self.written["monthly"], self.written["quarterly"]
        return self.monthly.count(), self.quarterly.count()


def monthly_from_exports(
    spark: SparkSession,
    path: str,
    skip_rows: int = DEFAULT_SKIP_ROWS,
    fallback_skip_rows: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Report exports (one or many files) -> monthly growth per source file.

    One read and one shuffle of the export lines: header lines are dropped
    inside the segmented forward fill (first lines of each file's split 0)."""
    raw = read_report_rows(spark, path, glob)
    return process_trade_data(
        raw, ["source_file"], chunk="block", head_rows=skip_rows, fallback_head_rows=fallback_skip_rows
    )


def report_tables(
    monthly: DataFrame,
    series=None,
    start_year: int = DEFAULT_YEARS[0],
    end_year: int = DEFAULT_YEARS[1],
) -> ReportTables:
    """C8 (data part): monthly rows with MoM/YoY and quarterly rows with
    QoQ/YoY, both restricted to [start_year, end_year] after the rates."""
    series = as_list(series)
    if "export_mom" not in monthly.columns:
        keyed, added = with_period_keys(monthly)
        monthly = monthly_growth(keyed, series).drop(*added)
    # Monthly rows are one per (series, date): the quarter sums need no
    # per-date pre-aggregation.
    quarterly = process_quarterly(monthly.select(*series, "date", "export_amount"), series, dates_unique=True)
    return ReportTables(
        filter_by_year(monthly, start_year, end_year),
        filter_quarterly_by_year(quarterly, start_year, end_year),
    )


def dashboard_table(
    monthly: DataFrame,
    series=None,
    start_year: int = DEFAULT_YEARS[0],
    end_year: int = DEFAULT_YEARS[1],
    holidays: DataFrame | str | None = FIXED,
) -> DataFrame:
    """C9 (data part): enrichment on the full history, then the year range.

    A processed report (S6: growth columns present) is enriched as is."""
    series = as_list(series)
    # The period keys are added once and kept through growth and enrichment,
    # so all their windows share one sort.
    keyed, added = with_period_keys(monthly)
    if not is_processed_report(monthly):
        keyed = monthly_growth(keyed, series)
    enriched = enrich_data(keyed, series, holidays=holidays).drop(*added)
    return filter_by_year(enriched, start_year, end_year)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder (reliable checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def report(
    spark: SparkSession,
    input_path: str | None,
    output: str,
    start_year: int = DEFAULT_YEARS[0],
    end_year: int = DEFAULT_YEARS[1],
    data_dir: str = DEFAULT_DATA_DIR,
) -> ReportTables:
    """Report exports -> ``output/monthly`` + ``output/quarterly``.

    Without ``input_path`` the newest export of ``data_dir`` is read (S5)."""
    path = latest_file(spark, data_dir) if input_path is None else input_path
    monthly = materialize(monthly_from_exports(spark, path))
    tables = report_tables(monthly, ["source_file"], start_year, end_year)
    return replace(tables, written=write_report(tables.monthly, tables.quarterly, output, ["source_file"]))


def dashboard(
    spark: SparkSession,
    input_path: str | None,
    output: str,
    start_year: int = DEFAULT_YEARS[0],
    end_year: int = DEFAULT_YEARS[1],
    holidays: DataFrame | str | None = FIXED,
    data_dir: str = DEFAULT_DATA_DIR,
) -> DataFrame:
    """Report exports -> labelled dashboard rows with a title per file.

    Without ``input_path`` the newest export of ``data_dir`` is read (S5)."""
    path = latest_file(spark, data_dir) if input_path is None else input_path
    monthly = monthly_from_exports(spark, path)
    table = dashboard_table(monthly, ["source_file"], start_year, end_year, holidays)
    write_dashboard(table, output, series=None)
    return table


def dashboard_from_report(
    spark: SparkSession,
    report_dir: str,
    output: str,
    start_year: int = DEFAULT_YEARS[0],
    end_year: int = DEFAULT_YEARS[1],
    holidays: DataFrame | str | None = FIXED,
) -> DataFrame:
    """C9 from a processed report (S6): read the ``monthly`` table written by
    ``report`` (growth columns present, so growth is not recomputed) and
    enrich it.  Like the reference's shortcut, the report is already
    year-filtered, so the first year has no daily-average YoY."""
    monthly = spark.read.parquet(f"{report_dir}/monthly")
    table = dashboard_table(monthly, ["source_file"], start_year, end_year, holidays)
    write_dashboard(table, output, series=None)
    return table


def full(
    facts: DataFrame,
    items: DataFrame,
    output: str,
    start_year: int = DEFAULT_YEARS[0],
    end_year: int = DEFAULT_YEARS[1],
    holidays: DataFrame | str | None = FIXED,
) -> tuple[ReportTables, DataFrame]:
    """Select every strategy item's facts (J6-J9), then report and
    dashboard for all items in one job set: ``output/report/{monthly,
    quarterly}`` and ``output/dashboard``, rows clustered by strategy and item."""
    series = ["strategy", "item"]
    monthly = strategy_totals(facts, items)
    keyed, added = with_period_keys(monthly)
    grown_keyed = materialize(monthly_growth(keyed, series))
    grown = grown_keyed.drop(*added)
    tables = report_tables(grown, series, start_year, end_year)
    tables = replace(tables, written=write_report(tables.monthly, tables.quarterly, f"{output}/report", series))
    dash = dashboard_table(grown_keyed, series, start_year, end_year, holidays).drop(*added)
    write_dashboard(dash, f"{output}/dashboard", series=series)
    return tables, dash
