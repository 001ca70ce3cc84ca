"""Report exports as a stream: each micro-batch holds the lines of newly
arrived files; the batch report (C8) runs on them and overwrites only the
``source_file`` partitions it produced (dynamic partition overwrite).

Row order inside a file is taken in ``foreachBatch`` from the batch's scan
(split start + ``monotonically_increasing_id``), exactly as the batch reader
does; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelens.operators.parse import process_trade_data
from tradelens.plans.verbs import report_tables
from tradelens.sources.reports import DEFAULT_SKIP_ROWS, report_cells

def start_report_stream(
    spark: SparkSession,
    input_dir: str,
    output: str,
    checkpoint_location: str,
    start_year: int,
    end_year: int,
    skip_rows: int = DEFAULT_SKIP_ROWS,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental report; returns the running ``StreamingQuery``.

    ``checkpoint_location`` must be on shared storage (it holds the file
    source's progress); output tables are ``output/monthly`` and
    ``output/quarterly`` partitioned by ``source_file``.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(input_dir).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace(F.col("value"), "\r$", "").alias("line"),
    )

    def run(batch: DataFrame, epoch_id: int) -> None:
        # Row ids are taken right at this batch's scan, before any shuffle.
        rows = report_cells(batch.withColumn("row_no", F.monotonically_increasing_id()))
        monthly = process_trade_data(rows, ["source_file"], chunk="block", head_rows=skip_rows)
        tables = report_tables(monthly, ["source_file"], start_year, end_year)
        for name, df in (("monthly", tables.monthly), ("quarterly", tables.quarterly)):
            (
                df.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("source_file")
                .parquet(f"{output}/{name}")
            )

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
