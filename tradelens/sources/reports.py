"""Report-export sources.

Report exports are text/CSV files: two title rows, a two-row header, then
data rows whose first column is the period (``2024년``, ``01월``, ``총계``)
and whose second column is the export amount.  Spark has no Excel source;
exports are read as CSV text.

Reading is split-parallel: ``spark.read.text`` cuts large files into splits
like any text source.  Row order inside a file is recovered without
``wholetext`` (which would load a whole file into one row of one task):
``(_metadata.file_block_start, monotonically_increasing_id())`` taken right
at the scan, before any shuffle, orders the lines of a file, and the split
start doubles as the forward-fill segment (see ``operators.parse``).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a file that are read at a time to find its first lines.
HEAD_BYTES = 1 << 16
# Lines before the data in a report export: two title rows + two header rows.
DEFAULT_SKIP_ROWS = 4
# Functions that run in Python workers travel by value: executors need not have
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROWTH_COLUMNS = ("export_mom", "export_yoy")


def read_report_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Raw lines: ``source_file, block, row_no, line`` (``\\r`` stripped).

    ``row_no`` is increasing in file order within ``(source_file, block)``.
    A missing path fails with Spark's ``PATH_NOT_FOUND`` (the strict reader)."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_no"),
        F.regexp_replace(F.col("value"), "\r$", "").alias("line"),
    )


def report_cells(lines: DataFrame, sep: str = ",") -> DataFrame:
    """The first two CSV cells of every line as ``period_raw``, ``export_amount``."""
    cells = F.from_csv(F.col("line"), "c0 STRING, c1 STRING", {"sep": sep})
    return lines.select(
        "source_file",
        "block",
        "row_no",
        cells["c0"].alias("period_raw"),
        cells["c1"].alias("export_amount"),
    )


def read_report_rows(spark: SparkSession, path: str, glob: str | None = None, sep: str = ",") -> DataFrame:
    """All lines of the exports, header lines included, as report rows.

    The one-pass path: give the header size to the parser
    (``process_trade_data(..., chunk="block", head_rows=DEFAULT_SKIP_ROWS)``),
    which drops the header lines inside its single shuffle of the rows."""
    return report_cells(read_report_lines(spark, path, glob), sep)


def read_report_exports(
    spark: SparkSession,
    path: str,
    skip_rows: int = DEFAULT_SKIP_ROWS,
    glob: str | None = None,
    sep: str = ",",
    fallback_skip_rows: int | None = None,
) -> DataFrame:
    """Report rows ``source_file, block, row_no, period_raw,
    export_amount`` (amount still text) without the title/header lines.

    Only the first two CSV columns are parsed.  Header lines are the first
    ``skip_rows`` lines of each *file*, counted over all its splits; they are
    found and dropped in one read and one shuffle of the lines, by segment (see
    ``operators.parse.forward_fill``).  The verbs use ``read_report_rows``
    instead, whose header lines go inside the parser's shuffle.
    S3: a file too short for that layout (no line after the header) is read
    with ``fallback_skip_rows`` instead, when given.
    """
    from tradelens.operators.parse import forward_fill

    lines = read_report_lines(spark, path, glob)
    if skip_rows > 0 or fallback_skip_rows is not None:
        lines = forward_fill(
            lines.withColumn("_none", F.lit(None).cast("string")), "_none", "source_file", "row_no", "_filled", chunk="block",
            head_rows=skip_rows, fallback_head_rows=fallback_skip_rows,
        ).drop("_none", "_filled")
    return report_cells(lines, sep)


def _csv_cells(line: Column, sep: str) -> Column:
    """The cells of one CSV line of any width; ``sep`` is taken literally."""
    quoted = rf'\Q{sep}\E("(?:[^"]|"")*+"|(?:(?!\Q{sep}\E).)*+)'
    cells = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(quoted), 1)
    plain = F.transform(cells, lambda c: F.regexp_replace(c, r'^"|"$', ""))
    unquoted = F.transform(plain, lambda c: F.replace(c, F.lit('""'), F.lit('"')))
    return F.transform(cells, lambda c, i: F.when(c.startswith('"'), F.get(unquoted, i)).otherwise(c))


def head_lines(read, n: int, gzipped: bool = False, block: int = HEAD_BYTES) -> list[str]:
    """The first ``n`` lines of a file; ``read(size)`` gives its next bytes.

    Reads ``block`` bytes at a time until the lines are there, so what is read
    depends on the lines' length only."""
    import zlib

    inflate = zlib.decompressobj(31) if gzipped else None
    data = b""
    while data.count(b"\n") < n:
        more = read(block)
        if not more:
            break
        data += inflate.decompress(more) if inflate else more
    lines = data.split(b"\n")
    if lines[-1] == b"":
        lines.pop()
    return [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines[:n]]


def read_report_heads(spark: SparkSession, path: str, n: int, glob: str | None = None) -> DataFrame:
    """The first ``n`` lines of every file: ``source_file, line_no, line``.

    Spark lists the files (names only); tasks read the first block of each.  A
    store that Arrow cannot open is read by Spark, whole."""
    from pyarrow.fs import FileSystem

    files = spark.read.format("binaryFile")
    files = (files.option("pathGlobFilter", glob) if glob else files).load(path).select(F.col("_metadata.file_path").alias("source_file"), "path")
    some = files.select("path").first()
    try:
        if some and not some["path"].startswith("file:"):
            FileSystem.from_uri(some["path"])
    except (ValueError, OSError, NotImplementedError):
        lines = read_report_lines(spark, path, glob).where(F.col("block") == 0)
        first = lines.groupBy("source_file").agg(F.min("row_no").alias("_first"))
        lines = lines.join(first, "source_file").withColumn("line_no", F.col("row_no") - F.col("_first"))
        return lines.where(F.col("line_no") < n).select("source_file", "line_no", "line")

    def run(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem, LocalFileSystem

        for got in batches:
            rows = []
            for name, place in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
                if place.startswith("file:"):
                    fs, at = LocalFileSystem(), "/" + place[5:].lstrip("/")
                else:
                    fs, at = FileSystem.from_uri(place)
                with fs.open_input_stream(at, compression=None) as f:
                    rows += [(name, i, line) for i, line in enumerate(head_lines(f.read, n, place.endswith(".gz")))]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["source_file", "line_no", "line"])

    return files.mapInArrow(run, "source_file string, line_no long, line string")


def read_report_header(
    spark: SparkSession,
    path: str,
    header_rows: tuple[int, int] = (2, 3),
    glob: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """The two-row header of every export, flattened to one name per
    column: ``source_file, col_idx, name`` with ``name = top_sub`` (an empty
    top cell repeats the previous top, as merged header cells do).

    Only the first block of each file is read (``read_report_heads``); quoted
    cells may hold the separator."""
    top_i, sub_i = header_rows
    lines = read_report_heads(spark, path, max(header_rows) + 1, glob)
    picked = lines.where(F.col("line_no").isin(top_i, sub_i)).select(
        "source_file", F.col("line_no").alias("_i"), F.posexplode(_csv_cells(F.col("line"), sep)).alias("col_idx", "cell")
    )
    cells = picked.groupBy("source_file", "col_idx").agg(
        F.max(F.when(F.col("_i") == top_i, F.trim("cell"))).alias("top"),
        F.max(F.when(F.col("_i") == sub_i, F.trim("cell"))).alias("sub"),
    )
    from pyspark.sql import Window

    w = Window.partitionBy("source_file").orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("top") != "", F.col("top")), ignorenulls=True).over(w)
    return cells.select(
        "source_file",
        "col_idx",
        F.concat_ws("_", top, F.when(F.col("sub") != "", F.col("sub"))).alias("name"),
    )


def read_report_exports_safe(spark: SparkSession, path: str, **kw):
    """S4 safe: ``Outcome(rows, errors)``.  A missing path becomes the error
    row ``File not found: <path>``, any other read failure ``Error reading
    report export: ...``; nothing raises.  (Spark resolves the path when the
    DataFrame is created, so no data is read to find out.)"""
    from pyspark.errors import AnalysisException

    from tradelens.operators.validate import Outcome

    empty = spark.createDataFrame(
        [], "source_file string, block long, row_no long, period_raw string, export_amount string"
    )
    try:
        rows = read_report_exports(spark, path, **kw)
    except AnalysisException as e:
        msg = f"File not found: {path}" if "PATH_NOT_FOUND" in str(e) else f"Error reading report export: {e}"
        return Outcome(empty, spark.createDataFrame([(msg,)], "error string"))
    return Outcome(rows, spark.createDataFrame([], "error string"))


def latest_files(spark: SparkSession, path: str, glob: str = "*.csv", group: str | None = None) -> DataFrame:
    """Newest file (by modification time) overall or per ``group``
    (a column derived from the path, e.g. the strategy folder).  Only
    ``path`` and ``modificationTime`` are read; file contents are pruned."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "modificationTime")
    )
    if group:
        files = files.withColumn(group, F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
        return files.groupBy(group).agg(F.max_by("path", "modificationTime").alias("path"))
    return files.agg(F.max_by("path", "modificationTime").alias("path"))


def latest_file(spark: SparkSession, path: str, glob: str = "*.csv") -> str:
    """S5 strict: the newest matching file's path (one value to the driver).

    Raises ``FileNotFoundError`` when the folder is missing or holds no
    matching file, as the reference does."""
    from pyspark.errors import AnalysisException

    try:
        row = latest_files(spark, path, glob).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"Directory not found: {path}") from e
        raise
    if row is None or row["path"] is None:
        raise FileNotFoundError(f"No {glob} files found in {path}")
    return row["path"]


def is_processed_report(df: DataFrame) -> bool:
    """A frame that already carries growth columns is a processed report;
    parsing is skipped (decided by schema, not by file name)."""
    return all(c in df.columns for c in GROWTH_COLUMNS) and "date" in df.columns
