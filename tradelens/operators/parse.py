"""Report-row parsing.

A report export lists a year row (``2024년``, its amount is the annual
subtotal and is ignored) followed by month rows (``01월``...).  A month row
belongs to the most recent year row above it; rows before any year row and
other rows (``총계``) are dropped.

Row order is data: every raw row carries ``row_no`` (order within its
source), and optionally a ``chunk`` id (e.g. the file split it was read
from).  The year forward-fill is a *segmented scan* over segments of at most
``chunk_rows`` row numbers of a chunk, so a single huge report (a third of all
rows, or one gzip file, which is one split) is spread over many bounded tasks
instead of one window partition, and is read and shuffled once.

Header lines are the first lines of a *source*, wherever its segments begin: the
rows before a segment are known from the segments' sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tradelens.functions.coercion import amount_parts, coerce_amount
from tradelens.functions.periods import format_date, parse_month, parse_year, strip_text
from tradelens.functions.sums import order_free_sum
from tradelens.operators._common import Series, as_list, require_columns
from tradelens.operators.growth import MONTHLY_COLUMNS, monthly_growth

# Rows per forward-fill segment when the input has no natural chunk column.
DEFAULT_CHUNK_ROWS = 1 << 20

RAW_COLUMNS = ["period_raw", "export_amount"]


def select_positional(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Take the first two columns by position and rename them."""
    names = names or RAW_COLUMNS
    if len(df.columns) < len(names):
        raise ValueError(f"expected at least {len(names)} columns, got {df.columns}")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)])


def _segment(row_no: str, chunk: str | None, chunk_rows: int):
    """The segment of a row: its chunk, then a range of row numbers."""
    part = F.floor(F.col(row_no) / F.lit(chunk_rows))
    return F.struct(F.col(chunk).alias("chunk"), part.alias("part")) if chunk else part


def _header_lines(total, head_rows: int, fallback_head_rows: int | None):
    """S3: header lines of a source with ``total`` rows: the fallback layout if
    no row would be left after the primary one's header."""
    fallback = head_rows if fallback_head_rows is None else fallback_head_rows
    return F.when(total > head_rows, F.lit(head_rows)).otherwise(F.lit(fallback))


def forward_fill(
    df: DataFrame,
    value: str,
    partition_by: Series | None,
    order_by: str,
    out: str,
    chunk: str | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    head_rows: int = 0,
    fallback_head_rows: int | None = None,
) -> DataFrame:
    """``out`` = last non-NULL ``value`` at or before each row, per partition.

    Equivalent to ``last(value, ignorenulls).over(partitionBy(P).orderBy(O)
    .rowsBetween(unboundedPreceding, 0))`` but bounded per task, with one read
    and one shuffle of the rows:

    1. rows are shuffled by segment ``(P, segment)``; a window per segment fills
       inside it;
    2. from the same shuffled rows, each segment's first rows give its size, its
       last value and its possible header lines; a window over these one-row
       summaries gives each segment its carry-in value;
    3. the summaries are joined with the rows, which are in place and in order
       already.

    Both branches read all columns, so Spark finds their shuffles equal and runs
    the input once (``ReusedExchange``).

    ``head_rows``: the first rows of each partition are header lines; they are
    dropped and their values ignored (``fallback_head_rows`` when the partition
    has no row after the header).
    """
    parts = as_list(partition_by)
    require_columns(df, [value, order_by, *parts])
    maybe = max(head_rows, fallback_head_rows or 0)  # rows of a segment that may be header lines
    # One key for partition and segment: a struct, so NULL keys equal each other.
    seg = F.struct(*[F.col(f"`{p}`") for p in parts], _segment(order_by, chunk, chunk_rows).alias("_part"))
    src = df.withColumn("_seg", seg).repartition("_seg")
    w = Window.partitionBy("_seg").orderBy(order_by)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    late = F.when(F.col("_rn") > maybe, F.col(value))
    local = src.withColumn("_rn", F.row_number().over(w)).withColumns(
        {
            "_n": F.count(F.lit(1)).over(whole),
            "_late": F.last(late, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_tail": F.last(late, ignorenulls=True).over(whole),
        }
    )
    # Each segment's first rows, whole: a branch that needed fewer columns would
    # be pruned to a shuffle of its own.
    row = F.struct("_rn", F.col(value).alias("_v"), "_n", "_tail", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"))
    heads = local.where(F.col("_rn") <= maybe + 1).groupBy("_seg").agg(F.collect_list(row).alias("_first"))
    heads = heads.withColumn("_first", F.array_sort("_first", lambda a, b: a["_rn"] - b["_rn"]))
    heads = heads.withColumns({"_rows": F.col("_first")[0]["_n"], "_last": F.col("_first")[0]["_tail"]})
    source = Window.partitionBy(*([F.col("_seg")[p] for p in parts] or [F.lit(0)]))
    before = source.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumns(
        {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_total": F.sum("_rows").over(source)}
    )
    heads = heads.withColumn("_skip", _header_lines(F.col("_total"), head_rows, fallback_head_rows) - F.col("_before"))
    # Values of the segment's first rows that are no header lines.
    early = f"transform(filter(_first, f -> f._rn > _skip AND f._rn <= {maybe} AND f._v IS NOT NULL), f -> struct(f._rn, f._v))"
    heads = heads.withColumn("_early", F.expr(early))
    own = F.coalesce("_last", F.expr("try_element_at(_early, -1)._v"))
    carry = heads.select("_seg", "_skip", "_early", F.last(own, ignorenulls=True).over(before).alias("_carry"))
    upto = F.when(F.size("_early") > 0, F.expr("try_element_at(filter(_early, f -> f._rn <= _rn), -1)._v"))
    if maybe == 0:
        upto = F.lit(None)
    filled = local.join(carry, "_seg").where(F.col("_rn") > F.greatest(F.col("_skip"), F.lit(0)))
    return filled.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_late", upto, "_carry").alias(out))


def parse_period_rows(
    raw: DataFrame,
    series: Series | None = None,
    row_no: str = "row_no",
    period: str = "period_raw",
    amount: str = "export_amount",
    chunk: str | None = None,
    head_rows: int = 0,
    fallback_head_rows: int | None = None,
) -> DataFrame:
    """F1-F5 + W1 + P6: raw report rows -> one row per month row.

    ``head_rows``: the first lines of each source are header lines and are
    dropped inside the fill pass (see ``forward_fill``).

    Output: ``*series, row_no, date, export_amount`` (amount coerced to DOUBLE,
    or kept DECIMAL when the raw amount is decimal)."""
    series = as_list(series)
    require_columns(raw, [row_no, period, amount, *series])
    text = strip_text(F.col(period))
    keep = [*series, row_no, *( [chunk] if chunk else [])]
    staged = raw.select(
        *keep,
        parse_year(text).cast("int").alias("_year"),
        parse_month(text).alias("_month"),
        coerce_amount(F.col(amount), raw.schema[amount].dataType).alias("_amount"),
    )
    filled = forward_fill(
        staged,
        "_year",
        series,
        row_no,
        "_cur_year",
        chunk=chunk,
        head_rows=head_rows,
        fallback_head_rows=fallback_head_rows,
    )
    months = filled.where(
        F.col("_year").isNull() & F.col("_month").isNotNull() & F.col("_cur_year").isNotNull()
    )
    return months.select(
        *series,
        row_no,
        format_date(F.lpad(F.col("_cur_year").cast("string"), 4, "0"), F.col("_month")).alias("date"),
        F.col("_amount").alias("export_amount"),
    )


def parse_and_aggregate(
    raw: DataFrame,
    series: Series | None = None,
    row_no: str = "row_no",
    period: str = "period_raw",
    amount: str = "export_amount",
    chunk: str | None = None,
    head_rows: int = 0,
    fallback_head_rows: int | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Parse, then sum per (series, date).  Output: ``*series, date, export_amount``.

    The raw rows are read once and shuffled once, by segment: inside a segment
    each month row takes the last year above it, or none yet; sums per
    (segment, year or none, month) are small, and only they wait for the year
    that earlier segments hand down (a window over them).  Rows that may be
    header lines (the first of a segment) are kept apart until the number of
    rows before the segment is known.  Amounts given as plain text are summed as
    decimals, others as order-free sums: totals do not depend on row order.
    """
    series = as_list(series)
    require_columns(raw, [row_no, period, amount, *series])
    text = strip_text(F.col(period))
    dtype = raw.schema[amount].dataType
    exact, approx = amount_parts(F.col(amount), dtype)
    staged = raw.select(
        *series,
        F.col(row_no).alias("_row"),
        _segment(row_no, chunk, chunk_rows).alias("_seg"),
        parse_year(text).cast("int").alias("_year"),
        parse_month(text).alias("_month"),
        exact.alias("_exact"),
        approx.alias("_approx"),
    )
    maybe = max(head_rows, fallback_head_rows or 0)
    w = Window.partitionBy(*series, "_seg").orderBy("_row")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if maybe:
        staged = staged.withColumn("_pos", F.least(F.row_number().over(w), F.lit(maybe + 1)))
    else:
        staged = staged.withColumn("_pos", F.lit(1))
    late = F.when(F.col("_pos") > maybe, F.col("_year"))
    filled = staged.withColumns(
        {
            "_cur": F.last(late, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_tail": F.last(late, ignorenulls=True).over(whole),
            "_early": F.when(F.col("_pos") <= maybe, F.col("_year")),
            "_m": F.when(F.col("_year").isNull(), F.col("_month")),
        }
    )

    inexact = F.lit(0.0) if isinstance(dtype, DecimalType) else order_free_sum(F.col("_approx"))
    small = filled.groupBy(*series, "_seg", "_pos", "_tail", "_early", "_cur", "_m").agg(
        F.sum("_exact").alias("_exact"), inexact.alias("_approx"), F.count(F.lit(1)).alias("_c")
    )
    source = Window.partitionBy(*(series or [F.lit(0)]))
    upto = source.orderBy("_seg").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    segment = Window.partitionBy(*(series or [F.lit(0)]), "_seg")
    if maybe:
        before = F.sum("_c").over(upto) - F.sum("_c").over(segment)
        small = small.withColumn("_line", before + F.col("_pos")).withColumn("_total", F.sum("_c").over(source))
        header = (F.col("_pos") <= maybe) & (F.col("_line") <= _header_lines(F.col("_total"), head_rows, fallback_head_rows))
        small = small.withColumn("_header", header)
    else:
        small = small.withColumn("_header", F.lit(False))
    # Within a source: segment by segment, first its possible header lines, then the rest.
    small = small.withColumn("_at", F.dense_rank().over(source.orderBy("_seg")).cast("long") * (maybe + 2) + F.col("_pos"))
    handed = F.when(F.col("_pos") > maybe, F.col("_tail")).when(~F.col("_header"), F.col("_early"))
    earlier = source.orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("_y", F.coalesce("_cur", F.last(handed, ignorenulls=True).over(earlier)))
    dated = small.where("_m IS NOT NULL AND _y IS NOT NULL AND NOT _header")
    date = format_date(F.lpad(F.col("_y").cast("string"), 4, "0"), F.col("_m")).alias("date")
    total = F.coalesce(F.sum("_exact"), F.lit(0)).cast("double") + inexact
    return dated.groupBy(*series, date).agg(total.alias("export_amount"))


def process_trade_data(
    raw: DataFrame,
    series: Series | None = None,
    row_no: str = "row_no",
    period: str = "period_raw",
    amount: str = "export_amount",
    chunk: str | None = None,
    strict: bool = True,
    head_rows: int = 0,
    fallback_head_rows: int | None = None,
) -> DataFrame:
    """C1 -> V1 (strict: a bad row fails the job, as in the reference) ->
    W4 -> P2.  Output: ``*series, date, export_amount, export_mom, export_yoy``."""
    from tradelens.operators.validate import TRADE_RECORD_RULES, enforce_rules

    series = as_list(series)
    monthly = parse_and_aggregate(raw, series, row_no, period, amount, chunk, head_rows, fallback_head_rows)
    if strict:
        monthly = enforce_rules(monthly, TRADE_RECORD_RULES)
    return monthly_growth(monthly, series).select(*series, *MONTHLY_COLUMNS)
