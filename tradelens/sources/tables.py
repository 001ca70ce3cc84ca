"""Trade facts derived from the given warehouse tables.

These builders bind the engine's data model to the TPC-H-like tables in a
folder (``orders``, ``lineitem``, ``part``, ``supplier``, ``nation``,
``region``).  Every derived table grows with its source tables; nothing is
sampled or capped.

- ``orders_facts``   series key + ``date`` (``YYYY-MM``) + exact money amount
- ``line_facts``     facts with the selection dimensions (HS code, city and
                     district level region, customs office)
- ``raw_report``     report-export rows (year markers, month rows split into
                     duplicates, note and total rows) rebuilt from orders
- ``part_strategy_items`` strategy items: one strategy per brand, one item
                     per part
- ``long_list_items``  items whose filters list many office names
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tradelens.sources.strategies import FILTER_TYPE


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_month(ts) -> F.Column:
    """``YYYY-MM`` of a timestamp/date from ``year``/``month`` (cheaper per
    row than a datetime formatter)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(
        F.lpad(F.year(c).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.month(c).cast("string"), 2, "0")
    )


def money(c) -> F.Column:
    """Money as DECIMAL(18,2): sums are exact and do not depend on row order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def orders_facts(spark: SparkSession, sf_dir: str, series: str = "o_orderpriority") -> DataFrame:
    """``series, date, export_amount`` per order (``series`` is a STRING)."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col(series).cast("string").alias("series"),
        year_month("o_orderdate").alias("date"),
        money("o_totalprice").alias("export_amount"),
    )


def hs_code_of(partkey) -> F.Column:
    """A part's 10-digit HS code: its key, zero-padded."""
    return F.lpad(F.col(partkey).cast("string"), 10, "0")


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hs_code, city, district, office, date, export_amount`` per line item.

    city = region name, district = nation name (of the supplier), office =
    supplier name.  How the dimensions are joined is left to the planner.
    """
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("district"), F.col("r_name").alias("city")
    )
    # Each dimension is joined on its own so its size estimate stays a plain
    # scan estimate (a pre-joined dimension is estimated as a product).
    sup = s.select("s_suppkey", F.col("s_name").alias("office"), "s_nationkey")
    return li.join(sup, li.l_suppkey == sup.s_suppkey).join(
        geo, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        hs_code_of("l_partkey").alias("hs_code"),
        "city",
        "district",
        "office",
        year_month("l_shipdate").alias("date"),
        money("l_extendedprice").alias("export_amount"),
    )


def raw_report(
    spark: SparkSession, sf_dir: str, series: str = "o_orderpriority", returns_over: int | None = None
) -> DataFrame:
    """Report-export rows per ``series`` (default: order priority):
    ``series, row_no, period_raw, export_amount`` (amount as text, with
    cents; pending orders above ``returns_over`` are booked negative).

    - ``YYYY년`` year row carrying the annual total (a decoy: it must be ignored)
    - one month row per (month, order status), so months repeat and must be
      summed; the month text varies (``1월``, ``01월``, `` 1월 ``) and so does
      the amount text (plain, padded, exponent form)
    - a ``비고`` note row per year with amount ``n/a`` and a final ``총계`` row
    """
    amt = money("o_totalprice")
    if returns_over is not None:
        amt = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > returns_over), -amt).otherwise(amt)
    o = load(spark, sf_dir, "orders").select(
        F.col(series).cast("string").alias("series"),
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        F.col("o_orderstatus").alias("st"),
        amt.alias("amt"),
    )
    months = o.groupBy("series", "y", "m", "st").agg(F.sum("amt").alias("amt"))
    # Within a month the rows follow the order status: F, O, then P.
    rank = F.when(F.col("st") == "F", 1).when(F.col("st") == "O", 2).otherwise(3)
    amt_text = F.col("amt").cast("string")
    month_rows = months.select(
        "series",
        (F.col("y") * 10000 + F.col("m") * 10 + rank).cast("long").alias("row_no"),
        F.when(F.col("st") == "F", F.concat(F.lpad(F.col("m").cast("string"), 2, "0"), F.lit("월")))
        .when(F.col("st") == "O", F.concat(F.col("m").cast("string"), F.lit("월")))
        .otherwise(F.concat(F.lit(" "), F.col("m").cast("string"), F.lit("월 ")))
        .alias("period_raw"),
        F.when(F.col("st") == "F", amt_text)
        .when(F.col("st") == "O", F.concat(F.lit("  "), amt_text, F.lit(" ")))
        .otherwise(F.concat(amt_text, F.lit("e0")))
        .alias("export_amount"),
    )
    # Year totals come from the (small) month rows.
    years = months.groupBy("series", "y").agg(F.sum("amt").alias("amt"))
    year_rows = years.select(
        "series",
        (F.col("y") * 10000).cast("long").alias("row_no"),
        F.concat(F.col("y").cast("string"), F.lit("년")).alias("period_raw"),
        F.col("amt").cast("string").alias("export_amount"),
    )
    note_rows = years.select(
        "series",
        (F.col("y") * 10000 + 9999).cast("long").alias("row_no"),
        F.lit("비고").alias("period_raw"),
        F.lit("n/a").alias("export_amount"),
    )
    totals = years.groupBy("series").agg(F.sum("amt").alias("amt")).select(
        "series",
        F.lit(99_999_999).cast("long").alias("row_no"),
        F.lit("총계").alias("period_raw"),
        F.col("amt").cast("string").alias("export_amount"),
    )
    return month_rows.unionByName(year_rows).unionByName(note_rows).unionByName(totals)


def _flt(category: str, scope: str | None, values: list[str]) -> F.Column:
    return F.struct(
        F.lit(category).alias("category"),
        F.lit(scope).cast("string").alias("scope"),
        F.array(*[F.lit(v) for v in values]).alias("values"),
    )


def supplier_names(first: int, count: int) -> list[str]:
    return [f"Supplier#{k:09d}" for k in range(first, first + count)]


def part_filters() -> F.Column:
    """Filters of a part's item by part type (one of each filter shape)."""
    t = F.col("p_type")
    empty = F.array().cast(ArrayType(FILTER_TYPE))
    return (
        F.when(t == "ECONOMY", F.array(_flt("국내지역", "시", ["ASIA", "EUROPE"])))
        .when(t == "SMALL", F.array(_flt("국내지역", "시군구", ["NATION_1", "NATION_7", "NATION_13", "NATION_19"])))
        .when(t == "LARGE", F.array(_flt("세관", None, supplier_names(0, 10))))
        .when(
            t == "MEDIUM",
            F.array(_flt("국내지역", "시", ["AFRICA", "AMERICA", "ASIA"]), _flt("세관", None, supplier_names(0, 30))),
        )
        .when(t == "PROMO", F.array(_flt("품목분류", None, ["ignored"])))
        .otherwise(empty)
        .cast(ArrayType(FILTER_TYPE))
    )


def part_strategy_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strategy items as flat rows ``strategy, item, hs_code, filters``: one
    strategy per brand, one item per part (``name #partkey``, HS code from
    the part key, filters by part type).  Flat on purpose: a brand may own a
    large share of all parts, so its items are never collected into one row."""
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_brand").alias("strategy"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("item"),
        hs_code_of("p_partkey").alias("hs_code"),
        part_filters().alias("filters"),
    )


def long_list_items(spark: SparkSession, sf_dir: str, prefix: bool = False) -> DataFrame:
    """Strategy items whose office filter lists all suppliers of thirteen nations
    of 25, half of all suppliers (the part's key says where the thirteen begin), or
    (``prefix``) two digits that are looked for in the suppliers' names."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    office = F.struct(F.lit("세관").alias("category"), F.lit(None).cast("string").alias("scope"), F.col("values"))
    filters = F.array(office).cast(ArrayType(FILTER_TYPE)).alias("filters")
    if prefix:
        digits = F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0")
        rows = p.withColumn("values", F.array(digits)).select("*", filters)
    else:
        # The filters are made once per list, before parts meet them.
        s = load(spark, sf_dir, "supplier").select("s_name", "s_nationkey", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("_list"))
        s = s.where((F.col("s_nationkey") + F.col("_list")) % 25 < 13).groupBy("_list")
        # Sorted: a list is the same whenever it is made.
        s = s.agg(F.sort_array(F.collect_list("s_name")).alias("values"))
        # Eight copies of each list: its parts are met in as many tasks.  Merged: a
        # filter is made once and read by its parts, not made again for each of them.
        copies = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.col("_list") + 25 * i)
        s = s.select(F.explode(copies).alias("_copy"), filters).hint("merge")
        # Parts of one row group would otherwise leave all their lists to one task.
        p = p.repartition("p_partkey")
        rows = p.join(s, F.col("p_partkey") % 200 == F.col("_copy"))
    return rows.select(
        F.col("p_brand").alias("strategy"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("item"),
        hs_code_of("p_partkey").alias("hs_code"),
        "filters",
    )
