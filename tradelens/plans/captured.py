"""Markup rows for the contract queries of the page extractors.

The given ``pages`` hold neither result grids nor option lists, so the two
queries derive such markup from line items and suppliers, one page per line item
or per hundred suppliers.  Nothing in the library reads this module but the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.operators.pages import GRID_COLUMNS, GRID_ID
from tradelens.sources.tables import hs_code_of, load


def grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, html``: one result-grid row per line item."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"
    )
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = li.join(p, "l_partkey").join(s, "l_suppkey").join(n, "n_nationkey")
    # The markup of an order's lines is made and read in one place; a table in
    # one row group would otherwise leave all of it to one task.
    rows = rows.repartition("l_orderkey")
    values = [
        F.col("l_linenumber").cast("string"),
        F.concat(F.lit("["), hs_code_of("l_partkey"), F.lit("] "), F.col("p_name")),
        F.col("n_name"),
        F.format_number("l_extendedprice", 2),
        F.format_number("l_quantity", 2),
        F.format_number(F.floor(F.col("l_extendedprice") * F.col("l_discount")), 0),
        F.lit("0"),
    ]
    cells = [F.concat(F.lit(f'<td aria-describedby="{GRID_ID}_{c}"><b>'), v, F.lit("</b></td>")) for c, v in zip(GRID_COLUMNS, values, strict=True)]
    html = F.concat(F.lit(f'<table id="{GRID_ID}"><tr class="jqgrow">'), *cells, F.lit("</tr></table>"))
    return rows.select(F.col("l_orderkey").cast("long").alias("page_id"), html.alias("html"))


#: Suppliers on one page of the office list.
OPTION_PAGE_SIZE = 100

# The list that every filter page has beside its offices.
LEVEL_SELECT = (
    '<select id="LOCATION_TYPE" name="LOCATION_TYPE"><option value="">선택하세요.</option>'
    '<option value="A">시 선택</option><option value="B">시군구 선택</option></select>'
)


def _escaped(c: str) -> F.Column:
    out = F.col(c)
    for char, entity in {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"}.items():
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def option_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, html``: filter pages of ``OPTION_PAGE_SIZE`` supplier keys
    each, one ``<optgroup>`` per nation, and the level list on every page."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # A supplier without a nation has no option, but its page has the level list.
    rows = s.withColumn("page_id", F.floor(F.col("s_suppkey") / OPTION_PAGE_SIZE)).join(n, "n_nationkey", "left")
    option = F.concat(F.lit('<option value="'), F.col("s_suppkey").cast("string"), F.lit('">'), _escaped("s_name"), F.lit("</option>"))
    listed = F.struct("s_suppkey", F.when(F.col("n_name").isNotNull(), option).alias("option"))
    groups = rows.groupBy("page_id", "n_name").agg(F.array_join(F.array_sort(F.collect_list(listed))["option"], "").alias("options"))
    group = F.concat(F.lit('<optgroup label="'), _escaped("n_name"), F.lit('">'), F.col("options"), F.lit("</optgroup>"))
    pages = groups.groupBy("page_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("n_name", group.alias("group"))))["group"], "").alias("groups")
    )
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.concat(F.lit("https://trade.example/filter?page="), F.col("page_id").cast("string")).alias("url"),
        F.concat(
            F.lit(f'<html><body>{LEVEL_SELECT}<select id="Select2" name="Select2" multiple="multiple">'),
            F.col("groups"),
            F.lit("</select></body></html>"),
        ).alias("html"),
    )
