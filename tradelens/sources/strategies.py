"""Strategy configs -> item dimension.

A strategy document (JSON, the same nesting as the reference's TOML)::

    {"corp": {"name": "...",
              "items": [{"name": "...", "hs_code": "3304991000",
                         "filters": [{"category": "국내지역", "scope": "시",
                                      "values": ["부산"]}]}]}}

is flattened with ``explode`` into one row per item:
``strategy, item, hs_code, filters ARRAY<STRUCT<category, scope, values>>``.
Validation runs in the same pass: a strategy with any invalid item, or with
no items, goes to the rejects side as a whole (the reference rejects the
whole strategy); filters with an unknown category are dropped from the item
(as the reference does) and listed in the rejects with their reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tradelens.operators.select import CUSTOMS_CATEGORY, REGION_CATEGORY, REGION_SCOPES
from tradelens.operators.validate import Outcome

FILTER_TYPE = StructType(
    [
        StructField("category", StringType()),
        StructField("scope", StringType()),
        StructField("values", ArrayType(StringType())),
    ]
)
ITEM_TYPE = StructType(
    [
        StructField("name", StringType()),
        StructField("hs_code", StringType()),
        StructField("filters", ArrayType(FILTER_TYPE)),
    ]
)
STRATEGY_SCHEMA = StructType(
    [StructField("corp", StructType([StructField("name", StringType()), StructField("items", ArrayType(ITEM_TYPE))]))]
)
FLAT_STRATEGY_SCHEMA = StructType(
    [StructField("name", StringType()), StructField("items", ArrayType(ITEM_TYPE))]
)

HS_CODE_PATTERN = r"^[0-9]{10}$"
KNOWN_CATEGORIES = (REGION_CATEGORY, CUSTOMS_CATEGORY)


def read_strategies(spark: SparkSession, path: str) -> DataFrame:
    """Read strategy documents (one JSON document per file) with an
    explicit schema -> ``(name, items)`` per strategy."""
    docs = spark.read.schema(STRATEGY_SCHEMA).json(path, multiLine=True)
    return docs.select("corp.name", "corp.items")


def strategies_from_dicts(spark: SparkSession, docs: list[dict]) -> DataFrame:
    """In-memory strategy dicts (``{"corp": {...}}``) -> ``(name, items)``."""
    rows = [(d.get("corp", {}).get("name"), d.get("corp", {}).get("items")) for d in docs]
    return spark.createDataFrame(rows, FLAT_STRATEGY_SCHEMA)


def _filter_reasons(f) -> F.Column:
    cat = f["category"]
    n_values = F.coalesce(F.size(f["values"]), F.lit(0))
    return F.array_compact(
        F.array(
            F.when(
                (cat == REGION_CATEGORY) & ~F.coalesce(f["scope"].isin(*REGION_SCOPES), F.lit(False)),
                F.lit("region filter scope must be one of 시, 시군구"),
            ),
            F.when(cat.isin(*KNOWN_CATEGORIES) & (n_values < 1), F.lit("filter values must not be empty")),
        )
    )


def flatten_strategies(strategies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(name, items)`` documents -> item rows ``strategy, item, hs_code,
    all_filters`` and the rejects of strategies without items."""
    s = strategies.select(F.col("name").alias("strategy"), F.col("items"))
    no_items = s.where(F.coalesce(F.size("items"), F.lit(0)) < 1).select(
        "strategy",
        F.lit(None).cast("string").alias("item"),
        F.lit(None).cast("string").alias("hs_code"),
        F.lit("strategy must have at least one item").alias("reason"),
    )
    items = s.select("strategy", F.explode("items").alias("it")).select(
        "strategy",
        F.col("it.name").alias("item"),
        F.col("it.hs_code").alias("hs_code"),
        F.col("it.filters").alias("filters"),
    )
    return items, no_items


def strategy_items(strategies: DataFrame) -> Outcome:
    """S8 + V5 on strategy documents ``(name, items)``; see ``validate_items``."""
    items, no_items = flatten_strategies(strategies)
    out = validate_items(items)
    return Outcome(out.valid, no_items.unionByName(out.rejects))


def validate_items(items: DataFrame) -> Outcome:
    """V5 on flat item rows ``strategy, item, hs_code, filters``.

    Valid: ``strategy, item, hs_code, filters`` (known filter categories only).
    Rejects: ``strategy, item, hs_code, reason`` — every item of a strategy
    with a bad item; ignored filters are listed with reason ``unknown filter
    category: ...`` and do not reject their strategy.
    """
    items = items.select(
        "strategy",
        "item",
        "hs_code",
        F.coalesce(F.col("filters"), F.array().cast(ArrayType(FILTER_TYPE))).alias("all_filters"),
    )
    known = F.filter("all_filters", lambda f: f["category"].isin(*KNOWN_CATEGORIES))
    unknown = F.filter("all_filters", lambda f: ~F.coalesce(f["category"].isin(*KNOWN_CATEGORIES), F.lit(False)))
    filter_reasons = F.flatten(F.transform(known, _filter_reasons))
    item_reasons = F.array_compact(
        F.array(
            F.when(F.col("strategy").isNull(), F.lit("strategy name is required")),
            F.when(F.col("item").isNull(), F.lit("item name is required")),
            F.when(
                ~F.coalesce(F.col("hs_code").rlike(HS_CODE_PATTERN), F.lit(False)),
                F.lit("hs_code must be 10 digits"),
            ),
        )
    )
    # A repeated item would count its facts twice, and items of one name would
    # merge into one series: both are errors of their strategy.
    repeated = items.groupBy("strategy", "item").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    items = items.join(repeated, ["strategy", "item"], "left")
    again = F.array_compact(F.array(F.when(F.col("_times") > 1, F.lit("the strategy has the item more than once"))))
    tagged = items.withColumn("filters", known).withColumn(
        "reasons", F.concat(item_reasons, filter_reasons, again)
    ).withColumn("unknown", unknown).drop("_times")
    # A strategy is valid only if all of its items are.  The bad strategies
    # (a partial aggregate, at most one row per strategy) are joined: valid
    # items by an anti join, the other items of a bad strategy by a semi join.
    # No window over a strategy's items: one strategy may own most of them.
    has_reasons = F.size("reasons") > 0
    bad = tagged.where(has_reasons).select("strategy").distinct()
    clean = tagged.where(~has_reasons)
    valid = clean.join(bad, on="strategy", how="left_anti").select("strategy", "item", "hs_code", "filters")
    bad_items = (
        tagged.where(has_reasons)
        .select("strategy", "item", "hs_code", F.array_join("reasons", "; ").alias("reason"))
        .unionByName(
            clean.join(bad, on="strategy", how="left_semi").select(
                "strategy", "item", "hs_code", F.lit("another item of the strategy is invalid").alias("reason")
            )
        )
    )
    ignored = tagged.select(
        "strategy", "item", "hs_code", F.explode("unknown").alias("f")
    ).select(
        "strategy",
        "item",
        "hs_code",
        F.concat(F.lit("unknown filter category: "), F.coalesce(F.col("f.category"), F.lit("NULL"))).alias(
            "reason"
        ),
    )
    return Outcome(valid, bad_items.unionByName(ignored))


# defaults used when a scraper-style config omits fields (fixed value).
DEFAULT_HS_CODE = "8504230000"


def with_item_defaults(items: DataFrame) -> DataFrame:
    """default HS code, empty item and search text, and the file name
    suffix ``_<strategy>`` (empty without a name) for missing fields."""
    text = F.col("target_text") if "target_text" in items.columns else F.lit(None).cast("string")
    return items.withColumns(
        {
            "hs_code": F.coalesce(F.col("hs_code"), F.lit(DEFAULT_HS_CODE)),
            "item": F.coalesce(F.col("item"), F.lit("")),
            "target_text": F.coalesce(text, F.lit("")),
            "name_suffix": F.coalesce(F.concat(F.lit("_"), F.col("strategy")), F.lit("")),
        }
    )
