"""Strategy item selection over a fact table.

A strategy item names a 10-digit HS code and a list of filters; each filter
restricts one dimension of the facts to a list of values:

- ``국내지역`` (domestic region) with scope ``시`` (city level) or ``시군구``
  (district level),
- ``세관`` (customs office).

Several values in one filter are OR-ed; several filters are AND-ed.  Every
item becomes one series.

- ``strategy_totals`` sums facts per code, region, office and date *before* items
  tag them: what meets the items are distinct keys, not raw facts, however many
  facts a hot code has.
- ``select_strategy_facts`` joins facts and items on ``hs_code`` and tests each
  row against its item's filters, which ride on the row as arrays.
- ``long_lists=True`` keeps value lists off the fact rows: each different list is
  resolved once, however many items have it, and rows meet the resulting
  (list, value) pairs by joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.operators._common import require_columns

# Filter categories and region scopes as written in strategy
# configs (must equal the reference's labels).
REGION_CATEGORY = "국내지역"
CUSTOMS_CATEGORY = "세관"
CITY_SCOPE = "시"
DISTRICT_SCOPE = "시군구"
REGION_SCOPES = (CITY_SCOPE, DISTRICT_SCOPE)

# Default mapping of filter (category, scope) to fact columns.
DEFAULT_DIMENSIONS = {
    (REGION_CATEGORY, CITY_SCOPE): "city",
    (REGION_CATEGORY, DISTRICT_SCOPE): "district",
    (CUSTOMS_CATEGORY, None): "office",
}


def _matches(values: Column, target: Column, match: str) -> Column:
    if match == "exact":
        return F.array_contains(values, target)
    if match == "contains":
        return F.exists(values, lambda v: F.contains(target, v))
    raise ValueError(f"unknown match mode: {match!r}")


def filter_predicate(f: Column, dimensions: dict | None = None, match: str = "exact") -> Column:
    """Boolean for one filter struct ``f`` (category, scope, values) on the
    current fact row.  Unknown categories do not restrict (the reference only
    logs them)."""
    dims = dimensions or DEFAULT_DIMENSIONS
    expr = None
    for (category, scope), column in dims.items():
        cond = f["category"] == F.lit(category)
        if scope is not None:
            cond = cond & (f["scope"] == F.lit(scope))
        hit = _matches(f["values"], F.col(column), match)
        expr = F.when(cond, hit) if expr is None else expr.when(cond, hit)
    return F.coalesce(expr.otherwise(F.lit(True)), F.lit(False))


def _allowed_values(filters: Column, category: str, scope: str | None) -> Column:
    """Values allowed by all filters of one (category, scope) of an item:
    the intersection of their value lists (AND of ORs), or NULL when the
    item has no such filter (no restriction)."""
    def hit(f):
        cond = f["category"] == F.lit(category)
        return cond & (f["scope"] == F.lit(scope)) if scope is not None else cond

    lists = F.transform(F.filter(filters, hit), lambda f: F.coalesce(f["values"], F.array().cast("array<string>")))
    merged = F.aggregate(F.slice(lists, 2, 1 << 30), F.try_element_at(lists, F.lit(1)), lambda acc, x: F.array_intersect(acc, x))
    return F.when(F.size(lists) > 0, merged)


def _substrings(value: Column) -> Column:
    """All different non-empty substrings of a (short) name."""
    n = F.length(value)
    of = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substring(value, i, k)))
    return F.when(n > 0, F.array_distinct(F.flatten(of))).otherwise(F.array())


def _list_id(values: Column) -> Column:
    """128 bits of a value list: equal lists share it, wherever they stand."""
    return F.struct(F.xxhash64(values).alias("a"), F.xxhash64(F.lit(1), values).alias("b"))


def _on_column(f: Column, dims: dict, column: str) -> Column:
    """Whether filter ``f`` is on the fact column."""
    hit = F.lit(False)
    for (category, scope), target in dims.items():
        if target == column:
            kind = f["category"] == category
            hit = hit | (kind & (f["scope"] == scope) if scope is not None else kind)
    return F.coalesce(hit, F.lit(False))


def _list_keys(items: DataFrame, dims: dict) -> DataFrame:
    """``strategy, item, hs_code`` and, per fact column, ``_ids_i`` (ids of the
    lists that filter it) with ``_a_i, _b_i``, the key of these lists together:
    the id of a single list, else a hash of the ids.  ``_b_i`` is NULL where
    nothing filters the column; ``_a_i`` then spreads the rows."""
    keys = ["strategy", "item", "hs_code"]
    ids = {}
    for i, column in enumerate(sorted(set(dims.values()))):
        # A list is read here, once, and goes no further.
        on = F.filter(F.coalesce(F.col("filters"), F.array()), lambda f: _on_column(f, dims, column))
        several = F.array_sort(F.array_distinct(F.transform(on, lambda f: _list_id(f["values"]))))
        # A single list, the usual case, is hashed outside the (interpreted) lambda.
        single = F.array(_list_id(F.get(on, F.lit(0))["values"]))
        ids[f"_ids_{i}"] = F.when(F.size(on) == 1, single).otherwise(several)
    out = items.select(*keys, *[v.alias(k) for k, v in ids.items()])
    for i, name in enumerate(ids):
        first = F.get(F.col(name), F.lit(0))
        whole = F.struct(F.xxhash64(name).alias("a"), F.xxhash64(F.lit(1), F.col(name)).alias("b"))
        key = {c: F.when(F.size(name) > 1, whole[c]).otherwise(first[c]) for c in "ab"}
        out = out.withColumns({f"_a_{i}": F.coalesce(key["a"], F.xxhash64(*keys)), f"_b_{i}": key["b"]})
    return out


def filter_pairs(facts: DataFrame, items: DataFrame, dimensions: dict | None = None, match: str = "exact") -> dict[str, DataFrame]:
    """J7 for value lists of any length: per fact column, the pairs
    ``_a, _b, <column>`` of the key of an item's lists on the column (see
    ``_list_keys``) and a value that all of them allow.

    Lists are resolved as lists, not item by item: items with the same lists
    share the pairs.  ``contains`` is a join with the distinct values of the
    facts: a filter value is in a name if it equals one of the name's substrings
    (an empty filter value is in every name).
    """
    dims = dimensions or DEFAULT_DIMENSIONS
    if match not in ("exact", "contains"):
        raise ValueError(f"unknown match mode: {match!r}")
    filters = items.select(F.explode("filters").alias("_f"))
    out = {}
    for i, column in enumerate(sorted(set(dims.values()))):
        lists = filters.where(_on_column(F.col("_f"), dims, column)).select(F.col("_f.values").alias("_values")).distinct()
        # The id is made before the values become rows, once a list.
        lists = lists.select(_list_id(F.col("_values")).alias("_id"), "_values")
        asked = lists.select(F.col("_id.a").alias("_a"), F.col("_id.b").alias("_b"), F.explode("_values").alias("_value"))
        if match == "exact":
            found = asked.where(F.col("_value").isNotNull()).withColumnRenamed("_value", column).distinct()
        else:
            names = facts.select(column).where(F.col(column).isNotNull()).distinct()
            parts = names.withColumn("_value", F.explode(F.concat(F.array(F.lit("")), _substrings(F.col(column)))))
            known = asked.select("_value").distinct()
            found = asked.join(parts.join(known, "_value"), "_value").select("_a", "_b", column).distinct()
        # Items with several lists on the column: all must allow the value.
        several = items.where(F.size(F.filter("filters", lambda f: _on_column(f, dims, column))) > 1)
        key, ids = [F.col(f"_a_{i}").alias("_key_a"), F.col(f"_b_{i}").alias("_key_b")], F.col(f"_ids_{i}")
        sets = _list_keys(several, dims).where(F.size(ids) > 1).select(*key, ids.alias("_ids")).distinct()
        sets = sets.select("_key_a", "_key_b", F.size("_ids").alias("_needed"), F.explode("_ids").alias("_id"))
        sets = sets.withColumns({"_a": F.col("_id.a"), "_b": F.col("_id.b")}).drop("_id")
        met = sets.join(found, ["_a", "_b"]).groupBy("_key_a", "_key_b", "_needed", column).agg(F.count(F.lit(1)).alias("_met"))
        out[column] = found.union(met.where("_met = _needed").select("_key_a", "_key_b", column))
    return out


def _select_by_pairs(facts: DataFrame, items: DataFrame, dims: dict, match: str) -> DataFrame:
    pairs = filter_pairs(facts, items, dims, match)
    keyed = _list_keys(items, dims)
    rows = facts.join(keyed.drop(*[f"_ids_{i}" for i in range(len(pairs))]), "hs_code")
    for i, (column, allowed) in enumerate(pairs.items()):
        ok = allowed.withColumnsRenamed({"_a": f"_a_{i}", "_b": f"_b_{i}"}).withColumn("_ok", F.lit(True))
        rows = rows.join(ok, [f"_a_{i}", f"_b_{i}", column], "left")
        rows = rows.where(F.col(f"_b_{i}").isNull() | F.col("_ok")).drop("_ok", f"_a_{i}", f"_b_{i}")
    return rows.select(*facts.columns, "strategy", "item")


def strategy_totals(
    facts: DataFrame,
    items: DataFrame,
    dimensions: dict | None = None,
    match: str = "exact",
    long_lists: bool = False,
    date: str = "date",
    value: str = "export_amount",
) -> DataFrame:
    """J6 + A1: ``strategy, item, date, value`` sums of every item's facts.

    Facts are summed per (``hs_code``, dimensions, ``date``) first, with map-side
    partial sums; items tag those sums only."""
    from tradelens.operators.aggregate import aggregate_by_date, sum_native

    dims = dimensions or DEFAULT_DIMENSIONS
    columns = sorted(set(dims.values()))
    require_columns(facts, ["hs_code", *columns, date, value], "facts")
    sums = facts.groupBy("hs_code", *columns, date).agg(sum_native(facts, value).alias(value))
    chosen = select_strategy_facts(sums, items, dims, match, long_lists)
    return aggregate_by_date(chosen, ["strategy", "item"], date, value)


def select_strategy_facts(
    facts: DataFrame,
    items: DataFrame,
    dimensions: dict | None = None,
    match: str = "exact",
    long_lists: bool = False,
) -> DataFrame:
    """J6 + J7 + J8 + J9: facts of every strategy item, tagged with
    ``strategy`` and ``item``.

    ``facts`` needs ``hs_code`` and the dimension columns; ``items`` needs
    ``strategy, item, hs_code, filters ARRAY<STRUCT<category, scope, values>>``
    (the output of ``sources.strategies.strategy_items``).
    """
    dims = dimensions or DEFAULT_DIMENSIONS
    require_columns(facts, ["hs_code", *sorted(set(dims.values()))], "facts")
    require_columns(items, ["strategy", "item", "hs_code", "filters"], "items")
    if long_lists:
        return _select_by_pairs(facts, items, dims, match)
    if match == "exact":
        # Reduce each item's filters to one allowed-values array per fact
        # column on the (small) item side; the per-fact-row test is then a
        # plain, code-generated ``array_contains`` per dimension.
        filters = F.coalesce(F.col("filters"), F.array())
        # One helper column per (category, scope), named by position: two
        # filter kinds may test the same fact column.
        dim_list = list(dims.items())
        allowed = {f"_ok_{i}": _allowed_values(filters, cat, scope) for i, ((cat, scope), _) in enumerate(dim_list)}
        prepared = items.select("strategy", "item", "hs_code", *[v.alias(k) for k, v in allowed.items()])
        joined = facts.join(prepared, on="hs_code", how="inner")
        keep = F.lit(True)
        for i, (_, col) in enumerate(dim_list):
            ok = F.col(f"_ok_{i}")
            keep = keep & (ok.isNull() | F.coalesce(F.array_contains(ok, F.col(col)), F.lit(False)))
        return joined.where(keep).drop(*allowed)
    dim_items = items.select("strategy", "item", "hs_code", "filters")
    joined = facts.join(dim_items, on="hs_code", how="inner")
    keep = F.forall(F.coalesce(F.col("filters"), F.array()), lambda f: filter_predicate(f, dims, match))
    return joined.where(keep).drop("filters")
