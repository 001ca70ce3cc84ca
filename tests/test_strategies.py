from pyspark.sql import functions as F

from tradelens.operators.select import filter_pairs, select_strategy_facts, strategy_totals
from tradelens.sources.strategies import strategies_from_dicts, strategy_items

from conftest import rows


def doc(name, items):
    return {"corp": {"name": name, "items": items}}


def item(name, code, filters=None):
    return {"name": name, "hs_code": code, "filters": filters or []}


def region(scope, values):
    return {"category": "국내지역", "scope": scope, "values": values}


def customs(values):
    return {"category": "세관", "scope": None, "values": values}


# Invented strategies: every filter shape, an item without filters, a code
# that two strategies share.
STRATEGIES = [
    doc("Bluefin", [item("nets", "1111111111", [region("시", ["Harbor"])])]),
    doc("Copperline", [item("coils", "2222222222", [customs(["Gate 3"])]), item("wire", "3333333333")]),
    doc("Dune", [item("glass", "4444444444", [region("시군구", ["Hill East"])])]),
    doc("Ember", [item("nets", "1111111111", [region("시", ["Plain", "Coast"])])]),
]


def test_valid_strategies_flatten(spark):
    out = strategy_items(strategies_from_dicts(spark, STRATEGIES))
    assert out.rejects.count() == 0
    got = rows(out.valid.select("strategy", "item", "hs_code", F.size("filters").alias("n")))
    assert ("Dune", "glass", "4444444444", 1) in got and ("Copperline", "wire", "3333333333", 0) in got
    assert len(got) == 5


def test_rejects(spark):
    bad = [
        doc("nine", [item("x", "123456789")]),
        doc("eleven", [item("x", "12345678901")]),
        doc("letter", [item("x", "12345678a0"), item("ok", "1234567890")]),
        doc("scope", [item("x", "1234567890", [region("도", ["x"])])]),
        doc("empty", [item("x", "1234567890", [region("시", [])])]),
        doc("empty_customs", [item("x", "1234567890", [customs([])])]),
        doc("no_items", []),
        doc("unknown_only", [item("x", "1234567890", [{"category": "기타", "scope": None, "values": ["v"]}])]),
    ]
    out = strategy_items(strategies_from_dicts(spark, bad))
    rej = rows(out.rejects, "strategy", "item", "reason")
    names = {r[0] for r in rej}
    assert names == {"nine", "eleven", "letter", "scope", "empty", "empty_customs", "no_items", "unknown_only"}
    assert ("letter", "ok", "another item of the strategy is invalid") in rej
    # An unknown filter category is dropped (and reported) but the item stays valid.
    assert rows(out.valid, "strategy", "item") == [("unknown_only", "x")]
    assert rows(out.valid.select(F.size("filters")), ) == [(0,)]


FACTS = [
    ("1111111111", "Harbor", "Harbor West", "Gate 1", "2024-01", 10.0),
    ("1111111111", "Hill", "Hill East", "Gate 2", "2024-01", 20.0),
    ("2222222222", "Plain", "Plain North", "Gate 3", "2024-01", 30.0),
    ("2222222222", "Coast", "Coast South", "Gate 1", "2024-01", 40.0),
    ("3333333333", "Harbor", "Harbor West", "Gate 1", "2024-02", 50.0),
    ("4444444444", "Hill", "Hill East", "Gate 2", "2024-02", 60.0),
    ("1111111111", "Coast", "Coast South", "Gate 3", "2024-03", 70.0),
]
FACT_SCHEMA = "hs_code string, city string, district string, office string, date string, export_amount double"


def test_selection_filters(spark):
    facts = spark.createDataFrame(FACTS, FACT_SCHEMA)
    items = strategy_items(strategies_from_dicts(spark, STRATEGIES)).valid
    want = [
        ("Bluefin", "nets", 10.0), ("Copperline", "coils", 30.0), ("Copperline", "wire", 50.0),
        ("Dune", "glass", 60.0), ("Ember", "nets", 70.0),
    ]
    assert rows(select_strategy_facts(facts, items), "strategy", "item", "export_amount") == want
    longer = facts.withColumn("city", F.concat("city", F.lit(" city")))
    contains = rows(select_strategy_facts(longer, items, match="contains"), "strategy", "export_amount")
    assert ("Bluefin", 10.0) in contains


def test_selection_without_broadcast_and_with_a_hot_code(spark):
    facts = spark.createDataFrame([FACTS[0]] * 400 + FACTS[1:], FACT_SCHEMA).repartition(6)
    items = strategy_items(strategies_from_dicts(spark, STRATEGIES)).valid
    total = lambda: rows(select_strategy_facts(facts, items).groupBy("strategy").agg(F.sum("export_amount")))
    with_broadcast = total()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = select_strategy_facts(facts, items)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and total() == with_broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert dict(with_broadcast)["Bluefin"] == 4000.0


def test_repeated_items_are_rejected(spark):
    twice = [doc("Twice", [item("x", "1234567890"), item("x", "1234567890")]), doc("Names", [item("y", "1111111111"), item("y", "2222222222")])]
    out = strategy_items(strategies_from_dicts(spark, twice))
    assert out.valid.count() == 0
    assert {r.reason for r in out.rejects.collect()} == {"the strategy has the item more than once"}


def test_strategy_json_round_trip(spark):
    from tradelens.operators.validate import from_json_rows, to_json_rows

    docs = strategies_from_dicts(spark, STRATEGIES)
    back = from_json_rows(to_json_rows(docs), docs.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))


def test_two_filter_kinds_on_one_column(spark):
    facts = spark.createDataFrame(
        [("1902301010", "부산", "2024-01", 1.0), ("1902301010", "서울", "2024-01", 2.0)],
        "hs_code string, place string, date string, export_amount double",
    )
    dims = {("국내지역", "시"): "place", ("국내지역", "시군구"): "place"}
    docs = [doc("s", [item("x", "1902301010", [region("시", ["부산", "서울"]), region("시군구", ["부산"])])])]
    items = strategy_items(strategies_from_dicts(spark, docs)).valid
    got = rows(select_strategy_facts(facts, items, dimensions=dims), "place")
    assert got == [("부산",)]  # both filters apply (AND)


def test_long_lists_equal_arrays(spark):
    """J7 by joins: every strategy, both match modes, with NULLs and empty lists."""
    facts = spark.createDataFrame(FACTS + [("1111111111", None, None, None, "2024-01", 1.0)], FACT_SCHEMA)
    items = strategy_items(strategies_from_dicts(spark, STRATEGIES)).valid
    for match in ("exact", "contains"):
        want = rows(select_strategy_facts(facts, items, match=match), "strategy", "item", "export_amount")
        assert want and rows(select_strategy_facts(facts, items, match=match, long_lists=True), "strategy", "item", "export_amount") == want


def test_a_list_of_100_000_values(spark):
    names = spark.range(200_000).select(F.format_string("Gate %d", "id").alias("office"))
    facts = names.selectExpr("'1111111111' AS hs_code", "'c' AS city", "'d' AS district", "office", "'2024-01' AS date", "1.0D AS export_amount")
    values = F.transform(F.sequence(F.lit(0), F.lit(99_999)), lambda i: F.format_string("Gate %d", i * 2))
    office = F.array(F.struct(F.lit("세관").alias("category"), F.lit(None).cast("string").alias("scope"), values.alias("values")))
    items = spark.range(1).select(F.lit("s").alias("strategy"), F.lit("x").alias("item"), F.lit("1111111111").alias("hs_code"), office.alias("filters"))
    got = rows(strategy_totals(facts, items, long_lists=True))
    assert got == [("s", "x", "2024-01", 100_000.0)]


def test_totals_tag_distinct_keys_only(spark):
    """A hot code's facts are summed before the items meet them."""
    facts = spark.createDataFrame([FACTS[0]] * 3000 + FACTS[1:], FACT_SCHEMA).repartition(5)
    items = strategy_items(strategies_from_dicts(spark, STRATEGIES)).valid
    out = strategy_totals(facts, items)
    want = rows(select_strategy_facts(facts, items).groupBy("strategy", "item", "date").agg(F.sum("export_amount")))
    assert rows(out) == want and ("Bluefin", "nets", "2024-01", 30000.0) in want
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    join = tree.index("Join Inner")
    assert "Aggregate [hs_code" in tree[join:]


def _many_items(spark, values, n=300):
    office = F.array(F.struct(F.lit("세관").alias("category"), F.lit(None).cast("string").alias("scope"), values.alias("values")))
    return spark.range(n).select(F.lit("s").alias("strategy"), F.format_string("x%d", "id").alias("item"), F.lit("1111111111").alias("hs_code"), office.alias("filters"))


def test_items_share_the_pairs_of_a_contained_value(spark):
    """The pairs grow with lists and names, not with items times names."""
    facts = spark.range(50).selectExpr("'1111111111' AS hs_code", "'c' AS city", "'d' AS district", "format_string('Gate %02d', id) AS office", "'2024-01' AS date", "1.0D AS export_amount")
    items = _many_items(spark, F.array(F.lpad((F.col("id") % 3).cast("string"), 2, "0")))
    pairs = filter_pairs(facts, items, match="contains")
    assert {c: p.count() for c, p in pairs.items()} == {"city": 0, "district": 0, "office": 3}
    got = rows(strategy_totals(facts, items, match="contains", long_lists=True), "item", "export_amount")
    assert got == sorted(((f"x{i}", 1.0) for i in range(300)), key=repr)


def test_items_share_the_pairs_of_a_list(spark):
    """Items with equal lists share their pairs; several lists on a column are met together."""
    facts = spark.range(50).selectExpr("'1111111111' AS hs_code", "'c' AS city", "'d' AS district", "format_string('Gate %02d', id) AS office", "'2024-01' AS date", "1.0D AS export_amount")
    items = _many_items(spark, F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.format_string("Gate %02d", i + F.col("id") % 2)))
    assert filter_pairs(facts, items)["office"].count() == 40
    twice = items.withColumn("filters", F.concat("filters", F.transform("filters", lambda f: f.withField("values", F.slice(f["values"], 3, 5)))))
    twice = twice.withColumn("filters", F.concat("filters", F.slice("filters", 1, 1)))
    for some in (items, twice):
        want = rows(strategy_totals(facts, some))
        assert len(want) == 300 and rows(strategy_totals(facts, some, long_lists=True)) == want


def test_long_lists_name_half_of_all_suppliers(spark, tmp_path):
    """Every item lists thirteen of the 25 nations' suppliers, and their facts are summed."""
    from tradelens.plans.contract import q_strategy_long_lists
    from tradelens.sources.tables import long_list_items

    tables = {
        "supplier": spark.range(50).selectExpr("id AS s_suppkey", "format_string('S%02d', id) AS s_name", "CAST(id % 25 AS int) AS s_nationkey"),
        "nation": spark.range(25).selectExpr("CAST(id AS int) AS n_nationkey", "format_string('N%d', id) AS n_name", "0 AS n_regionkey"),
        "region": spark.range(1).selectExpr("CAST(id AS int) AS r_regionkey", "'R' AS r_name"),
        "part": spark.range(30).selectExpr("id AS p_partkey", "'B' AS p_brand", "'p' AS p_name"),
        "lineitem": spark.range(1500).selectExpr(
            "id % 30 AS l_partkey", "id DIV 30 AS l_suppkey", "TIMESTAMP '2024-01-05' AS l_shipdate", "1.0D AS l_extendedprice"
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    lists = {r.item: r.names for r in long_list_items(spark, str(tmp_path)).selectExpr("item", "filters[0].values AS names").collect()}
    for p in range(30):
        assert lists[f"p #{p}"] == [f"S{k:02d}" for k in range(50) if (k % 25 + p) % 25 < 13]
    got = rows(q_strategy_long_lists(spark, str(tmp_path)))
    assert got == sorted((("B", f"p #{p}", "2024-01", 26.0) for p in range(30)), key=repr)
