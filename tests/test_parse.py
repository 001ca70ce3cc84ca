from pyspark.sql import Window
from pyspark.sql import functions as F

from tradelens.operators.parse import forward_fill, parse_and_aggregate, parse_period_rows, process_trade_data, select_positional
from tradelens.operators.validate import process_trade_data_safe

from conftest import rows

RAW = "row_no long, period_raw string, export_amount double"


def raw(spark, items, series="s"):
    return spark.createDataFrame([(series, i, p, a) for i, (p, a) in enumerate(items)], "series string, " + RAW)


def test_basic(spark):
    out = parse_and_aggregate(raw(spark, [("2024년", None), ("01월", 100.0), ("02월", 150.0)]), ["series"])
    assert rows(out, "date", "export_amount") == [("2024-01", 100.0), ("2024-02", 150.0)]


def test_duplicates_summed(spark):
    out = parse_and_aggregate(raw(spark, [("2024년", None), ("01월", 50.0), ("01월", 50.0), ("02월", 100.0)]), ["series"])
    assert rows(out, "date", "export_amount") == [("2024-01", 100.0), ("2024-02", 100.0)]


def test_two_years_with_rates(spark):
    items = [("2023년", 999.0), ("01월", 100.0), ("02월", 110.0), ("2024년", 5.0), ("01월", 150.0)]
    out = process_trade_data(raw(spark, items), ["series"])
    assert rows(out, "date", "export_amount", "export_mom", "export_yoy") == [
        ("2023-01", 100.0, None, None),
        ("2023-02", 110.0, 10.0, None),
        ("2024-01", 150.0, 36.36, 50.0),
    ]


def test_unsorted_months(spark):
    out = parse_and_aggregate(raw(spark, [("2024년", None), ("03월", 300.0), ("01월", 100.0), ("02월", 200.0)]), ["series"])
    assert rows(out, "date") == [("2024-01",), ("2024-02",), ("2024-03",)]


def test_empty_keeps_columns(spark):
    out = process_trade_data(spark.createDataFrame([], "series string, " + RAW), ["series"])
    assert out.columns == ["series", "date", "export_amount", "export_mom", "export_yoy"] and out.count() == 0


def test_markers_notes_and_orphans(spark):
    items = [("01월", 7.0), ("2024년 합계", 1.0), ("1월", 10.0), (" 2월 ", 20.0), ("총계", 30.0), ("비고", 1.0)]
    out = parse_and_aggregate(raw(spark, items), ["series"])
    assert rows(out, "date", "export_amount") == [("2024-01", 10.0), ("2024-02", 20.0)]


def test_wide_positional(spark):
    wide = spark.createDataFrame(
        [("2023년", None, 1.0), ("01월", 100.0, 2.0), ("02월", 200.0, 3.0), ("2024년", None, 4.0), ("01월", 150.0, 5.0), ("02월", 220.0, 6.0)],
        "period string, exp_amt double, imp_amt double",
    )
    from pyspark.sql import functions as F

    two = select_positional(wide).withColumn("row_no", F.monotonically_increasing_id())
    out = process_trade_data(two)
    got = rows(out, "date", "export_mom", "export_yoy")
    assert got == [("2023-01", None, None), ("2023-02", 100.0, None), ("2024-01", -25.0, 50.0), ("2024-02", 46.67, 10.0)]


def test_series_do_not_share_years(spark):
    a = raw(spark, [("2023년", None), ("01월", 1.0)], "a")
    b = raw(spark, [("01월", 5.0), ("2024년", None), ("02월", 2.0)], "b")
    out = parse_and_aggregate(a.unionByName(b), ["series"])
    assert rows(out, "series", "date") == [("a", "2023-01"), ("b", "2024-02")]


def test_forward_fill_across_segments(spark):
    # Tiny segments force the carry-in path: the year set in segment 0 must
    # reach rows of segments 1..3, and a new year in segment 2 takes over.
    data = [("s", i, v) for i, v in enumerate(["2020", None, None, None, None, None, "2021", None, None, None])]
    df = spark.createDataFrame(data, "p string, o long, v string")
    out = forward_fill(df, "v", ["p"], "o", "filled", chunk_rows=2)
    assert [r.filled for r in out.orderBy("o").collect()] == ["2020"] * 6 + ["2021"] * 4


def test_safe_pipeline_routes_bad_rows(spark):
    items = [("2024년", None), ("01월", 100.0), ("02월", -500.0), ("03월", 120.0)]
    out = process_trade_data_safe(raw(spark, items), ["series"])
    assert out.valid.count() == 0  # no rate reaches across the bad month
    other = "another month of the series is invalid"
    assert rows(out.rejects, "date", "reason") == [
        ("2024-01", other), ("2024-02", "export_amount must be a finite number >= 0"), ("2024-03", other)
    ]


def test_strict_pipeline_fails_on_bad_row(spark):
    import pytest

    items = [("2024년", None), ("01월", -1.0)]
    with pytest.raises(Exception, match="Invalid data at row"):
        process_trade_data(raw(spark, items), ["series"]).collect()


def test_forward_fill_equals_plain_window_on_random_input(spark):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rnd = random.Random(3)
    data = []
    for series, n in (("hot", 5000), ("cold", 300)):
        for i in range(n):
            data.append((series, i, rnd.randint(1990, 2030) if rnd.random() < 0.03 else None))
    df = spark.createDataFrame(data, "p string, o long, v int").repartition(5)
    seg = forward_fill(df, "v", ["p"], "o", "filled", chunk_rows=37)
    w = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    assert seg.count() == len(data)
    assert seg.select("p", "o", "v", "filled").exceptAll(plain.select("p", "o", "v", "filled")).count() == 0


def test_totals_equal_row_level_parse_and_read_once(spark):
    """C1's small carry equals summing the row-level fill, for any segment size."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(7)
    raw = []
    for s in "ab":
        for n in range(400):
            kind = rng.random()
            period = f"{rng.randint(2000, 2020)}년" if kind < 0.1 else f"{rng.randint(1, 12)}월" if kind < 0.9 else "총계"
            raw.append((s, n, period, rng.choice(["1.25", " 7 ", "1e2", "x", "0.10", "1_000"])))
    df = spark.createDataFrame(raw, "series string, row_no long, period_raw string, export_amount string").repartition(5)
    want = parse_period_rows(df, ["series"]).groupBy("series", "date").agg(F.round(F.sum("export_amount"), 2).alias("a"))
    for chunk_rows in (1, 7, 1000):
        got = parse_and_aggregate(df, ["series"], chunk_rows=chunk_rows)
        assert rows(got) == rows(want)
    plan = parse_and_aggregate(df, ["series"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_text_sums_do_not_depend_on_row_order(spark):
    raw = [("s", 0, "2024년", "0")] + [("s", i, "1월", f"{i * 7919 % 100_003}.{i % 100:02d}") for i in range(1, 20_001)]
    schema = "series string, row_no long, period_raw string, export_amount string"
    exact = sum(int(a.replace(".", "")) for _, _, p, a in raw if p == "1월") / 100
    for parts in (1, 7):
        df = spark.createDataFrame(raw, schema).repartition(parts)
        assert rows(parse_and_aggregate(df, ["series"], chunk_rows=1000)) == [("s", "2024-01", exact)]


def header_case(rng, lines, head):
    """Report lines with header lines that look like data, as (period, amount)."""
    return [(rng.choice(["2019년", "03월", "제목"]), "9") for _ in range(head)] + lines


def test_headers_across_segments(spark):
    """The header is the file's first lines, whatever the segments are."""
    import random

    rng = random.Random(5)
    files, want = [], {}
    for f in range(12):
        body = [] if f == 0 else [("2024년", "0")] * (f % 3) + [(f"{rng.randint(1, 12)}월", str(rng.randint(1, 99))) for _ in range(rng.randint(1, 40))]
        short = f in (0, 1)
        lines = body[:3] if short else header_case(rng, body, 4)
        files += [(f"f{f}", i, p, a) for i, (p, a) in enumerate(lines)]
        kept, year = (lines[1:] if len(lines) <= 4 else lines[4:]), None
        for p, a in kept:
            if p.endswith("년"):
                year = p[:4]
            elif p.endswith("월") and year:
                key = (f"f{f}", f"{year}-{int(p[:-1]):02d}")
                want[key] = want.get(key, 0.0) + float(a)
    df = spark.createDataFrame(files, "series string, row_no long, period_raw string, export_amount string").repartition(3)
    for chunk_rows in (1, 2, 3, 5, 1000):
        kw = dict(head_rows=4, fallback_head_rows=1)
        got = parse_and_aggregate(df, ["series"], chunk_rows=chunk_rows, **kw)
        assert {(r.series, r.date): r.export_amount for r in got.collect()} == want, chunk_rows
        level = forward_fill(df, "period_raw", ["series"], "row_no", "x", chunk_rows=chunk_rows, **kw)
        heads = {r.series: r.n for r in level.groupBy("series").agg(F.min("row_no").alias("n")).collect()}
        sizes = {s: sum(x[0] == s for x in files) for s in {x[0] for x in files}}
        assert heads == {s: (1 if n <= 4 else 4) for s, n in sizes.items() if n > (1 if n <= 4 else 4)}


def test_fill_with_headers_equals_plain_window(spark):
    import random

    rnd = random.Random(8)
    data = [(s, i, rnd.randint(1, 9) if rnd.random() < 0.4 else None) for s in "ab" for i in range(60)]
    df = spark.createDataFrame(data, "p string, o long, v int").repartition(3)
    w = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.where("o >= 4").withColumn("filled", F.last("v", ignorenulls=True).over(w))
    for chunk_rows in (1, 2, 3, 7, 100):
        seg = forward_fill(df, "v", ["p"], "o", "filled", chunk_rows=chunk_rows, head_rows=4)
        assert rows(seg) == rows(plain), chunk_rows


def test_parse_period_rows_reads_its_input_once(spark, tmp_path):
    lines = [("s", i, p, "1") for i, p in enumerate(["2024년", "1월", "2월"])]
    spark.createDataFrame(lines, "series string, row_no long, period_raw string, export_amount string").write.parquet(str(tmp_path / "t"))
    out = parse_period_rows(spark.read.parquet(str(tmp_path / "t")), ["series"])
    assert len(out.collect()) == 2
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The second branch reads the first one's shuffle.
    assert (plan.count("FileScan parquet"), plan.count("ReusedExchange")) == (1, 1), plan


def test_double_sums_do_not_depend_on_partitions(spark):
    import math
    import random

    from tradelens.operators.aggregate import aggregate_by_date, aggregate_by_quarter

    rng = random.Random(6)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 25) for _ in range(4000)] + [0.1] * 1000 + [float("nan"), None]
    data = [("2024-0%d" % (i % 3 + 1), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "date string, export_amount double")
    results = set()
    for n in (2, 200):
        shuffled = df.repartition(n, F.rand(n))
        months = tuple(rows(aggregate_by_date(shuffled)))
        results.add((months, tuple(rows(aggregate_by_quarter(shuffled)))))
    assert len(results) == 1
    for date, total in months:
        exact = math.fsum(v for d, v in data if d == date and v is not None and v == v)
        assert math.isclose(total, exact, rel_tol=1e-15)


def test_sums_of_infinities_and_huge_amounts(spark):
    from tradelens.operators.aggregate import aggregate_by_date

    data = [("a", 1e300), ("a", 1.0), ("b", float("inf")), ("b", 2.0), ("c", float("inf")), ("c", float("-inf")), ("d", None)]
    got = dict(rows(aggregate_by_date(spark.createDataFrame(data, "date string, export_amount double"))))
    assert got["a"] == 1e300 and got["b"] == float("inf") and got["c"] != got["c"] and got["d"] == 0.0
