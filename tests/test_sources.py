"""Readers, sinks, streaming runner and the full (strategy) verb."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from tradelens.operators.compose import pipe
from tradelens.sources.reports import latest_files, read_report_exports, read_report_lines
from tradelens.sources.sinks import convert_format
from tradelens.sources.strategies import read_strategies, strategy_items, with_item_defaults

from conftest import rows

HEADER = ["제목,,", "부제,,", "기간,수출,수입", ",금액,금액"]


def write_csv(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_reader_skips_header_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="tl-src-")
    write_csv(d, "full.csv", HEADER + ["2024년,5,0", "01월,100,0"])
    write_csv(d, "bare.csv", ["2024년,1", "02월,7"])  # no header rows at all
    got = rows(read_report_exports(spark, d, fallback_skip_rows=0).select(
        F.substring_index("source_file", "/", -1).alias("f"), "period_raw", "export_amount"))
    assert got == [("bare.csv", "02월", "7"), ("bare.csv", "2024년", "1"), ("full.csv", "01월", "100"), ("full.csv", "2024년", "5")]


def test_reader_keeps_file_order_across_splits(spark):
    # Small max partition bytes cut one file into many splits; the forward
    # fill must still carry each year into later splits.
    from tradelens.operators.parse import parse_and_aggregate

    d = tempfile.mkdtemp(prefix="tl-split-")
    lines = list(HEADER)
    for y in range(2000, 2024):
        lines.append(f"{y}년,0")
        lines += [f"{m:02d}월,{y * 100 + m}" for m in range(1, 13)]
    write_csv(d, "big.csv", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        raw = read_report_exports(spark, d)
        assert read_report_lines(spark, d).rdd.getNumPartitions() > 4
        out = parse_and_aggregate(raw, ["source_file"], chunk="block")
        got = {r.date: r.export_amount for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 24 * 12
    assert all(got[f"{y}-{m:02d}"] == float(y * 100 + m) for y in range(2000, 2024) for m in range(1, 13))


def test_latest_files(spark):
    d = tempfile.mkdtemp(prefix="tl-latest-")
    write_csv(os.path.join(d, "s1"), "old.csv", ["x"])
    time.sleep(1.1)
    write_csv(os.path.join(d, "s1"), "new.csv", ["x"])
    write_csv(os.path.join(d, "s2"), "only.csv", ["x"])
    got = {r.strategy: r.path.rsplit("/", 1)[-1] for r in latest_files(spark, d + "/*", group="strategy").collect()}
    assert got == {"s1": "new.csv", "s2": "only.csv"}
    assert latest_files(spark, d + "/*").collect()[0].path.endswith("only.csv")


def test_strategy_json_and_defaults(spark):
    d = tempfile.mkdtemp(prefix="tl-strat-")
    with open(os.path.join(d, "a.json"), "w", encoding="utf-8") as f:
        f.write('{"corp": {"name": "Bluefin", "items": [{"name": "nets", "hs_code": "1111111111",\n'
                ' "filters": [{"category": "국내지역", "scope": "시", "values": ["Harbor"]}]}]}}')
    out = strategy_items(read_strategies(spark, d))
    assert rows(out.valid, "strategy", "item", "hs_code") == [("Bluefin", "nets", "1111111111")]
    blank = spark.createDataFrame([("s", None, None)], "strategy string, item string, hs_code string")
    assert rows(with_item_defaults(blank), "strategy", "item", "hs_code") == [("s", "", "8504230000")]


def test_convert_format_keeps_source(spark):
    d = tempfile.mkdtemp(prefix="tl-conv-")
    write_csv(os.path.join(d, "in"), "a.csv", ["date,export_amount", "2024-01,1.5"])
    convert_format(spark, os.path.join(d, "in"), "csv", os.path.join(d, "out"), "parquet", header="true")
    assert os.path.exists(os.path.join(d, "in", "a.csv"))
    assert rows(spark.read.parquet(os.path.join(d, "out"))) == [("2024-01", "1.5")]


def test_pipe():
    assert pipe(5, lambda x: x + 1, lambda x: x * 2) == 12 and pipe(5) == 5


def test_streaming_report(spark):
    from tradelens.streaming import start_report_stream

    d = tempfile.mkdtemp(prefix="tl-stream-")
    src = os.path.join(d, "in")
    write_csv(src, "a.csv", HEADER + ["2023년,0", "01월,100", "2024년,0", "01월,150"])
    q = start_report_stream(spark, src, os.path.join(d, "out"), os.path.join(d, "ckpt"), 2024, 2024, available_now=True)
    q.awaitTermination(120)
    write_csv(src, "b.csv", HEADER + ["2024년,0", "02월,40"])
    q = start_report_stream(spark, src, os.path.join(d, "out"), os.path.join(d, "ckpt"), 2024, 2024, available_now=True)
    q.awaitTermination(120)
    m = spark.read.parquet(os.path.join(d, "out", "monthly"))
    got = sorted((r.source_file.rsplit("/", 1)[-1], r.date, r.export_amount, r.export_yoy) for r in m.collect())
    assert got == [("a.csv", "2024-01", 150.0, 50.0), ("b.csv", "2024-02", 40.0, None)]


def test_full_verb(spark):
    from tradelens.plans.verbs import full
    from tradelens.sources.strategies import strategies_from_dicts

    facts = spark.createDataFrame(
        [("1111111111", "Harbor", "Harbor West", "Gate 1", d, a) for d, a in (("2023-01", 10.0), ("2024-01", 20.0), ("2024-03", 30.0))]
        + [("1111111111", "Hill", "Hill East", "Gate 2", "2024-01", 99.0)],
        "hs_code string, city string, district string, office string, date string, export_amount double",
    )
    items = strategy_items(strategies_from_dicts(spark, [
        {"corp": {"name": "Bluefin", "items": [{"name": "nets", "hs_code": "1111111111",
                                            "filters": [{"category": "국내지역", "scope": "시", "values": ["Harbor"]}]}]}}
    ])).valid
    out = tempfile.mkdtemp(prefix="tl-full-")
    tables, dash = full(facts, items, out, 2024, 2024)
    assert rows(tables.monthly, "date", "export_amount", "export_yoy") == [("2024-01", 20.0, 100.0), ("2024-03", 30.0, None)]
    assert rows(tables.quarterly, "quarter", "export_amount", "export_yoy") == [("2024Q1", 50.0, 400.0)]
    assert dash.count() == 2
    assert spark.read.parquet(os.path.join(out, "report", "monthly")).where("strategy = 'Bluefin'").count() == 2
    titles = spark.read.option("header", True).csv(os.path.join(out, "dashboard")).select("title").distinct().collect()
    assert [r.title for r in titles] == ["Dashboard - Bluefin nets"]


def test_header_names_and_safe_reader(spark):
    from tradelens.sources.reports import read_report_exports_safe, read_report_header
    from tradelens.sources.records import records_to_dataframe

    d = tempfile.mkdtemp(prefix="tl-head-")
    write_csv(d, "a.csv", ["제목,,", "부제,,", "기간,수출,", ",금액,중량", "2024년,1,2"])
    names = sorted((r.col_idx, r.name) for r in read_report_header(spark, d).collect())
    assert names == [(0, "기간"), (1, "수출_금액"), (2, "수출_중량")]
    ok = read_report_exports_safe(spark, d)
    assert ok.rejects.count() == 0 and ok.valid.count() == 1
    missing = read_report_exports_safe(spark, os.path.join(d, "nope.csv"))
    assert missing.rejects.collect()[0].error.startswith("File not found:") and missing.valid.count() == 0
    empty = records_to_dataframe(spark, [], "date string, export_amount double")
    assert empty.columns == ["date", "export_amount"] and empty.count() == 0
    two = records_to_dataframe(spark, [{"date": "2024-01", "export_amount": 1.0}, {"date": "2024-02"}], "date string, export_amount double")
    assert rows(two) == [("2024-01", 1.0), ("2024-02", None)]


def test_one_pass_rows_ignore_year_like_title(spark):
    import contextlib
    import io

    from tradelens.operators.parse import parse_and_aggregate
    from tradelens.sources.reports import read_report_rows

    d = tempfile.mkdtemp(prefix="tl-onepass-")
    lines = ["2019년 수출 실적,,", "단위: 달러,,", "기간,수출,수입", ",금액,금액", "03월,999,0"]
    for y in range(2020, 2030):
        lines.append(f"{y}년,0")
        lines += [f"{m:02d}월,{y * 100 + m}" for m in range(1, 13)]
    write_csv(d, "a.csv", lines)
    write_csv(d, "tiny.csv", ["2024년,1", "05월,7"])  # shorter than the header: fallback 0
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        raw = read_report_rows(spark, d)
        out = parse_and_aggregate(raw, ["source_file"], chunk="block", head_rows=4, fallback_head_rows=0)
        got = {(r.source_file.rsplit("/", 1)[-1], r.date): r.export_amount for r in out.collect()}
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ("a.csv", "2019-03") not in got  # title is not a year marker
    assert len([k for k in got if k[0] == "a.csv"]) == 120
    assert all(got[("a.csv", f"{y}-{m:02d}")] == float(y * 100 + m) for y in range(2020, 2030) for m in range(1, 13))
    assert got[("tiny.csv", "2024-05")] == 7.0
    plan = buf.getvalue().split("== Initial Plan ==")[0]
    # one read and one shuffle of the raw rows
    assert plan.count("FileScan text") == 1, plan
    assert "REPARTITION_BY_COL" not in plan


def test_latest_file_strict(spark):
    import pytest

    from tradelens.sources.reports import latest_file

    d = tempfile.mkdtemp(prefix="tl-strict-")
    with pytest.raises(FileNotFoundError, match="No"):
        latest_file(spark, d)
    with pytest.raises(FileNotFoundError, match="Directory not found"):
        latest_file(spark, os.path.join(d, "missing"))
    write_csv(d, "a.csv", ["x"])
    assert latest_file(spark, d).endswith("a.csv")


def test_layout_is_decided_on_the_whole_file(spark):
    """First splits of four lines and less: header and S3 count lines, not splits."""
    d = tempfile.mkdtemp(prefix="tl-layout-")
    write_csv(d, "a.csv", ["2019년,1", "03월,2", "x,3", "y,4", "2024년,5", "01월,6"])
    write_csv(d, "b.csv", ["2024년,1", "02월,7"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "24")
    try:
        out = read_report_exports(spark, d, fallback_skip_rows=1)
        got = rows(out.select(F.substring_index("source_file", "/", -1), "period_raw", "export_amount"))
        assert read_report_lines(spark, d).rdd.getNumPartitions() > 2
        read = read_report_exports(spark, d)
        read.collect()
        plan = read._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("a.csv", "01월", "6"), ("a.csv", "2024년", "5"), ("b.csv", "02월", "7")]
    assert (plan.count("FileScan text"), plan.count("ReusedExchange")) == (1, 1), plan


def test_gzip_export_is_cut_into_segments(spark):
    import gzip

    from tradelens.operators.parse import parse_and_aggregate
    from tradelens.sources.reports import read_report_rows

    d = tempfile.mkdtemp(prefix="tl-gz-")
    lines = HEADER + [x for y in range(2000, 2020) for x in [f"{y}년,0", *(f"{m:02d}월,{y + m}" for m in range(1, 13))]]
    with gzip.open(os.path.join(d, "a.csv.gz"), "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    raw = read_report_rows(spark, d)
    assert raw.select("block").distinct().count() == 1
    got = parse_and_aggregate(raw, ["source_file"], chunk="block", head_rows=4, chunk_rows=7).collect()
    assert {r.date: r.export_amount for r in got} == {f"{y}-{m:02d}": float(y + m) for y in range(2000, 2020) for m in range(1, 13)}


def test_heads_read_one_block():
    import gzip
    import io

    from tradelens.sources.reports import HEAD_BYTES, head_lines

    for size in (10, 5_000_000):
        data = "\r\n".join([*HEADER, *["2024년,1"] * size]).encode()
        plain, packed = io.BytesIO(data), io.BytesIO(gzip.compress(data, 1))
        assert head_lines(plain.read, 4) == HEADER and plain.tell() <= HEAD_BYTES
        assert head_lines(packed.read, 4, gzipped=True) == HEADER and packed.tell() <= HEAD_BYTES
    wide = io.BytesIO(("x" * 100_000 + "\n").encode() * 9)
    assert [len(x) for x in head_lines(wide.read, 3)] == [100_000] * 3 and wide.tell() <= 6 * HEAD_BYTES
    assert head_lines(io.BytesIO(b"a\nb").read, 9) == ["a", "b"] and head_lines(io.BytesIO(b"").read, 2) == []


def test_headers_of_gzip_and_plain_files(spark):
    import gzip

    from tradelens.sources.reports import read_report_header

    d = tempfile.mkdtemp(prefix="tl-heads-")
    write_csv(d, "a b.csv", HEADER + ["2024년,1,2"])
    with gzip.open(os.path.join(d, "c.csv.gz"), "wt", encoding="utf-8") as f:
        f.write("\n".join(HEADER))
    write_csv(d, "empty.csv", [])
    got = rows(read_report_header(spark, d), "col_idx", "name")
    assert got == [(0, "기간")] * 2 + [(1, "수출_금액")] * 2 + [(2, "수입_금액")] * 2
