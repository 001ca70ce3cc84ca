"""Written layouts, newest-file defaults, quoted headers."""

import os
import time

import pytest

from tradelens.plans import verbs
from tradelens.sources.reports import read_report_header
from tradelens.sources.sinks import BUCKETS, write_report
from tradelens.sources.strategies import DEFAULT_HS_CODE, with_item_defaults


def export(path, year, head="기간,금액"):
    lines = ["title", "", head, "월,달러", f"{year}년,0"] + [f"{m:02d}월,{year + m}.25" for m in range(1, 13)]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_newest_export_and_counts(spark, tmp_path):
    export(tmp_path / "a.csv", 2020)
    export(tmp_path / "b.csv", 2024)
    os.utime(tmp_path / "a.csv", (time.time() - 900,) * 2)
    out = verbs.report(spark, None, str(tmp_path / "out"), data_dir=str(tmp_path))
    assert out.counts() == (12, 4)
    assert {r.date[:4] for r in spark.read.parquet(f"{tmp_path}/out/monthly").collect()} == {"2024"}
    total = sum(r.export_amount for r in spark.read.parquet(f"{tmp_path}/out/quarterly").collect())
    assert total == sum(2024 + m + 0.25 for m in range(1, 13))
    with pytest.raises(FileNotFoundError):
        verbs.dashboard(spark, None, str(tmp_path / "d"), data_dir=str(tmp_path / "none"))


def test_folders_do_not_grow_with_series(spark, tmp_path):
    rows = [(f"s{i}", f"i{i % 7}", "2024-01", 1.0) for i in range(500)]
    df = spark.createDataFrame(rows, "strategy string, item string, date string, export_amount double")
    write_report(df, df, str(tmp_path / "r"), ["strategy", "item"])
    assert sum(x.startswith("bucket=") for x in os.listdir(tmp_path / "r/monthly")) <= BUCKETS
    assert spark.read.parquet(str(tmp_path / "r/monthly")).drop("bucket").count() == 500


def test_quoted_header_cells(spark, tmp_path):
    export(tmp_path / "q.csv", 2024, head='기간,"수출,""달러""",')
    names = [r.name for r in read_report_header(spark, str(tmp_path / "q.csv")).orderBy("col_idx").collect()]
    assert names == ["기간_월", '수출,"달러"_달러', '수출,"달러"']


def test_item_defaults(spark):
    df = spark.createDataFrame([("s", None, None), (None, "x", "1")], "strategy string, item string, hs_code string")
    got = sorted(tuple(r) for r in with_item_defaults(df).select("item", "hs_code", "target_text", "name_suffix").collect())
    assert got == [("", DEFAULT_HS_CODE, "", "_s"), ("x", "1", "", "")]


def test_write_tasks_are_not_bound_to_folders(spark, tmp_path):
    """A hot series is cut by years, tasks outnumber folders."""
    rows = [("hot", f"{y}-{m:02d}", 1.0) for y in range(1900, 2020) for m in range(1, 13)]
    rows += [(f"s{i}", "2024-01", 1.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "series string, date string, export_amount double")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = write_report(df, df.limit(0), str(tmp_path / "r"), ["series"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert counts == {"monthly": len(rows), "quarterly": 0}
    folders = [x for x in os.listdir(tmp_path / "r/monthly") if x.startswith("bucket=")]
    tasks = {f.split("-")[1] for x in folders for f in os.listdir(tmp_path / "r/monthly" / x) if f.startswith("part-")}
    hot = spark.read.parquet(str(tmp_path / "r/monthly")).where("series = 'hot'").selectExpr("_metadata.file_name AS f").distinct().count()
    assert len(folders) <= BUCKETS < len(tasks) and hot > 5
    back = spark.read.parquet(str(tmp_path / "r/monthly"))
    assert back.count() == len(rows) and back.where("series = 'hot'").count() == 1440


def test_counts_come_from_the_writes(spark, tmp_path):
    export(tmp_path / "a.csv", 2024)
    tables = verbs.report(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    group = "tradelens-count-test"
    spark.sparkContext.setJobGroup(group, "counts")
    try:
        assert tables.counts() == (12, 4)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (tables.monthly.count(), tables.quarterly.count()) == (12, 4)
