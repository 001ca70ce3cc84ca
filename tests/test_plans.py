"""Plan shape, end-to-end verbs on report files, and the contract vs DuckDB."""

import os
import tempfile

import pytest

from tradelens.plans.contract import QUERIES

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_and_partitioned_windows(spark):
    for name in ("dashboard_enriched", "strategy_monthly_growth", "process_raw_report", "quarter_stats"):
        text = plan_text(QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
        for line in text.splitlines():
            if "Window [" in line:
                assert "], [], [" not in line, f"unpartitioned window in {name}: {line[:200]}"


def test_dashboard_single_series_exchange(spark):
    from tradelens.operators.aggregate import aggregate_by_date
    from tradelens.operators.dashboard import enrich_data
    from tradelens.operators.growth import monthly_growth
    from tradelens.functions.periods import with_period_keys
    from tradelens.sources.tables import orders_facts

    monthly = aggregate_by_date(orders_facts(spark, SF, "o_custkey"), ["series"])
    keyed, added = with_period_keys(monthly)
    out = enrich_data(monthly_growth(keyed, ["series"]), ["series"]).drop(*added)
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one exchange for the aggregate, one by series for all windows
    assert text.count("Exchange hashpartitioning") == 2, text
    assert text.count("Sort [") == 1, text


def test_report_exports_end_to_end(spark):
    from tradelens.plans.verbs import dashboard, report

    d = tempfile.mkdtemp(prefix="tl-test-")
    src = os.path.join(d, "in")
    os.makedirs(src)
    header = ["수출입 실적,,", "조회기간: 2023-2024,,", "기간,수출,수입", ",금액,금액"]
    a = header + ["2023년,330,0", "01월,100,1", "02월,200,1", "2024년,999,0", "01월,150,1", "1월,0,0", "02월,220,1", "총계,1,1"]
    b = header + ["2024년,10,0", "03월,\"1,000\",0", "04월,40,0"]
    for name, lines in (("a.csv", a), ("b.csv", b)):
        with open(os.path.join(src, name), "w", encoding="utf-8") as f:
            f.write("\r\n".join(lines) + "\r\n")
    tables = report(spark, src, os.path.join(d, "out"), 2024, 2024)
    got = sorted((os.path.basename(r.source_file), r.date, r.export_amount, r.export_mom, r.export_yoy) for r in tables.monthly.collect())
    assert got == [
        ("a.csv", "2024-01", 150.0, -25.0, 50.0),
        ("a.csv", "2024-02", 220.0, 46.67, 10.0),
        ("b.csv", "2024-03", 0.0, None, None),
        ("b.csv", "2024-04", 40.0, None, None),
    ]
    q = sorted((os.path.basename(r.source_file), r.quarter, r.export_amount) for r in tables.quarterly.collect())
    assert q == [("a.csv", "2024Q1", 370.0), ("b.csv", "2024Q1", 0.0), ("b.csv", "2024Q2", 40.0)]
    assert os.path.isdir(os.path.join(d, "out", "monthly")) and os.path.isdir(os.path.join(d, "out", "quarterly"))
    dash = dashboard(spark, src, os.path.join(d, "dash"), 2024, 2024)
    assert dash.count() == 4 and "title" not in dash.columns
    from tradelens.plans.verbs import dashboard_from_report

    from_report = dashboard_from_report(spark, os.path.join(d, "out"), os.path.join(d, "dash2"), 2024, 2024)
    got2 = {(os.path.basename(r.source_file), r.date): (r.export_mom, r.daily_avg) for r in from_report.collect()}
    assert got2[("a.csv", "2024-02")] == (46.67, round(220.0 / 21))
    written = [f for f in os.listdir(os.path.join(d, "dash")) if f.endswith(".csv")]
    assert written


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract_matches_duckdb(spark, name):
    import duckdb

    from tradelens.plans.oracle import SQL

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    got = df.collect()
    rel = con.sql(SQL[name])
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]

    def key(row):
        return repr(tuple("nan" if isinstance(v, float) and v != v else v for v in row))

    assert sorted((tuple(r) for r in got), key=key) == sorted((tuple(e[i] for i in order) for e in exp), key=key)
