import pytest
from conftest import rows

from tradelens.operators.pages import grid_rows, list_links, option_dimension

SCHEMA = "page_id long, url string, html string"


def cell(column, text, tag="td"):
    return f'<{tag} aria-describedby="table_list_1_{column}"><b>{text}</b></{tag}>'


def grid(*lines):
    body = "".join('<tr class="x jqgrow y">' + "".join(cell(c, t) for c, t in line) + "</tr>" for line in lines)
    return f'<table id="table_list_1"><tr class="jqgfirstrow"><td></td></tr>{body}</table>'


LINE = [
    ("NUM", " 3 "), ("COL1", "[0101210000] Bees &amp; &#34;wax&#x22; &lt;raw&gt;"), ("COL2", "Nord&nbsp;hafen"),
    ("EX_AMT", "12,345"), ("EX_WGHT", "7.25"), ("IM_AMT", "0"), ("IM_WGHT", "n/a"),
]
LISTS = """<select class="s" id="Quay"><option value="">none</option>
<optgroup label="R&amp;D"><option value="q1"> Pier &lt;1&gt; </option><option value="q2">Pier 2</option></optgroup>
<option value="q9"><i>loose</i></option><optgroup label="South"><option value="q3">Pier 3</option></optgroup></select>
<select id="Kind"><option value="k">&#xAC00;&#44033;</option></select>"""


def test_grid_rows(spark):
    pages = [(1, "u", grid(LINE, LINE)), (2, "u", "<p>nothing here</p>"), (3, None, None)]
    got = rows(grid_rows(spark.createDataFrame(pages, SCHEMA)))
    assert got == [(1, 3, "0101210000", 'Bees & "wax" <raw>', "Nord\u00a0hafen", 12345.0, 7.25, 0.0, None)] * 2


def test_option_dimension_in_one_pass(spark):
    df = option_dimension(spark.createDataFrame([(5, "u", LISTS)], SCHEMA))
    assert rows(df, "select_id", "grp", "code", "label") == sorted(
        [
            ("Quay", "R&D", "q1", "Pier <1>"), ("Quay", "R&D", "q2", "Pier 2"), ("Quay", None, "q9", "loose"),
            ("Quay", "South", "q3", "Pier 3"), ("Kind", None, "k", "\uac00\uac01"),
        ],
        key=repr,
    )
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_list_links(spark):
    html = '<ul><li class="a"> <a class="b" href="/x?a=1&amp;b=2">One <b>two</b>&amp;three</a></li><li>no link</li></ul>'
    got = rows(list_links(spark.createDataFrame([(1, "u", html)], SCHEMA)))
    assert got == [(1, "/x?a=1&b=2", "One two&three")]


@pytest.mark.parametrize("policy", ["EXCEPTION", "LAST_WIN"])
def test_repeated_cell_keeps_the_last_in_any_session(spark, policy):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", policy)
    try:
        page = grid([("NUM", "1"), ("NUM", "2"), ("EX_AMT", "1,000")])
        got = rows(grid_rows(spark.createDataFrame([(1, "u", page)], SCHEMA)), "row_num", "ex_amt")
    finally:
        spark.conf.unset("spark.sql.mapKeyDedupPolicy")
    assert got == [(2, 1000.0)]


def test_option_dimension_reads_whole_pages(spark, tmp_path):
    """A hundred suppliers share a page, whose level list is read with them."""
    from tradelens.plans.contract import q_option_dimension

    suppliers = [(k, f"A&amp;B <{k}>", k % 3) for k in (0, 1, 2, 3, 99, 100, 250)] + [(300, "nowhere", 77)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(3)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    want = [(k // 100, "Select2", f"N{k % 3}", str(k), f"A&amp;B <{k}>") for k in (0, 1, 2, 3, 99, 100, 250)]
    want += [(p, "LOCATION_TYPE", None, c, label) for p in range(4) for c, label in (("A", "시 선택"), ("B", "시군구 선택"))]
    assert rows(q_option_dimension(spark, str(tmp_path))) == sorted(want, key=repr)
