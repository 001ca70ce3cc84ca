"""DuckDB SQL for every contract query (the independent oracle).

Written directly from the semantics: GROUP BY sums of DECIMAL money, ``lag``
for positional rates, LEFT self-joins on shifted period keys for calendar
rates, ``round_even`` for half-even rounding, ``generate_series`` for the
business-day calendar.  Tables are the pre-registered views
(``orders``, ``lineitem``, ``part``, ``supplier``, ``nation``, ``region``).
"""

from __future__ import annotations

# The year range of the views, stated once more on purpose.
YEAR_FROM, YEAR_TO = 1997, 1999

YM = "(CAST(substr(date, 1, 4) AS INTEGER) * 100 + CAST(substr(date, 6, 2) AS INTEGER))"
QK = "(CAST(substr(date, 1, 4) AS INTEGER) * 10 + (CAST(substr(date, 6, 2) AS INTEGER) - 1) // 3 + 1)"
MONEY = "CAST({} AS DECIMAL(18,2))"


def monthly(series_expr: str, amount_expr: str = "o_totalprice") -> str:
    return (
        f"SELECT {series_expr} AS series, strftime(o_orderdate, '%Y-%m') AS date, "
        f"CAST(sum({MONEY.format(amount_expr)}) AS DOUBLE) AS export_amount FROM orders GROUP BY ALL"
    )


DENSE = monthly("o_orderpriority")
SPARSE = monthly("CAST(o_custkey AS VARCHAR)")


def _on(keys, a, b):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def growth(m: str, keys=("series",), mom=True, yoy=True) -> str:
    ks = ", ".join(keys)
    cols = [f"{ks}", "date", "export_amount"]
    if mom:
        cols.append("CASE WHEN pm <> 0 THEN round_even((export_amount - pm) / pm * 100, 2) END AS export_mom")
    if yoy:
        cols.append("CASE WHEN py <> 0 THEN round_even((export_amount - py) / py * 100, 2) END AS export_yoy")
    return f"""
WITH m AS ({m}),
k AS (SELECT *, {YM} AS ym FROM m),
w AS (SELECT k.*, lag(export_amount) OVER (PARTITION BY {ks} ORDER BY ym) AS pm FROM k),
y AS (SELECT w.*, p.export_amount AS py FROM w LEFT JOIN k p ON {_on(keys, 'p', 'w')} AND p.ym = w.ym - 100)
SELECT {', '.join(cols)} FROM y"""


def quarterly(facts: str, keys=("series",)) -> str:
    """``facts`` has ``keys, date, amount`` (DECIMAL) rows."""
    ks = ", ".join(keys)
    return f"""
WITH f AS ({facts}),
q AS (SELECT {ks}, {QK} AS qk, CAST(sum(amount) AS DOUBLE) AS export_amount FROM f GROUP BY ALL),
l AS (SELECT q.*, lag(export_amount) OVER (PARTITION BY {ks} ORDER BY qk) AS pq FROM q),
y AS (SELECT l.*, p.export_amount AS py FROM l LEFT JOIN q p ON {_on(keys, 'p', 'l')} AND p.qk = l.qk - 10)
SELECT {ks}, CAST(qk // 10 AS VARCHAR) || 'Q' || CAST(qk % 10 AS VARCHAR) AS "quarter", export_amount,
  CASE WHEN pq <> 0 THEN round_even((export_amount / pq - 1) * 100, 2) END AS export_qoq,
  CASE WHEN py <> 0 THEN round_even((export_amount - py) / py * 100, 2) END AS export_yoy
FROM y"""


ORDER_FACTS_DENSE = (
    "SELECT o_orderpriority AS series, strftime(o_orderdate, '%Y-%m') AS date, "
    f"{MONEY.format('o_totalprice')} AS amount FROM orders"
)
ORDER_FACTS_SPARSE = ORDER_FACTS_DENSE.replace("o_orderpriority AS series", "CAST(o_custkey AS VARCHAR) AS series")

# Fixed-date public holidays, for every year that the data has.
HOLIDAYS = """
SELECT make_date(CAST(y AS INTEGER), h.m, h.d) AS d
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders UNION SELECT DISTINCT year(l_shipdate) FROM lineitem),
  (VALUES (1, 1), (3, 1), (5, 5), (6, 6), (8, 15), (10, 3), (10, 9), (12, 25)) h(m, d)"""


def business_days_of(months: str) -> str:
    """``months`` yields a column ``ym``; result ``ym, business_days``."""
    return f"""
SELECT ym, CAST(count(*) FILTER (WHERE isodow(d) < 6 AND d NOT IN (SELECT d FROM hol)) AS INTEGER) AS business_days
FROM (SELECT ym, CAST(unnest(generate_series(make_date(ym // 100, ym % 100, 1),
        last_day(make_date(ym // 100, ym % 100, 1)), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT DISTINCT ym FROM ({months}))) GROUP BY ym"""


def dashboard_ctes(g: str, keys=("series",)) -> str:
    """CTEs over growth rows ``g`` (keys, date, export_amount[, rates]) ending in ``e``."""
    ks = ", ".join(keys)
    return f"""
hol AS ({HOLIDAYS}),
g AS ({g}),
k AS (SELECT *, {YM} AS ym, {QK} AS qk FROM g),
bd AS ({business_days_of('SELECT ym FROM k')}),
e1 AS (SELECT k.*, COALESCE(bd.business_days, 0) AS business_days,
        CASE WHEN bd.business_days > 0 THEN CAST(round_even(export_amount / bd.business_days, 0) AS BIGINT) ELSE 0 END AS daily_avg
       FROM k LEFT JOIN bd USING (ym)),
e2 AS (SELECT e1.*, lag(daily_avg) OVER (PARTITION BY {ks} ORDER BY ym) AS dpm FROM e1),
e3 AS (SELECT e2.*, p.daily_avg AS dpy FROM e2 LEFT JOIN e1 p ON {_on(keys, 'p', 'e2')} AND p.ym = e2.ym - 100),
q AS (SELECT {ks}, qk, CAST(sum(daily_avg) AS BIGINT) AS qb, max(ym) AS last_ym FROM e1 GROUP BY ALL),
ql AS (SELECT q.*, round_even(qb / 3.0, 0) AS qc,
        lag(round_even(qb / 3.0, 0), 1) OVER (PARTITION BY {ks} ORDER BY qk) AS qc1,
        lag(round_even(qb / 3.0, 0), 4) OVER (PARTITION BY {ks} ORDER BY qk) AS qc4 FROM q),
e AS (SELECT e3.*, ql.qb AS quarter_b, ql.qc AS quarter_c,
        CASE WHEN qc1 <> 0 THEN round_even((ql.qc / qc1 - 1) * 100, 0) END AS quarter_d,
        CASE WHEN qc4 <> 0 THEN round_even((ql.qc / qc4 - 1) * 100, 0) END AS quarter_e,
        CASE WHEN dpm <> 0 THEN round_even((CAST(daily_avg AS DOUBLE) / dpm - 1) * 100, 0) END AS daily_avg_mom,
        CASE WHEN dpy <> 0 THEN round_even((daily_avg - dpy) / CAST(dpy AS DOUBLE) * 100, 0) END AS daily_avg_yoy
      FROM e3 LEFT JOIN ql ON {_on(keys, 'ql', 'e3')} AND ql.last_ym = e3.ym AND ql.last_ym % 100 IN (3, 6, 9, 12))"""


ENRICHED = (
    "series, date, export_amount, export_mom, export_yoy, business_days, daily_avg, daily_avg_mom, "
    "daily_avg_yoy, quarter_b, quarter_c, quarter_d, quarter_e"
)
LABELLED = (
    'series, date AS "날짜", export_amount AS "수출액(달러)", export_mom AS "MoM(%)", export_yoy AS "YoY(%)", '
    'business_days AS "영업일", daily_avg AS "일평균(달러)", daily_avg_mom AS "일평균 MoM(%)", '
    'daily_avg_yoy AS "일평균 YoY(%)", quarter_b AS "분기합계(B)", quarter_c AS "분기평균(C)", '
    'quarter_d AS "QoQ(%)", quarter_e AS "분기 YoY(%)"'
)


def dashboard(g: str, select: str, where: str = "", keys=("series",)) -> str:
    return f"WITH {dashboard_ctes(g, keys)}\nSELECT {select} FROM e {where}"


YEAR_WHERE = f"WHERE CAST(substr(date, 1, 4) AS INTEGER) BETWEEN {YEAR_FROM} AND {YEAR_TO}"

# Raw report rebuilt from orders, with cents.
RAW_MONTHS = """
SELECT o_orderpriority AS series, year(o_orderdate) AS y, month(o_orderdate) AS mo, o_orderstatus AS st,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amt
FROM orders GROUP BY ALL"""

PARSE_PERIOD_ROWS = f"""
WITH r AS ({RAW_MONTHS})
SELECT series,
  CAST(y * 10000 + mo * 10 + CASE st WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS row_no,
  CAST(y AS VARCHAR) || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') AS date,
  CAST(amt AS DOUBLE) AS export_amount
FROM r"""

RAW_MONTHLY = f"""
SELECT series, CAST(y AS VARCHAR) || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') AS date,
  CAST(sum(amt) AS DOUBLE) AS export_amount
FROM ({RAW_MONTHS}) GROUP BY ALL"""

RETURNS_MONTHLY = """
SELECT CAST(o_custkey AS VARCHAR) AS series, strftime(o_orderdate, '%Y-%m') AS date,
  CAST(sum(CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS export_amount
FROM orders GROUP BY ALL"""

BAD_SERIES = f"SELECT series FROM ({RETURNS_MONTHLY}) WHERE export_amount < 0"

# Pending orders of December are booked in a 13th month.
THIRTEENTH_MONTHLY = """
SELECT CAST(o_custkey AS VARCHAR) AS series,
  CASE WHEN month(o_orderdate) = 12 AND o_orderstatus = 'P' THEN CAST(year(o_orderdate) AS VARCHAR) || '-13'
    ELSE strftime(o_orderdate, '%Y-%m') END AS date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS export_amount
FROM orders GROUP BY ALL"""


def _ieee(current: str, base: str, ratio: bool) -> str:
    """A rate by float division, in hundredths, with infinities as text."""
    rate = f"({current} / {base} - 1) * 100" if ratio else f"({current} - {base}) / {base} * 100"
    return (
        f"CASE WHEN {base} IS NULL THEN NULL WHEN {base} = 0 AND {current} = 0 THEN 'nan' WHEN {base} = 0 THEN 'inf' "
        f"ELSE CAST(CAST(round(round_even({rate}, 2) * 100) AS DECIMAL(38,0)) AS VARCHAR) END"
    )


QUARTERLY_ZERO_BASE = f"""
WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS series, strftime(o_orderdate, '%Y-%m') AS date,
    CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS amount FROM orders),
q AS (SELECT series, {QK} AS qk, CAST(sum(amount) AS DOUBLE) AS a FROM f GROUP BY ALL),
l AS (SELECT q.*, lag(a) OVER (PARTITION BY series ORDER BY qk) AS pq FROM q),
y AS (SELECT l.*, p.a AS py FROM l LEFT JOIN q p ON p.series = l.series AND p.qk = l.qk - 10)
SELECT series, CAST(qk // 10 AS VARCHAR) || 'Q' || CAST(qk % 10 AS VARCHAR) AS "quarter", a AS export_amount,
  {_ieee('a', 'pq', True)} AS export_qoq, {_ieee('a', 'py', False)} AS export_yoy FROM y"""

# Links in list items: the target, and the text without tags, trimmed.
PAGE_LINKS = r"""
WITH li AS (SELECT page_id, unnest(regexp_extract_all(html,
    '(?s)<li\b[^>]*>\s*<a\b[^>]*\bhref="[^"]*"[^>]*>.*?</a>')) AS x FROM pages)
SELECT page_id, regexp_extract(x, '\bhref="([^"]*)"', 1) AS code,
  trim(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&'), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS label
FROM li"""

AMOUNT_COERCION = """
SELECT o_orderkey, o_orderpriority,
  CASE o_orderpriority
    WHEN '4-NOT SPECIFIED' THEN CAST(0 AS DOUBLE)
    WHEN '5-LOW' THEN CAST(floor(o_totalprice) AS DOUBLE)
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount
FROM orders"""

RECORDS = """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y/%m') ELSE strftime(o_orderdate, '%Y-%m') END AS date,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 50000 AS DOUBLE) AS export_amount
FROM orders"""

REASONS = (
    "concat_ws('; ', CASE WHEN NOT regexp_full_match(date, '[0-9]{4}-[0-9]{2}') THEN 'date must match YYYY-MM with a month from 01 to 12' END, "
    "CASE WHEN export_amount < 0 THEN 'export_amount must be a finite number >= 0' END)"
)


def _suppliers(count):
    """Names of the suppliers numbered 0 to count - 1."""
    return ", ".join(f"'Supplier#{k:09d}'" for k in range(count))


PART_FILTER_COUNT = "CASE p_type WHEN 'MEDIUM' THEN 2 WHEN 'STANDARD' THEN 0 WHEN 'PROMO' THEN 0 ELSE 1 END"
PART_FILTER_PASS = f"""CASE p_type
    WHEN 'ECONOMY' THEN r_name IN ('ASIA', 'EUROPE')
    WHEN 'SMALL' THEN n_name IN ('NATION_1', 'NATION_7', 'NATION_13', 'NATION_19')
    WHEN 'LARGE' THEN s_name IN ({_suppliers(10)})
    WHEN 'MEDIUM' THEN r_name IN ('AFRICA', 'AMERICA', 'ASIA') AND s_name IN ({_suppliers(30)})
    ELSE TRUE END"""

STRATEGY_FACTS = f"""
SELECT p_brand AS strategy, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS item,
  strftime(l_shipdate, '%Y-%m') AS date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE {PART_FILTER_PASS}"""

STRATEGY_MONTHLY = f"SELECT strategy, item, date, CAST(sum(amount) AS DOUBLE) AS export_amount FROM ({STRATEGY_FACTS}) GROUP BY ALL"

GRID_ROWS = """
SELECT CAST(l_orderkey AS BIGINT) AS page_id, CAST(l_linenumber AS BIGINT) AS row_num,
  lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS hs_code, p_name AS item_name, n_name AS region,
  l_extendedprice AS ex_amt, l_quantity AS ex_wght,
  CAST(floor(l_extendedprice * l_discount) AS DOUBLE) AS im_amt, CAST(0 AS DOUBLE) AS im_wght
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey"""

OPTION_DIMENSION = """
WITH p AS (SELECT DISTINCT CAST(s_suppkey // 100 AS BIGINT) AS page_id FROM supplier)
SELECT CAST(s_suppkey // 100 AS BIGINT) AS page_id, 'Select2' AS select_id, n_name AS grp,
  CAST(s_suppkey AS VARCHAR) AS code, s_name AS label
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT page_id, 'LOCATION_TYPE', NULL, c, l FROM p, (VALUES ('A', '시 선택'), ('B', '시군구 선택')) v(c, l)"""


def _listed(condition: str) -> str:
    """Sums of the items of ``long_list_items``: the condition is their filter."""
    return f"""
SELECT p_brand AS strategy, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS item, strftime(l_shipdate, '%Y-%m') AS date,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS export_amount
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE {condition} GROUP BY ALL"""


LATEST = """
SELECT CAST(o_custkey AS VARCHAR) AS series,
  arg_max(o_totalprice, strftime(o_orderdate, '%Y-%m-%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS latest_amount,
  max(strftime(o_orderdate, '%Y-%m-%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS max_order_stamp
FROM orders GROUP BY ALL"""


def _zero_base_monthly() -> str:
    amt = "CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END"
    return (
        "SELECT CAST(o_custkey AS VARCHAR) AS series, strftime(o_orderdate, '%Y-%m') AS date, "
        f"CAST(sum({amt}) AS DOUBLE) AS export_amount FROM orders GROUP BY ALL"
    )


SQL: dict[str, str] = {
    "aggregate_by_date": DENSE,
    "monthly_mom": growth(DENSE, yoy=False),
    "monthly_yoy": growth(DENSE, mom=False),
    "monthly_growth": growth(DENSE),
    "monthly_growth_gaps": growth(SPARSE),
    "monthly_growth_zero_base": growth(_zero_base_monthly()),
    "filter_by_year": f"SELECT * FROM ({growth(DENSE)}) {YEAR_WHERE}",
    "record_counts": f"SELECT series, count(*) AS records FROM ({growth(DENSE)}) {YEAR_WHERE} GROUP BY series",
    "quarterly_growth": quarterly(ORDER_FACTS_DENSE),
    "quarterly_growth_gaps": quarterly(ORDER_FACTS_SPARSE),
    "quarterly_filter_by_year": f"SELECT * FROM ({quarterly(ORDER_FACTS_DENSE)}) "
    f'WHERE CAST(substr("quarter", 1, 4) AS INTEGER) BETWEEN {YEAR_FROM} AND {YEAR_TO}',
    "business_days": f"""WITH hol AS ({HOLIDAYS}),
months AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS date FROM orders),
bd AS ({business_days_of(f'SELECT {YM} AS ym FROM months')})
SELECT date, business_days FROM months JOIN bd ON bd.ym = {YM}""",
    "daily_average": dashboard(DENSE, "series, date, export_amount, business_days, daily_avg"),
    "daily_avg_mom": dashboard(SPARSE, "series, date, daily_avg, daily_avg_mom"),
    "daily_avg_yoy": dashboard(SPARSE, "series, date, daily_avg, daily_avg_yoy"),
    "quarter_stats": dashboard(SPARSE, "series, date, daily_avg, quarter_b, quarter_c, quarter_d, quarter_e"),
    "dashboard_enriched": dashboard(growth(DENSE), ENRICHED),
    "dashboard_labels": dashboard(growth(DENSE), LABELLED, YEAR_WHERE),
    "parse_period_rows": PARSE_PERIOD_ROWS,
    "process_raw_report": growth(RAW_MONTHLY),
    "safe_report_valid": growth(f"SELECT m.* FROM ({RETURNS_MONTHLY}) m ANTI JOIN ({BAD_SERIES}) USING (series)"),
    "safe_report_rejects": f"""SELECT m.*, CASE WHEN export_amount < 0 THEN 'export_amount must be a finite number >= 0'
  ELSE 'another month of the series is invalid' END AS reason
FROM ({RETURNS_MONTHLY}) m SEMI JOIN ({BAD_SERIES}) USING (series)""",
    "safe_series_status": f"""SELECT series, count(*) AS months,
  CASE WHEN min(export_amount) < 0 THEN 'rejected' ELSE 'valid' END AS status FROM ({RETURNS_MONTHLY}) GROUP BY series""",
    "bad_month_rejects": f"""WITH m AS ({THIRTEENTH_MONTHLY})
SELECT series, date, export_amount, CASE WHEN date LIKE '%-13' THEN 'date must match YYYY-MM with a month from 01 to 12'
  ELSE 'another month of the series is invalid' END AS reason
FROM m WHERE series IN (SELECT series FROM m WHERE date LIKE '%-13')""",
    "report_tables_monthly": f"SELECT * FROM ({growth(DENSE)}) {YEAR_WHERE}",
    "report_tables_quarterly": f"SELECT * FROM ({quarterly(ORDER_FACTS_DENSE)}) "
    f'WHERE CAST(substr("quarter", 1, 4) AS INTEGER) BETWEEN {YEAR_FROM} AND {YEAR_TO}',
    "dashboard_verb": dashboard(growth(RAW_MONTHLY), ENRICHED, YEAR_WHERE),
    "safe_aggregate": DENSE,
    "sorted_by_date": DENSE,
    "custom_columns": f"""SELECT series AS grp, date AS ym, export_amount AS amt, export_mom, export_yoy FROM ({growth(DENSE)})""",
    "separators": DENSE,
    "quarterly_zero_base": QUARTERLY_ZERO_BASE,
    "analysis_rejects": f"""SELECT series, replace(date, '-', '/') AS date, export_amount, export_mom, export_yoy,
  'date must match YYYY-MM with a month from 01 to 12' AS reason FROM ({growth(DENSE)}) WHERE date LIKE '1998%'""",
    "page_links": PAGE_LINKS,
    "amount_coercion": AMOUNT_COERCION,
    "valid_records": f"SELECT * FROM ({RECORDS}) WHERE {REASONS} = ''",
    "rejected_records": f"SELECT *, {REASONS} AS reason FROM ({RECORDS}) WHERE {REASONS} <> ''",
    "strategy_items": f"""SELECT p_brand AS strategy, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS item,
  lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS hs_code, {PART_FILTER_COUNT} AS n_filters FROM part""",
    "strategy_rejects": """SELECT p_brand AS strategy, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS item,
  lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS hs_code, 'unknown filter category: 품목분류' AS reason
FROM part WHERE p_type = 'PROMO'""",
    "strategy_select": STRATEGY_MONTHLY,
    "strategy_monthly_growth": growth(STRATEGY_MONTHLY, keys=("strategy", "item")),
    "strategy_quarterly_growth": quarterly(STRATEGY_FACTS, keys=("strategy", "item")),
    "strategy_long_lists": _listed("(s_nationkey + p_partkey) % 25 < 13"),
    "strategy_contains": _listed("contains(s_name, lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0'))"),
    "strategy_dashboard": dashboard(
        growth(STRATEGY_MONTHLY, keys=("strategy", "item")),
        "strategy, item, " + ENRICHED.replace("series, ", "", 1),
        YEAR_WHERE,
        keys=("strategy", "item"),
    ),
    "latest_per_series": LATEST,
    "result_json": growth(DENSE),
    "grid_rows": GRID_ROWS,
    "option_dimension": OPTION_DIMENSION,
}
