"""Random series vs a plain-Python model of the semantics.

The model loops rows one series at a time (the reference's shape of the
computation); Spark runs all series in one job.  Amounts include zeros so
every zero-base branch is hit; months are sparse so positional and calendar
rates differ; quarters are partial.
"""

import calendar
import math
import random

from tradelens.operators.dashboard import enrich_data
from tradelens.operators.growth import monthly_growth, process_quarterly


def rint(x, d=0):
    return float(round(x * 10**d)) / 10**d if d else float(round(x))


def pct(c, p, d, zero, form):
    if c is None or p is None:
        return None
    if p == 0:
        if zero == "null":
            return None
        return math.inf if c > 0 else (-math.inf if c < 0 else math.nan)
    r = (c - p) / p * 100 if form == "diff" else (c / p - 1) * 100
    return rint(r, d)


def ym(date):
    return int(date[:4]) * 100 + int(date[5:])


def model(series_rows):
    """series_rows: sorted [(date, amount)] -> (monthly, quarterly) dicts."""
    by_ym = {ym(d): a for d, a in series_rows}
    monthly = {}
    prev = None
    for d, a in series_rows:
        mom = pct(a, prev, 2, "null", "diff") if prev is not None else None
        yoy = pct(a, by_ym.get(ym(d) - 100), 2, "null", "diff")
        y, m = int(d[:4]), int(d[5:])
        bd = sum(1 for day in range(1, calendar.monthrange(y, m)[1] + 1) if calendar.weekday(y, m, day) < 5)
        da = int(round(a / bd)) if bd > 0 else 0
        monthly[d] = dict(export_mom=mom, export_yoy=yoy, business_days=bd, daily_avg=da)
        prev = a
    dates = [d for d, _ in series_rows]
    prev_da = None
    for d in dates:
        r = monthly[d]
        r["daily_avg_mom"] = pct(r["daily_avg"], prev_da, 0, "ieee", "ratio") if prev_da is not None else None
        py = f"{int(d[:4]) - 1}-{d[5:]}"
        r["daily_avg_yoy"] = pct(r["daily_avg"], monthly[py]["daily_avg"], 0, "ieee", "diff") if py in monthly else None
        prev_da = r["daily_avg"]
    quarters = {}
    for d, a in series_rows:
        q = (int(d[:4]), (int(d[5:]) - 1) // 3 + 1)
        quarters.setdefault(q, []).append((d, a))
    qkeys = sorted(quarters)
    qc = {}
    quarterly = {}
    for i, q in enumerate(qkeys):
        amt = sum(a for _, a in quarters[q])
        b = sum(monthly[d]["daily_avg"] for d, _ in quarters[q])
        qc[q] = rint(b / 3)
        prev_q = qkeys[i - 1] if i > 0 else None
        last_year = (q[0] - 1, q[1])
        qamt = {k: sum(a for _, a in v) for k, v in quarters.items()}
        quarterly[f"{q[0]}Q{q[1]}"] = (
            amt,
            pct(amt, qamt[prev_q], 2, "ieee", "ratio") if prev_q else None,
            pct(amt, qamt.get(last_year), 2, "ieee", "diff"),
        )
        last_d = max(d for d, _ in quarters[q])
        for d, _ in quarters[q]:
            monthly[d].update(quarter_b=None, quarter_c=None, quarter_d=None, quarter_e=None)
        if int(last_d[5:]) % 3 == 0:
            monthly[last_d].update(
                quarter_b=b,
                quarter_c=qc[q],
                quarter_d=pct(qc[q], qc[qkeys[i - 1]], 0, "ieee", "ratio") if i >= 1 else None,
                quarter_e=pct(qc[q], qc[qkeys[i - 4]], 0, "ieee", "ratio") if i >= 4 else None,
            )
    return monthly, quarterly


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


def test_random_series_match_model(spark):
    rnd = random.Random(7)
    data = []
    for s in range(300):
        months = [f"{y}-{m:02d}" for y in range(2019, 2025) for m in range(1, 13)]
        keep = sorted(rnd.sample(months, rnd.randint(1, 40)))
        for d in keep:
            data.append((f"s{s}", d, float(rnd.choice([0, 0, 7, 100, 2500, rnd.randint(1, 10**7)]))))
    df = spark.createDataFrame(data, "series string, date string, export_amount double").repartition(7)
    got_m = {(r.series, r.date): r for r in enrich_data(monthly_growth(df, ["series"]), ["series"], holidays=None).collect()}
    got_q = {(r.series, r.quarter): r for r in process_quarterly(df, ["series"]).collect()}
    per = {}
    for s, d, a in data:
        per.setdefault(s, []).append((d, a))
    n = 0
    for s, srows in per.items():
        exp_m, exp_q = model(sorted(srows))
        for d, e in exp_m.items():
            g = got_m[(s, d)]
            for k, v in e.items():
                assert same(g[k], v), (s, d, k, g[k], v)
                n += 1
        for q, (amt, qoq, yoy) in exp_q.items():
            g = got_q[(s, q)]
            assert g.export_amount == amt and same(g.export_qoq, qoq) and same(g.export_yoy, yoy), (s, q, g, qoq, yoy)
    assert len(got_m) == len(data) and n > 10_000
