"""Print the executed (final AQE) physical plan tree of headline queries as
Markdown, with exchange / sort / window counts.  Usage:

    python tools/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelens.plans.contract import QUERIES  # noqa: E402
from tradelens.session import get_spark  # noqa: E402

SHOW = [
    "monthly_growth",
    "quarterly_growth",
    "dashboard_enriched",
    "process_raw_report",
    "strategy_monthly_growth",
    "grid_rows",
]


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    return re.sub(r"#\d+L?", "", head)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 8)
    print("# Physical plans of headline queries\n")
    print(f"Generated by `python tools/show_plans.py {sf_dir}` (formatted explain after one run).\n")
    print(
        "Counts include the plan that builds each query's input from the given tables: "
        "`process_raw_report` first rebuilds report rows from `orders` (four small "
        "aggregations and a union), `grid_rows` first renders pages from `lineitem`. "
        "The engine's own part is the tail of each tree: one aggregate exchange, then "
        "one exchange by series feeding all windows.\n"
    )
    for name in SHOW:
        t = tree(QUERIES[name](spark, sf_dir))
        counts = {k: t.count(k) for k in ("Exchange", "Sort ", "Window", "BroadcastExchange", "SortMergeJoin")}
        counts["Exchange"] -= counts["BroadcastExchange"]
        print(f"## {name}\n")
        print(
            f"shuffle exchanges: {counts['Exchange']}, broadcast exchanges: {counts['BroadcastExchange']}, "
            f"sort-merge joins: {counts['SortMergeJoin']}, sorts: {counts['Sort ']}, window nodes: {counts['Window']}\n"
        )
        print("```\n" + t.strip() + "\n```\n")


if __name__ == "__main__":
    main()
