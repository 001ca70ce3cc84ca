"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2; the best warm run per query is reported).
Each query is executed in full with the ``noop`` sink (no collect to the
driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradelens.plans.contract import QUERIES  # noqa: E402
from tradelens.session import get_spark  # noqa: E402

HEADLINE = [
    "monthly_growth",
    "monthly_growth_gaps",
    "quarterly_growth",
    "dashboard_enriched",
    "quarter_stats",
    "process_raw_report",
    "strategy_monthly_growth",
    "strategy_quarterly_growth",
    "grid_rows",
]
# Timed once more with broadcasting off: the plan that large item tables get.
SHUFFLED = ["strategy_select"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = get_spark(
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        app_name="tradelens-bench",
        extra_conf={"spark.driver.memory": "16g"},
    )
    times = {}
    for label in [*HEADLINE, *(f"{n}_without_broadcast" for n in SHUFFLED)]:
        name, best = label.removesuffix("_without_broadcast"), None
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if name == label else "-1")
        for _ in range(repeat + 1):  # first run warms the JVM and file cache
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[label] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times[n] for n in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
