"""All operators with the package on the driver's path only."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tradelens.session import get_spark
import __spark_entry__
spark = get_spark("local[4]", 4)
queries = __spark_entry__.queries()
names = [n for n in queries if n.startswith("op") and n[2].isdigit()] + ["pipeline"]
def alone(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.record_batch({{"found": [importlib.util.find_spec("tradelens") is not None]}})
assert [r.found for r in spark.range(1).mapInArrow(alone, "found boolean").collect()] == [False]
for n in names:
    print("ROWS", n, queries[n](spark, {data!r}).count(), flush=True)
"""


def test_workers_need_no_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    code = SCRIPT.format(repo=repo, data="/root/testdata/sf0.001")
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    done = [line.split()[1] for line in run.stdout.splitlines() if "ROWS" in line]
    assert run.returncode == 0, run.stderr[-3000:]
    assert len(done) == 14 and "pipeline" in done
