import hashlib
import random
import zlib
from collections import defaultdict

from tradelens.llm import warc
from tradelens.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, record_type string"


def rows_of(n=300):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        html = rng.choice(["", None, "short é", "x" * 99, "é" * 50, "same page " * 30, "".join(rng.choice("ab<>\r\n é") for _ in range(3000))])
        rows.append((i * 3 % 301, rng.choice([None, "http://a.example/ b\r\nX: y"]), html, "clash"))
    rows += [(900, "u", "big" * 400_000, "c"), (5, "u", "same page " * 30, "c"), (None, None, "same page " * 30, "c"), (None, "u", None, "c")]
    rows += [rows[7], rows[7]]
    return rows


def brute(rows):
    groups = defaultdict(list)
    for i, _, html, _ in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for payload, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(payload) >= 100 and len(ids) > 1 and first is not None and i != first
            out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip_over_splits(spark):
    rows = rows_of()
    folder = shared_path(spark, "test-warc")
    files = warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(5), folder)
    assert files.agg({"records": "sum"}).first()[0] == len(rows)
    for split in (None, 701, 20_000):
        got = warc.page_records(warc.read_warc(spark, folder, split))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def member(data):
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


def test_every_split_owns_its_records():
    inner = member(warc.record_bytes(77, None, b"inner", "d", 5, None, "t"))
    payloads = [b"", warc.MAGIC * 50, b"\x1f\x8b\x08" + bytes(range(256)), inner[:20], b"z" * 5000]
    data, starts = b"", []
    for i, p in enumerate(payloads):
        starts.append(len(data))
        data += member(warc.record_bytes(i, "u", p, "d", len(p), None, "t"))
        if i == 2:
            data += b"\x1f\x8b\x08 damaged \x1f\x8b"  # no member: skipped
    read = lambda at, n: data[at : at + n]
    for step in (1, 7, 64, 1000, len(data)):
        got = [x for a in range(0, len(data), step) for x in warc.records_in(read, a, min(a + step, len(data)))]
        assert [at for at, _ in got] == starts
        assert [r["payload"] for _, r in got] == payloads
    assert [at for at, _ in warc.records_in(lambda at, n: data[:-3][at : at + n], 0, len(data))] == starts[:-1]


def test_empty(spark):
    folder = shared_path(spark, "test-warc")
    assert warc.write_warc(spark.createDataFrame([], SCHEMA), folder).count() == 0
    assert warc.page_records(warc.read_warc(spark, folder)).count() == 0
