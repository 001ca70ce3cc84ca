"""The stages on odd rows, and the whole pipeline on the smallest tables."""

import random
import re
import zlib

import pytest

import corpus_pipeline as P
from tradelens.llm import neardup, pii
from tradelens.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def odd_documents(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(25, 60))), "en", f"s{i % 3}", 7, "x") for i in range(60)]
    rows += [(100, None, None, None, None, None), (None, rows[1][1], "en", "s", 1, "y"), (101, "", "en", "", 0, ""), rows[2], rows[2]]
    rows += [(200, rows[3][1], "en", "s0", 7, "x"), (201, rows[4][1] + " mail me at a.b@c.example 10.1.2.3", "en", "s0", 7, "x")]
    rows.append((300, "long " + " ".join(rng.choice(words) + str(rng.randint(0, 999)) for _ in range(60_000)), "en", "s1", 7, "x"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, _tl_key string"
    return spark.createDataFrame(rows, schema)


def test_every_stage_takes_odd_rows(spark):
    docs = odd_documents(spark)
    for name, stage in P.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns and out.schema == docs.schema, name
        assert out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        if name == "near_dedup":
            ids = [r.doc_id for r in out.collect()]
            assert 3 in ids and 200 not in ids and ids.count(2) == 1 and None not in ids
            assert 100 in ids and 101 in ids  # without words: no duplicates of each other
        if name == "pii":
            text = {r.doc_id: r.text for r in out.collect()}
            assert text[201].endswith("mail me at [EMAIL] [IP]") and text[100] is None
            assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
    last = P.STAGES[-1][1]
    assert last(spark, docs.limit(0), SF).count() == 0
    assert last(spark, docs, SF).agg({"length": "sum"}).first()[0] > 60_000


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        kept = stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, kept))
        docs = kept
    return {name: (before, after) for name, before, after in out}


def test_stages_take_effect(spark, stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns, name
    before, after = stages["near_dedup"]
    found = neardup.components(before, 5, 80)
    assert after.count() == found.where("kept").select("doc_id").distinct().count()
    before, after = stages["pii"]
    assert before.count() == after.count()
    for r in after.collect():
        for kind, pattern, _ in pii.KINDS:
            if kind == "email":
                assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", r.text)
    before, after = stages["mixing"]
    assert after.count() >= 0.8 * before.count()
    assert after.join(before, "doc_id", "left_anti").count() == 0
    before, after = stages["packing"]
    lengths = {r.doc_id: r.n for r in after.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert set(lengths) == {r.doc_id for r in before.collect()}
    assert all(r["doc_tokens"] == lengths[r.doc_id] for r in after.select("doc_id", "doc_tokens").distinct().collect())


def test_run_equals_the_stages(spark, stages):
    got = P.run(spark, SF)
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32").collect())
    crc = lambda rows: zlib.crc32(repr(sorted({(r[0], r[1]) for r in rows})).encode())
    assert {r[0] for r in key(got)} == {r[0] for r in key(stages["packing"][1])}
    assert sum(r[2] for r in key(got)) == sum(r[2] for r in key(stages["packing"][1])) and crc(key(got))


def test_registered(spark):
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 11)]
    queries = entry.queries()
    assert all(any(q.startswith(n) for q in queries) for n in names) and "pipeline" in queries
