import numpy as np
from pyspark.sql import functions as F

from tradelens.llm import language as L
from tradelens.llm.common import table


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = L.ByteNetwork(["a", "b", "c"], rng)
    x = rng.integers(0, 256, (5, 40)).astype(np.uint8)
    y = np.array([0, 1, 2, 1, 0])
    loss = lambda: -np.log(net.probabilities(x)[np.arange(5), y].astype(np.float64)).mean()
    for p, g in zip(net.parameters(), net.gradients(x, y), strict=True):
        flat, at = p.reshape(-1), int(np.abs(g).argmax())
        old, eps = flat[at], np.float32(1e-3)  # small: a larger step may change which position wins
        flat[at] = old + eps
        up = loss()
        flat[at] = old - eps
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * eps) - g.reshape(-1)[at]) < 0.02 * abs(g.reshape(-1)[at]) + 1e-3


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and (got["lang_pred"] == got["lang"]).mean() >= 0.95
    assert got["score"].between(0, 1).all()


def test_odd_rows(spark):
    rows = [(i, "alpha beta gamma " * 5, "x") for i in range(30)] + [(100 + i, "ШШ жж ыы " * 9, "y") for i in range(30)]
    rows += [(900, None, "x"), (901, "", "y"), (902, "123 !? 😀", None), (None, "alpha", "x"), (903, "beta gamma " * 50_000, None), (903, "beta gamma " * 50_000, None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.identify(df).collect()]
    by = dict((d, (p, s)) for d, p, s in got)
    assert len(got) == len(rows)
    assert all(by[i] == ("und", 0.0) for i in (900, 901, 902))
    assert by[903][0] == "x" and by[110][0] == "y" and by[None][0] == "x"
    none = L.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert L.identify(df.limit(0)).count() == 0
