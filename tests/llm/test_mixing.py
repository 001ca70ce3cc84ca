import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelens.llm import mixing as M


def corpus(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        kind = "toxic" if i % 5 == 0 else "poor" if i % 5 == 1 else "good"
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(5, 60))]
        if kind == "toxic":
            words[rng.randrange(len(words))] = "nasty"
        if kind == "poor":
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "src", 1.5))
        if i % 2 == 0 or i % 7 == 0:
            labels.append((i, int(kind != "poor"), int(kind == "toxic")))
    rows += [(9000, None, None, None), (9001, "", "s", 0.0), (None, "alpha nasty", "s", 0.0), (3, rows[3][1], "src", 1.5)]
    labels += [(None, 1, 0), (4, None, None), (77777, 1, 1)]
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rate double").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_expected_totals_match_targets(tables):
    docs, labels = tables
    got = M.soft_mixture(docs, labels).toPandas()
    assert len(got) == docs.count() and (got["rate"] >= 0).all() and (got["rate"] <= 1).all()
    p = got[["p_good", "p_poor", "p_toxic"]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    totals = (got["rate"].to_numpy() * got["n_tokens"].to_numpy()) @ p
    assert np.allclose(totals / totals.sum(), [0.90, 0.07, 0.03], atol=0.004)
    good = (got["doc_id"] % 5 > 1) & (got["doc_id"] < 600)
    assert got["rate"][good].mean() > 0.95
    again = M.soft_mixture(docs.repartition(7), labels).toPandas()
    key = ["doc_id", "n_tokens"]
    assert got.sort_values(key)["copies"].tolist() == again.sort_values(key)["copies"].tolist()


def test_query_meets_targets_of_scarce_domains(spark, tmp_path):
    from tradelens.llm.queries import op6_soft_mixture

    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        kind = "toxic" if i % 100 == 0 else "poor" if i % 50 == 1 else "good"
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(20, 60))]
        words = words + ["nasty"] * 3 if kind == "toxic" else [w.upper() + "!!" for w in words] if kind == "poor" else words
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind != "poor"), int(kind == "toxic")))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op6_soft_mixture(spark, str(tmp_path)).toPandas()
    totals = (got["rate"].to_numpy() * got["n_tokens"].to_numpy()) @ got[["p_good", "p_poor", "p_toxic"]].to_numpy()
    assert np.allclose(totals / totals.sum(), [0.90, 0.07, 0.03], atol=0.002)
    assert (got["rate"] >= 0).all() and got["copies"][got["doc_id"] % 100 == 0].mean() > 1.5


def test_rates_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(0, 500, 400)
    rows = [(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)]
    df = spark.createDataFrame(rows, "_tl_n long, _tl_p0 double, _tl_p1 double, _tl_p2 double").repartition(4)
    for max_rate, targets in ((1.0, {"a": 0.6, "b": 0.3, "c": 0.1}), (None, {"a": 0.1, "b": 0.1, "c": 0.8})):
        moves = M.fit_rates(df, ["a", "b", "c"], targets, "a", max_rate)
        rate = np.ones(400)
        have = n @ p
        weight = np.array([targets[c] for c in "abc"])
        target = weight * have[0] / weight[0]
        metric = np.linalg.inv((p * n[:, None]).T @ p)
        for _ in moves:
            rate = np.clip(rate - p @ (metric @ ((n * rate) @ p - target)), 0, np.inf if max_rate is None else max_rate)
        got = np.array([r[0] for r in df.select(M.rate_after(moves, max_rate), *df.columns).orderBy(*df.columns).collect()])
        order = sorted(range(400), key=lambda i: rows[i])
        assert np.allclose(got, rate[order], atol=1e-6)
        if max_rate is None:  # then the targets can be met
            assert np.abs((n * rate) @ p - target).sum() <= 0.01 * target.sum()


def test_mixed_keeps_columns_and_clean_rows(tables):
    docs, labels = tables
    out = M.mixed(docs, labels)
    assert out.columns == docs.columns
    left = {r.doc_id for r in out.collect()}
    good = [i for i in range(600) if i % 5 > 1]
    assert sum(i in left for i in good) > 0.97 * len(good)
    assert sum(i in left for i in range(0, 600, 5)) < 30
    twice = M.mixed(docs, labels, targets={"clean": 0.5, "toxic": 0.5}, max_rate=None)
    assert twice.where((F.col("doc_id") % 5 == 0) & (F.col("doc_id") < 600)).count() > 240


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = M.soft_mixture(docs, labels.limit(0))
    assert {r.copies for r in none.collect()} == {1}
    assert M.soft_mixture(docs.limit(0), labels).count() == 0 and M.mixed(docs.limit(0), labels).count() == 0
