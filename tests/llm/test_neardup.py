import random

import numpy as np

from tradelens.llm import neardup as D
from tradelens.llm.components import connected_components


def sets(text, size):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute(rows, size, percent):
    s = [sets(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        comp = min(ids) if ids else None
        out.append((d, len(s[i]), comp, d == comp))
    return sorted(out, key=repr)


def corpus(seed=3, chains=True):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows, passage = [], text(60)
    for i in range(120):
        rows.append((i, " ".join(text(rng.randint(1, 60)) + passage[: rng.choice([0, 0, 60])])))
    base = text(150)
    for i in range(150):  # a cloud of copies around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((1000 + i, " ".join(w)))
    if chains:
        w = text(100)
        for i in range(25):  # a chain: ends are far apart
            w = w[2:] + text(2)
            rows.append((2000 + i, " ".join(w).upper()))
    rows += [(3000 + i, "the same text again and again") for i in range(40)]
    rows += [(4000, None), (4001, ""), (4002, " \n"), (4003, "one two"), (4004, "ONE two"), (4005, "one"), (None, "the same text again and again")]
    rows += [(4006, "x"), (None, "lonely text without an id"), (3000, "the same text again and again"), (7, rows[7][1])]
    return rows


def test_components_equal_brute_force(spark, monkeypatch):
    for size, percent, block in ((3, 85, 1024), (5, 80, 20)):
        monkeypatch.setattr(D, "BLOCK", block)
        rows = corpus(size)
        df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, uid double").repartition(4)
        got = D.components(df, size, percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == brute(rows, size, percent)


def test_deduplicated(spark):
    rows = corpus(8, chains=False)
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, uid double")
    out = D.deduplicated(df)
    want = {(d, t) for (d, t), (d2, _, _, k) in zip(rows, [None] * 0 or rows_with(rows), strict=True) if k}
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == df.columns and set(got) == want and len(got) == len(want)


def rows_with(rows):
    found = {}
    for d, n, c, k in brute(rows, 5, 80):
        found.setdefault(d, []).append((d, n, c, k))
    # null ids: one shares its text with ids (goes), one is alone (stays)
    return [(d, 0, None, "lonely" in (t or "")) if d is None else found[d][0] for d, t in rows]


def test_bayes_bounds_and_bands():
    least = D.least_matches(0.85)
    assert len(least) == D.HASHES // D.BATCH and least == sorted(least)
    rng = np.random.default_rng(0)
    same = rng.random((20_000, D.HASHES)) < 0.85  # pairs right at the threshold
    a = rng.integers(0, 256, (20_000, D.HASHES)).astype(np.uint8)
    b = np.where(same, a, a + 1).astype(np.uint8)
    assert len(D.survivors(a, b, least)) >= 19_999
    far = np.where(rng.random((5000, D.HASHES)) < 0.6, a[:5000], a[:5000] + 1).astype(np.uint8)
    assert len(D.survivors(a[:5000], far, least)) == 0
    assert D.band_rows(0.85) == 8 and D.band_rows(0.8) == 6


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, np.uint64)
    a, b = D.minhash(x[:2000]), D.minhash(x[500:2500])  # 1500 / 2500
    assert abs((a == b).mean() - 0.6) < 0.1


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randint(0, 80), 100 + rng.randint(0, 80)) for _ in range(60)]
    got = {r.v: r.comp for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {v: v for e in edges for v in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    loops = {a for a, b in edges if a == b}
    assert all(got.get(v, v) == root[v] for v in root) and set(root) - set(got) <= loops


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert D.components(df).count() == 0 and D.deduplicated(df).count() == 0
