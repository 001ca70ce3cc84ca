import random
import re

import numpy as np

from tradelens.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {j for i in at for j in range(i, i + 8)}
    lines, dup, earlier = text.split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in earlier
            earlier.add(x)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [len(words), sum(map(len, words)), symbols, dup, len(covered)]


def texts():
    rng = random.Random(4)
    for _ in range(400):
        n = rng.choice([0, 3, 10, 40, 200])
        words = [rng.choice(["a", "é", "b#", "<c>", "ñandú", "d.", "\x1c", " "]) for _ in range(n)]
        if n and rng.random() < 0.5:
            words += words[: rng.randint(0, n)]
        yield "".join(w + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for w in words)


def corpus():
    rows = [(i, t) for i, t in enumerate(texts())]
    rng = random.Random(1)
    for i in range(600):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(rng.randint(30, 80))]
        rows.append((10_000 + i, " ".join(w + "###" if i % 4 == 0 else w for w in words)))
    rows += [(1, None), (2, ""), (None, "x y z"), (9, "w " * 200_000), (9, "w " * 200_000)]
    return rows, [(10_000 + i, int(i % 4 != 0)) for i in range(0, 600, 2)] + [(None, 1), (5, None), (10_001, 1)]


def test_base_counts_and_verdicts(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, quality string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = Q.quality_rules(docs, marks).collect()
    want = sorted(brute(t) for _, t in rows)
    assert sorted([r[c] for c in Q.BASE] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    held = [r for r in got if r.doc_id and r.doc_id >= 10_000 and r.doc_id % 2 == 1 and not r.base_failed]
    assert np.mean([r.kept == (r.doc_id % 4 != 0) for r in held]) > 0.98
    left = Q.accepted(docs, marks)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)


def test_without_model_or_rows(spark):
    docs = spark.createDataFrame([(1, "word " * 3 + " ".join(map(str, range(30)))), (2, "few")], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: (r.kept, r.quality) for r in Q.quality_rules(docs, marks).collect()} == {1: (True, None), 2: (False, None)}
    assert Q.quality_rules(docs.limit(0), marks).count() == 0


def test_trees_are_monotone_and_flat_scores_agree():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(4 * x[:, 0] - 2 + 3 * np.sin(9 * x[:, 1])))).astype(float)
    t = Q.train_trees(x, y, np.array([-1, 0, 0]))
    grid = np.repeat(rng.random((200, 3)), 50, axis=0).reshape(200, 50, 3)
    grid[:, :, 0] = np.linspace(0, 1, 50)
    p = t.probability(grid.reshape(-1, 3)).reshape(200, 50)
    assert (np.diff(p, axis=1) <= 1e-12).all() and p.std() > 0.1

    def walk(row):
        total = t.base
        for k in t.roots:
            while t.left[k] != k:
                k = t.left[k] if row[t.feature[k]] <= t.cut[k] else t.right[k]
            total += t.value[k]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:100]], t.probability(x[:100]))
