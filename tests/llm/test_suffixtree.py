import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from tradelens.llm import suffixtree as S


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute_model(texts, depth, p_min, kl_min):
    """Contexts (bytes, oldest first) with next-symbol counts, and a scorer."""
    count = defaultdict(Counter)
    for t in texts:
        s = b"\n" + b" ".join(S.words_of(t)) + b"\n"
        for i in range(1, len(s)):
            for d in range(min(i, depth) + 1):
                count[s[i - d : i]][s[i]] += 1
    positions = sum(count[b""].values())
    total = {c: sum(f.values()) for c, f in count.items()}
    kept = {b""}
    for c, f in count.items():
        if c and total[c] >= p_min * positions:
            kl = sum(n / total[c] * math.log2(n / total[c] / (count[c[1:]][a] / total[c[1:]])) for a, n in f.items())
            if kl >= kl_min:
                kept |= {c[k:] for k in range(len(c) + 1)}

    def prob(c, a):
        f = count[c]
        if not c:
            return (f[a] + 1) / (sum(f.values()) + 256)
        return (f[a] + len(f) * prob(c[1:], a)) / (total[c] + len(f))

    def score(t):
        s, out = b"\n" + b" ".join(S.words_of(t)) + b"\n", 0.0
        for i in range(1, len(s)):
            c = next(s[i - d : i] for d in range(min(i, depth), -1, -1) if s[i - d : i] in kept)
            out += math.log10(prob(c, s[i]))
        return out

    return kept, score


def corpus():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["the", "THEN", "and", "hand", "é", "rare%d" % rng.randint(0, 60)]) for _ in range(rng.randint(0, 90)))) for i in range(160)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "the null id"), (503, "zq\x00x ½ ☃"), (504, "the and " * 2000), (504, "the and " * 2000)]
    return rows


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "P_WORD", 0.01)  # some words are broadcast, most are joined
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int").repartition(3)
    got = S.suffix_tree_scores(df).collect()
    train = [(t or "").encode() for i, t in rows if not held(i)]
    words = Counter(w for t in train for w in [*S.words_of(t), b""])
    total, size = sum(words.values()), len(words)
    kept, score = brute_model(train, S.DEPTH, S.P_MIN, S.KL_MIN)
    assert len(kept) > 50 and len(got) == len(rows)
    text = {i: (t or "").encode() for i, t in rows}
    for r in got:
        w = [*S.words_of(text[r.doc_id]), b""]
        assert r.held_out == held(r.doc_id) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(w), sum(words[x] > 0 for x in w))
        base = sum(math.log10((words[x] + 1) / (total + size + 1)) for x in w)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score(text[r.doc_id]), rel_tol=1e-9, abs_tol=1e-9)


def test_distributions_sum_to_one_and_stretches_agree():
    rows = [(0, 0, a, n) for a, n in ((98, 5), (99, 3), (11, 2))] + [(1, 98, 99, 4), (1, 98, 11, 1), (2, 99 | 98 << 9, 11, 2)]
    rows.append((1, 99, 11, 2))
    m = S.Automaton(rows)
    p = 10 ** m.logp.reshape(-1, m.width)
    assert np.allclose(p[:, : m.unseen].sum(axis=1) + (256 - m.unseen) * p[:, m.unseen], 1)
    texts = [S.words_of(b"ab ba abab " * k) for k in (0, 1, 3, 200)]
    assert np.allclose(m.score(texts, stretch=7), m.score(texts, stretch=4096))


def test_empty(spark):
    assert S.suffix_tree_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
