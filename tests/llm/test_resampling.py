import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tradelens.llm.resampling import PrefixCrc, resample, shifted

SCHEMA = "doc_id long, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def odd(rng, n=30):
    bits = ["The", "é", "x1", "--", "\n", "  ", "Ünï", "日本", "Z", "a", "0", "\x00", "\x7f", "_", "{", "\x80", "long" * 20]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, n)))


def test_ngram_crcs_equal_zlib():
    rng = random.Random(1)
    for _ in range(500):
        text = odd(rng)
        w, crcs = words(text), PrefixCrc(text.encode())
        assert crcs.n == len(w)
        for k in (1, 2, 3, 5):
            assert crcs.ngrams(k).tolist() == [zlib.crc32(" ".join(w[i : i + k]).encode()) for i in range(len(w) - k + 1)]


def test_shift_equals_zero_bytes():
    rng = np.random.default_rng(3)
    crc, n = rng.integers(0, 1 << 32, 50, dtype=np.uint32), rng.integers(0, 5000, 50)
    want = [zlib.crc32(b"\0" * int(k), int(c)) ^ zlib.crc32(b"\0" * int(k)) for c, k in zip(crc, n, strict=True)]
    assert shifted(crc, n).tolist() == want


def by_hand(docs, target, sizes, buckets, percent, min_words, seed=2024):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in sizes for i in range(len(w) - k + 1)]

    s, t = Counter(b for _, x in docs for b in features(x)), Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, x in docs:
        f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x))))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    n = len(able) * percent // 100
    ranked = [(*r[:4], i + 1 if i < n else None) for i, r in enumerate(able)]
    return sorted(ranked + [(*r[:4], None) for r in rows if r[4] < min_words], key=repr)


def corpus(n=300):
    rng = random.Random(9)
    docs = [(i, odd(rng)) for i in range(n)] + [(7, "a x1 the b"), (n, None), (n + 1, ""), (None, "the a é x1 the"), (None, "the a é x1 the")]
    docs += [(n + 2, "a the x1 é 0 " * 4000)] + [(5, "the é a x1 0 a")] * 4
    return docs, [odd(rng) for _ in range(20)] + [None, ""]


def test_resample_equals_brute_force(spark):
    docs, target = corpus()
    frame = spark.createDataFrame([(d, x, "z", 1) for d, x in docs], SCHEMA + ", score string, rank int").repartition(5)
    goal = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    for sizes, buckets, percent, least in ((1, 50, 30, 3), (3, 70_000, 60, 0), (2, 997, 100, 5)):
        got = resample(frame, goal, sizes, buckets, min_words=least, percent=percent)
        want = by_hand(docs, target, range(1, sizes + 1), buckets, percent, least)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_nothing_drawn_and_nothing_there(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    got = sorted(tuple(r)[::4] for r in resample(docs, docs.limit(0)).collect())
    assert got == [(1, None), (2, None)]
    assert resample(docs.where("false"), docs).collect() == []
