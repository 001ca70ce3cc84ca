import random
import re
from collections import Counter, defaultdict

from tradelens.llm.collocations import collocations, frequent_phrases

SCHEMA = "doc_id long, lang string, text string"


def by_hand(docs, least, longest, best):
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in docs:
        lang = lang or "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = []
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in some.items():
            around = [x for x, b in some.items() if len(x) > len(p) and 100 * b >= 100 * a and any(x[i : i + len(p)] == p for i in range(len(x) - len(p) + 1))]
            if around:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), k))
        for rank, (score, a, phrase, k) in enumerate(sorted(kept)[:best], 1):
            w = tuple(phrase.decode().split(" "))
            out.append((lang, rank, phrase.decode(), -a, counts[w[:k]], counts[w[k:]], n[lang], -score))
    return sorted(out)


def corpus(n=400):
    rng = random.Random(11)
    usual = ["the", "Of", "a", "é", "\x1f", "日本", "x-y", "Zq", "in", "to"]
    fixed = ["New York City hall", "once upon a time there", "a a a a", "é . é", "q q z"]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(usual) + str(rng.choice(["", "", rng.randint(0, 40)])))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " ;"]))
        docs.append((i, rng.choice(["en", "en", "en", "ja", None]), "".join(parts)))
    docs += [(n, "en", None), (n + 1, "en", ""), (None, "xx", "one two three"), (n + 2, None, "a b " * 3000)] + docs[:30]
    return docs


def answers(spark, docs, **kw):
    frame = spark.createDataFrame([(d, x, t, "p", 1) for d, x, t in docs], SCHEMA + ", phrase string, n int").repartition(4)
    return sorted(tuple(r) for r in collocations(frame, **kw).collect())


def test_equals_brute_force(spark):
    docs = corpus()
    want = by_hand(docs, 12, 5, 40)
    assert len(want) > 40
    assert answers(spark, docs, min_count=12, best=40) == want
    assert answers(spark, docs, min_count=12, best=40, buffer=300, bits=10) == want  # small buffers, crowded bitmap


def test_border_failures_expand_until_closed(spark):
    docs = corpus(200)
    # The phrase is missing from the sample: none of its words can be proposed.
    from pyspark.sql import functions as F

    ids = spark.range(1000, 3000).where(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(8)) != 0).limit(40)
    docs += [(r.id, "en", "hidden gem of the coast") for r in ids.collect()]
    frame = spark.createDataFrame(docs, SCHEMA)
    got = {(r.lang, r.phrase): r.n for r in frequent_phrases(frame, min_count=30).collect() if r.words == 5}
    assert got[("en", "hidden gem of the coast")] == 40
    assert answers(spark, docs, min_count=30, best=50) == by_hand(docs, 30, 5, 50)


def test_products_beyond_64_bits(spark):
    from tradelens.llm.collocations import scored_phrases

    big = 10**13
    rows = [("en", "", 0, 9 * big), ("en", "a", 1, 7 * big), ("en", "b", 1, 3 * big), ("en", "a b", 2, 2 * big + 1)]
    got = scored_phrases(spark.createDataFrame(rows, "lang string, phrase string, words int, n long")).collect()
    assert [r.score for r in got] == [1000 * (2 * big + 1) * 9 * big // (7 * big * 3 * big)]


def test_empty_tables(spark):
    assert answers(spark, [], min_count=2) == []
    assert answers(spark, [(1, "en", None), (2, None, " . ")], min_count=1) == []
