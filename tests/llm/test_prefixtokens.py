import random

import numpy as np
import pytest
from test_packing import odd_texts

from tradelens.llm.packing import default_vocabulary
from tradelens.llm.prefixtokens import PrefixCounter, longest_prefixes, prefix_table, token_counts, tokens_at, truncated

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def count():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())  # special strings as by default
    return lambda x: len(t.encode(x, add_special_tokens=False).ids)


def by_hand(text, count):
    return [count(text[:i]) for i in range(1, len(text) + 1)]


def test_every_prefix_of_odd_texts(count):
    counter = PrefixCounter(default_vocabulary(), limit=40)
    for text in odd_texts():
        assert counter.counts(text).tolist() == by_hand(text, count), repr(text)


def test_long_runs_and_contractions(count):
    counter = PrefixCounter(default_vocabulary())
    rng = random.Random(2)
    texts = ["'re", "x'll", " 'veto", "we'reached'", "a" * 300, "日本語" * 80, "\n" * 70 + " x", "=" * 200, "0123456789" * 20,
             "<|endoftext|>", "a <|endoftext|>\n<|endoftext|><|endoftex"]
    texts += ["".join(rng.choice("abcdeE ") for _ in range(200)) for _ in range(20)]
    for text in texts:
        assert counter.counts(text).tolist() == by_hand(text, count), repr(text)


def test_a_very_long_word_is_linear(count):
    text = "".join(random.Random(5).choice("etaoinshr") for _ in range(300_000))
    counts = PrefixCounter(default_vocabulary()).counts(text)
    assert counts[-1] == count(text) and counts[9_999] == count(text[:10_000])


def documents(spark):
    texts = ["", None, "one two three " * 90, "<|endoftext|>", *list(odd_texts())[:60]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, "no id")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_token_counts(spark, count):
    rows, docs = documents(spark)
    got = [tuple(r) for r in token_counts(docs.selectExpr("doc_id", "'x' AS n_tokens", "text", "1 AS n_bytes"), limit=100).collect()]
    want = []
    for d, t in rows:
        counts = by_hand(t or "", count)
        inside = max((i + 1 for i, c in enumerate(counts) if c <= 100), default=0)
        n = counts[-1] if counts else 0
        want.append((d, len((t or "").encode()), n, n > 100, inside))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert token_counts(docs.where("false")).collect() == []


def test_questions_are_answered_from_the_table(spark, count):
    rows, docs = documents(spark)
    rows = [(d, t) for d, t in rows if d is not None and d != 2] + [(2, rows[2][1])]
    table = prefix_table(docs.dropDuplicates(["doc_id"]), block=16)
    asked = [(d, n) for d, t in rows for n in (0, 1, 5, 16, 17, 300, len(t or ""))]
    got = {(r[0], r[1]): r[2] for r in tokens_at(table, spark.createDataFrame(asked, "doc_id long, n_chars int"), block=16).collect()}
    assert got == {(d, n): count(t[:n]) for d, t in rows for n in (1, 5, 16, 17, 300, len(t or "")) if t and 1 <= n <= len(t)}
    budgets = spark.createDataFrame([(d, b) for d, _ in rows for b in (0, 3, 40, 10_000)], "doc_id long, budget int")
    got = {(r[0], r[1]): r[2] for r in longest_prefixes(table, budgets).collect()}
    want = {}
    for d, t in rows:
        counts = by_hand(t or "", count)
        if counts:
            want |= {(d, b): max((i + 1 for i, c in enumerate(counts) if c <= b), default=0) for b in (0, 3, 40, 10_000)}
    assert got == want


def test_truncated_keeps_other_columns(spark, count):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, _tl_x string")
    got = sorted(tuple(r) for r in truncated(docs, 3).collect())
    assert got == [(1, "a b c", "x"), (2, None, "y"), (3, "", "z")]
    assert count(got[0][1]) == 3


def test_counts_are_integers_of_every_code_point():
    text = "naïve 😀 text"
    counts = PrefixCounter(default_vocabulary()).counts(text)
    assert len(counts) == len(text) and np.issubdtype(counts.dtype, np.integer)
