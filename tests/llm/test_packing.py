import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tradelens.llm.packing import default_vocabulary, pack, powers
from tradelens.llm.tokens import Encoder


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(4)
    bits = ["the", "it's", " ", "  ", "\n", "\n\n", "\t", "é", "Ünï", "12", "3.4", "!!", "\x1c", "\xa0", "　", "<|endoftext|>",
            "'s", "日本語", "😀", "a'll", "\r\n", "x" * 90, "\x85", "don't", "​", "́"]
    for _ in range(1500):
        yield "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))


def test_encoder_equals_tokenizers(plain):
    encoder = Encoder(default_vocabulary(), limit=40)
    for t in odd_texts():
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == plain(t), repr(t)


def check(spark, rows, plain, **kw):
    got = [r.asDict() for r in pack(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3), **kw).collect()]
    ids = {}
    for d, _, t in rows:
        ids[d] = [*plain(t or ""), 0]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    copies = defaultdict(int)
    for d, _, _ in rows:
        copies[d] += 1
    for d, want in ids.items():
        covered = np.zeros(len(want), int)
        for r in by_doc[d]:
            part = want[r["start"] : r["start"] + r["length"]]
            covered[r["start"] : r["start"] + r["length"]] += 1
            assert r["doc_tokens"] == len(want) and r["length"] == len(part) > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert (covered == copies[d]).all()
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0  # a power of two: never padded
    return by_sequence


def test_pack_covers_every_token(spark, plain):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "b", "c", None, ""]), t) for i, t in enumerate(odd_texts())]
    rows += [(5000, "a", None), (5001, "b", ""), (5002, "c", "word " * 6000), (5003, "a", "same"), (5003, "a", "same")]
    check(spark, rows, plain)


def test_windows_follow_targets(spark, plain):
    rng = random.Random(3)
    rows = [(i, "abc"[min(2, i % 6)], " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randint(1, 400)))) for i in range(900)]
    for targets in (None, {"a": 1, "b": 2, "c": 1}):
        by_sequence = check(spark, rows, plain, targets=targets)
        full = [k for k in sorted(by_sequence) if sum(r["length"] for r in by_sequence[k]) == 1024]
        tokens = defaultdict(int)
        for k in by_sequence:
            for r in by_sequence[k]:
                tokens[r["source"]] += r["length"]
        weight = targets or tokens
        shares = {s: weight[s] / sum(weight.values()) for s in "abc"}
        served, upto = defaultdict(int), len(full) * 2 // 3 if targets is None else 20
        for n, k in enumerate(full[:upto], 1):
            for r in by_sequence[k]:
                served[r["source"]] += r["length"]
            for s in "abc":  # the deficit stays below two quanta (and rounding of the shares)
                assert abs(served[s] - shares[s] * 1024 * n) <= 256 + 0.01 * 1024 * n, (n, s, dict(served))


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
    assert powers(0) == [] and powers(13) == [8, 4, 1]
