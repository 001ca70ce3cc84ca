import hashlib
import math
import random
import re

from tradelens.llm import pii

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def card(rng, n):
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + c for c in "0123456789" if luhn(head + c))


def texts(rng, n):
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            kind = rng.randint(0, 6)
            if kind == 0:
                parts.append(card(rng, rng.choice([15, 16, 17, 19, 20])))
            elif kind == 1:
                c = card(rng, 16)
                parts.append("-".join(c[i : i + 4] for i in range(0, 16, 4)))
            elif kind == 2:
                parts.append(".".join(str(rng.randint(0, 300)) for _ in range(rng.randint(3, 9))))
            elif kind == 3:
                parts.append("+1 (234) 555-" + "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 9))))
            elif kind == 4:
                parts.append("".join(rng.choice("ab.@_%+-1é") for _ in range(rng.randint(3, 25))))
            else:
                parts.append("".join(rng.choice("+0123456789 .()-@aé😀\n") for _ in range(rng.randint(1, 40))))
        yield rng.choice(["", " ", "ñ"]).join(parts)


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(texts(rng, 1500))]
    rows += [(9001, None), (9002, ""), (9003, "a@b.c+d@e.f.@g.h"), (9004, "x@y.z " * 400), (9005, "1" * 50_000 + "@")]
    rows += [(9006, "a@" + "b." * 20_000 + "c"), (9007, "+1" + " -" * 20_000), (9007, "+1" + " -" * 20_000)]
    got = pii.pii_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    texts_of = {}
    for i, t in rows:
        texts_of[i] = t
    for r in got:
        want = brute(texts_of[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts_of[r.doc_id], want, r.spans)
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == want
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(x.startswith(k) for x in want) for k, _ in PLAIN
        )


def others(rng, n=300):
    """Paragraphs with an address and a rare word of their own."""
    return [f"w{rng.randint(0, 59)}x name{i} wrote from u{i}@z.org w{rng.randint(0, 59)}x" for i in range(n)]


def disclosing_corpus():
    """ann@x.org always comes with the rare word Quillon; 400 other lines and
    300 addresses that come once."""
    rng = random.Random(2)
    words = [f"w{i}x" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(400)]
    for i in range(5):
        rows.append((1000 + i, f"{rng.choice(words)} {rng.choice(words)} Quillon wrote from ann@x.org {i} {rng.choice(words)}"))
    rows.append((2000, "quillon met nobody"))
    rows += [(3000 + i, "zanzibarr copied line with bob@y.org") for i in range(9)]
    return rows + [(4000 + i, t) for i, t in enumerate(others(rng))]


def brute_flagged(texts):
    """Terms by entity, from the definitions, with plain loops."""
    paragraphs = {p for t in texts for p in re.split(r"\n[ \t\r]*\n", t or "")}
    n_t, n_h, holders, met = {}, {}, {}, {}
    for p in paragraphs:
        found, masked = entities_of(p)
        words = set(re.split(pii.BETWEEN, masked.lower())) - {""}
        for w in words:
            n_t[w] = n_t.get(w, 0) + 1
            if found:
                n_h[w] = n_h.get(w, 0) + 1
        for e in found:
            holders.setdefault(e, set()).add(p)
            for w in words:
                met[e, w] = met.get((e, w), 0) + 1
    n, size = len(paragraphs), len({p for ps in holders.values() for p in ps})
    classes = {e: frozenset(ps) for e, ps in holders.items() if len(ps) > 1}
    bound = {e: len(ps) * (n / len(ps)) ** (1 - pii.GENERALISE) * (1 + 1e-9) for e, ps in holders.items()}
    tested = len({(classes[e], w) for e, w in met if e in classes and n_t[w] <= bound[e]})
    out = {}
    for (e, w), k in met.items():
        if e not in classes or k < 2 or n_t[w] > bound[e]:
            continue
        expected = n_h[w] * len(classes[e]) / size
        chance = k - expected - k * math.log(k / expected) if k > expected else 0.0
        share, z2, t = k / n_t[w], pii.Z**2, n_t[w]
        low = (share + z2 / (2 * t) - pii.Z * math.sqrt(share * (1 - share) / t + z2 / (4 * t * t))) / (1 + z2 / t)
        d = 1 + math.log(low) / math.log(n / len(classes[e]))
        if chance <= math.log(pii.ALPHA / tested) and d >= pii.GENERALISE:
            out[e, w] = d
    return out


def entities_of(text):
    found, masked = [], text
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            if f"{kind}:{m.start()}:{m.end()}" in brute(text):
                value = re.sub("[^0-9]", "", m.group()) if kind in ("card", "phone") else m.group().lower()
                found.append(f"{kind}:{value}")
        masked = re.sub(pattern, " ", masked)
    return set(found), masked


def brute_spans(text, flagged):
    base = brute(text)
    terms = {w for e, w in flagged if e in entities_of(text)[0]}
    places = [tuple(map(int, x.split(":")[1:])) for x in base]
    words = [(m.start(), m.end()) for m in re.finditer("[^" + pii.BETWEEN[1:-2] + "]+", text) if m.group().lower() in terms]
    return base + [f"term:{a}:{b}" for a, b in words if not any(x < b and a < y for x, y in places)]


def test_disclosing_terms(spark):
    df = spark.createDataFrame(disclosing_corpus(), "doc_id long, text string")
    flagged = {(r.entity, r.term): r.disclosure for r in pii.disclosing_terms(df.select("text")).collect()}
    want = brute_flagged([t for _, t in disclosing_corpus()])
    assert set(flagged) == set(want) == {("email:ann@x.org", "quillon")}
    assert all(math.isclose(flagged[k], want[k], rel_tol=1e-9) for k in want)
    spans = {r.doc_id: r.spans for r in pii.pii_spans(df).collect()}
    assert {i: s for i, s in spans.items()} == {i: ",".join(brute_spans(t, want)) for i, t in disclosing_corpus()}
    assert "term:" in spans[1000] and "term:" not in spans[2000] and "term:" not in spans[3000]


def test_one_meeting_is_no_evidence(spark):
    """A paragraph of 20,000 words that occur nowhere else, and one address."""
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(others(rng))] + [(999, " ".join(f"only{i}" for i in range(20_000)) + " mail lone@x.org")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.disclosing_terms(df.select("text")).count() == 0


def test_long_paragraphs_with_many_terms(spark):
    """Six paragraphs share 20,000 words that come with one address only."""
    import time

    rng = random.Random(4)
    words = " ".join(f"Only{i}" for i in range(20_000))
    rows = [(i, t) for i, t in enumerate(others(rng))] + [(1000 + i, f"{words} {words} w{i}x ann@x.org {words}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    begin = time.time()
    got = {r.doc_id: r for r in pii.pii_spans(df).collect()}
    assert time.time() - begin < 120
    assert got[1000].spans.count("term:") == 60_000 and got[3].spans.count("term:") == 0
    assert got[1000].spans.split(",")[1] == "term:0:5"


def test_names_of_two_characters_and_names_in_the_next_line(spark):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(others(rng))]
    rows += [(5000 + i, f"w{i}x Bo w2x\n李明 w3x zeb@x.org\n\nFarquhar w4x") for i in range(5)] + [(5009, "w5x Farquhar w6x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term) for r in pii.disclosing_terms(df.select("text")).collect()}
    assert {("email:zeb@x.org", "bo"), ("email:zeb@x.org", "李明")} <= got and set(brute_flagged([t for _, t in rows])) == got
    text = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "Bo" not in text[5000] and "李明" not in text[5000] and "[EMAIL]" in text[5000] and text[5009] == "w5x Farquhar w6x"


def test_labels_are_no_words(spark):
    """The word of a label is itself a disclosing term; the text has marks."""
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(others(rng))]
    rows += [(900 + i, f"w{i}x phone Term Zed\x01\x02\x06 +1 (234) 555-12345 [TERM] w{i + 1}x") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    flagged = {r.term for r in pii.disclosing_terms(df.select("text")).collect()}
    assert flagged == {"phone", "zed", "term"}
    text = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    cut = {"phone", "Term", "Zed"}
    assert text[901].count("[PHONE]") == 1 and not cut & set(re.findall("[A-Za-z]+", text[901].replace("[TERM]", "").replace("[PHONE]", "")))
    assert "\x01\x02\x06 [PHONE]" in text[901] and text[901].startswith("w1x ") and text[901].endswith(" w2x")


def test_copies_neither_hide_nor_make_a_term(spark):
    rng = random.Random(4)
    rows = [(f"w{i}y " + " ".join(f"w{rng.randint(0, 90)}x" for _ in range(12)),) for i in range(2000)] + [(t,) for t in others(rng)]
    met = [(f"w{i}x Zebedee wrote w{i + 1}x from zeb@x.org",) for i in range(3)]

    def found(times):
        df = spark.createDataFrame(rows + met * times, "text string")
        return {(r.entity, r.term): r.disclosure for r in pii.disclosing_terms(df).collect()}

    once, often = found(1), found(300)
    assert set(once) == {("email:zeb@x.org", "zebedee")}
    assert once == often


def test_extra_columns_with_helpers_names(spark):
    rows = [(i, t, "a", 1) for i, t in disclosing_corpus()]
    df = spark.createDataFrame(rows, "doc_id long, text string, _tl_key string, spans int")
    assert sorted(map(tuple, pii.pii_spans(df).collect())) == sorted(map(tuple, pii.pii_spans(df.select("doc_id", "text")).collect()))


def test_sanitised_text(spark):
    rows = [(*r, "s") for r in disclosing_corpus()] + [(1, None, "x"), (None, "", None)]
    rows.append((7, "call +1 (234) 555-1234 or 10.0.0.1 or 999.1.1.1 card 4111 1111 1111 1111", "y"))
    df = spark.createDataFrame(rows, "doc_id long, text string, _tl_x string")
    out = pii.sanitised(df)
    assert out.columns == df.columns and out.count() == len(rows)
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[7] == "call [PHONE] or [IP] or 999.1.1.1 card [CARD]"
    assert "ann@" not in text[1000] and "Quillon" not in text[1000] and "[EMAIL]" in text[1000]
    assert text[2000] == "quillon met nobody" and text[None] == ""
    assert sum(r.text is None for r in out.collect()) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.pii_spans(df).count() == 0 and pii.sanitised(df).count() == 0


def test_texts_without_entities_are_not_shuffled(spark):
    """Only texts with entities meet the terms; the rest pass by, whatever the join."""
    docs = [*disclosing_corpus(), (9000, "plain words only"), (9001, None), (9002, "a@b.cd alone")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pii.pii_spans(df)
        assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r.doc_id: r.spans for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    flagged = brute_flagged([t or "" for _, t in docs])
    assert got == {i: ",".join(brute_spans(t or "", flagged)) for i, t in docs}
