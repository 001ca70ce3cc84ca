"""PII: pattern spans plus information-theoretic sanitisation (SQL functions only).

Base spans are e-mail addresses, IP addresses, card and phone numbers.  On top
of them, corpus co-occurrence tells which *terms* give a removed entity away.
The contexts are paragraphs (between
blank lines; a text without any is one paragraph).  For an entity ``e`` and a
term ``t`` that meet in ``n(e,t)`` paragraphs

    disclosure(t, e) = PMI(t; e) / IC(e) = 1 + log P(e|t) / log(N / n(e))

is the share of the entity's information content that the term reveals
(1: the term occurs only with the entity).  ``P(e|t)`` is the lower end of
Wilson's interval for ``n(e,t)`` out of ``n(t)``.  All counts, ``N`` and ``n(t)``
too, are over distinct paragraphs, so copies of a paragraph are one piece of
evidence for and against.

That a rare word stands beside an address once says nothing: every paragraph has
rare words.  So the meetings must also be more than chance.  Among the ``H``
paragraphs that hold any entity, of which ``h(t)`` hold the term, an unrelated
term meets ``e`` in ``h(t) n(e) / H`` paragraphs on average; the chance of
``n(e,t)`` or more (Chernoff's bound of the Poisson tail) must be at most
``ALPHA`` over the number of pairs tested (Bonferroni).  One meeting never
passes; two in a corpus of thousands of such paragraphs do.

In texts that hold ``e``, terms with a disclosure of ``GENERALISE`` or more become
``[TERM]``, terms at ``REMOVE`` or more go.  Terms are words of any length.  They are
found by tokenising a text once and joining its words with its terms, and
replaced by position, so labels and entities are never read as words.

The counting drops nothing that could reach ``GENERALISE``: as ``P(e|t)`` is
at most ``n(e) / n(t)``, terms above ``n(e) * (N / n(e)) ** (1 - GENERALISE)``
paragraphs are left out before pairs are made.  Entities met in the same
paragraphs have the same figures and are counted as one class, so a long list
of addresses does not pair each of them with every word; classes of one
paragraph cannot pass and pair with none.

Defined results: a null text is empty (no spans); repeated rows get the same
spans; ids are not read, so null and repeated ids do no harm; extra columns
are not read.  An empty table gives no rows.  A very long text costs time in
proportion to its length; its words are rows while its terms are found.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.common import shielded, stored

#: One-sided 95 % confidence of the share of a term's paragraphs that hold the entity.
Z = 1.645
#: Disclosure at which a term is replaced by ``[TERM]`` or removed.
GENERALISE, REMOVE = 0.8, 0.95
#: Chance of any false finding among all pairs tested.
ALPHA = 0.05

# The patterns match what the plain forms match, leftmost and without overlap,
# but start only where a run starts and never backtrack into one, so that long
# runs cost linear time and no stack.  Length limits of cards and phones are
# part of the pattern: their runs are maximal, so a run that fails has no part
# that could match instead.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9](?:[ ().-]*+[0-9]){7,14}+(?![ ().-]*+[0-9])"
IP_VALID = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"
KINDS = [("email", EMAIL, "@"), ("ip", IP, "."), ("card", CARD, None), ("phone", PHONE, "+")]
#: Order of replacement: a phone number may hold what looks like an address.
REPLACED = ["email", "phone", "card", "ip"]
_BLOCK = 64


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        v = F.substring(digits, i + 1, F.lit(1)).cast("int") * (1 + i % 2)
        return total + v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    return {"ip": lambda: match.rlike(IP_VALID), "card": lambda: _luhn(match)}.get(kind, lambda: F.lit(True))()


def _hits(text: Column, pattern: Column, hint: str | None) -> Column:
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return found if hint is None else F.when(F.contains(text, F.lit(hint)), found).otherwise(F.array().cast("array<string>"))


def _parts(text: Column, pattern: Column, hits: Column) -> Column:
    """The stretches before the matches (one before each)."""
    return F.when(F.size(hits) > 0, F.slice(F.split(text, pattern, -1), 1, F.size(hits))).otherwise(F.array().cast("array<string>"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _block_sums(lengths: Column) -> Column:
    starts = F.sequence(F.lit(0), F.floor(F.size(lengths) / _BLOCK).cast("int"))
    return F.transform(starts, lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))


def _spans(kind: str, parts: Column, hits: Column, lengths: Column, blocks: Column) -> Column:
    """Valid matches with their code point positions.  ``lengths`` holds the
    length of each stretch with its match, ``blocks`` their sums by 64, so that
    a position costs two short sums."""

    def span(match: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        before = _sum(F.slice(blocks, F.lit(1), block)) + _sum(F.slice(lengths, block * _BLOCK + 1, i % _BLOCK))
        start = before + F.char_length(F.get(parts, i))
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.char_length(match)).alias("end"),
            match.alias("value"), _valid(kind, match).alias("ok"),
        )

    return F.filter(F.transform(hits, span), lambda s: s["ok"])


def with_spans(df: DataFrame, text: str, kinds: list[tuple[str, Column, str | None]], prefix: str = "_tl_") -> DataFrame:
    """Adds ``{prefix}{kind}`` arrays of spans found in column ``text``."""
    df = df.withColumns({f"{prefix}h_{k}": _hits(F.col(text), p, hint) for k, p, hint in kinds})
    df = df.withColumns({f"{prefix}p_{k}": _parts(F.col(text), p, F.col(f"{prefix}h_{k}")) for k, p, _ in kinds})
    size = {
        k: F.zip_with(
            F.col(f"{prefix}p_{k}"), F.col(f"{prefix}h_{k}"), lambda a, b: (F.char_length(a) + F.char_length(b)).cast("long")
        )
        for k, _, _ in kinds
    }
    df = df.withColumns({f"{prefix}l_{k}": c for k, c in size.items()})
    df = df.withColumns({f"{prefix}b_{k}": _block_sums(F.col(f"{prefix}l_{k}")) for k, _, _ in kinds})
    spans = {
        f"{prefix}{k}": _spans(k, *(F.col(f"{prefix}{c}_{k}") for c in "phlb"))
        for k, _, _ in kinds
    }
    return df.withColumns(spans).drop(*(f"{prefix}{c}_{k}" for c in "hplb" for k, _, _ in kinds))


def _base_kinds() -> list[tuple[str, Column, str | None]]:
    return [(k, F.lit(p), hint) for k, p, hint in KINDS]


def _any_entity(text: Column) -> Column:
    """Whether a text may hold an entity (validity is not yet tested)."""
    tests = [F.contains(text, F.lit(hint)) & text.rlike(p) if hint else text.rlike(p) for _, p, hint in KINDS]
    return tests[0] | tests[1] | tests[2] | tests[3]


#: What stands between terms: ASCII characters other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Counted once per paragraph along with its terms; no paragraph's term.
PARAGRAPH = "\n"
#: What stands between paragraphs.
BLANK = r"\n[ \t\r]*+\n"


def _terms(text: Column) -> Column:
    """Distinct words of a text in lower case."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), BETWEEN)), "")


def _masked(text: Column) -> Column:
    for _, p, _ in KINDS:
        text = F.regexp_replace(text, p, " ")
    return text


def _paragraphs(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode(F.split("text", BLANK)).alias("text"))


def _holding(texts: DataFrame) -> DataFrame:
    """``key, entities, terms`` of each distinct text that holds an entity;
    ``terms`` are its other words."""
    found = texts.where(_any_entity(F.col("text"))).select("text").distinct()

    def entities(kind: str, pattern: str, hint: str | None) -> Column:
        hits = F.filter(_hits(F.col("text"), F.lit(pattern), hint), lambda m: _valid(kind, m))
        return F.transform(hits, lambda m: _entity_key(kind, m))

    all_kinds = F.array_distinct(F.concat(*(entities(*k) for k in KINDS)))
    terms = _terms(_masked(F.col("text")))
    rows = found.select(F.xxhash64("text").alias("key"), all_kinds.alias("entities"), terms.alias("terms"), "text")
    return rows.where(F.size("entities") > 0)


def _entity_key(kind: str, match: Column) -> Column:
    value = F.regexp_replace(match, "[^0-9]", "") if kind in ("card", "phone") else F.lower(match)
    return F.concat(F.lit(f"{kind}:"), value)


def _term_counts(texts: DataFrame) -> DataFrame:
    """``term, n_t``: the distinct paragraphs that hold a term outside entities,
    and under ``PARAGRAPH`` all."""
    words = _terms(F.when(_any_entity(F.col("text")), _masked(F.col("text"))).otherwise(F.col("text")))
    counted = _paragraphs(texts).distinct().select(F.explode(F.concat(words, F.array(F.lit(PARAGRAPH)))).alias("term"))
    return counted.groupBy("term").agg(F.count("*").alias("n_t"))


def _disclosure(n_et: Column, n_t: Column, n_e: Column, n: int) -> Column:
    n_t = F.greatest(n_t, n_et).cast("double")
    p, z2 = n_et / n_t, Z * Z
    low = (p + z2 / (2 * n_t) - Z * F.sqrt(p * (1 - p) / n_t + z2 / (4 * n_t * n_t))) / (1 + z2 / n_t)
    return 1 + F.log(low) / F.log(F.lit(float(n)) / n_e)


def _log_chance(met: Column, expected: Column) -> Column:
    """Chernoff's bound of the logarithm of P(Poisson(expected) >= met)."""
    return F.when(met > expected, met - expected - met * F.log(met / expected)).otherwise(F.lit(0.0))


def _evidence(texts: DataFrame, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """``entity, class`` (entities of the same paragraphs are one class) and
    ``class, term, disclosure`` of the terms that reveal them."""
    spark = texts.sparkSession
    seen = stored(_holding(_paragraphs(texts.where(_any_entity(F.col("text"))))).drop("text"), "pii-paragraphs")
    held = seen.select("key", F.explode("entities").alias("entity"))
    marks = [F.count("*"), F.bit_xor("key"), F.bit_xor(F.xxhash64("key", F.lit(1)))]
    classes = held.groupBy("entity").agg(*(m.alias(f"c{i}") for i, m in enumerate(marks)))
    classes = stored(classes.select("entity", F.concat_ws(":", "c0", "c1", "c2").alias("class"), F.col("c0").alias("n_e")), "pii-entities")
    words = seen.select("key", F.explode("terms").alias("term"))
    needed = words.select("term").distinct().union(spark.createDataFrame([(PARAGRAPH,)], "term string"))
    counts = stored(_term_counts(texts).join(needed, "term", "left_semi"), "pii-terms")
    total = counts.where(F.col("term") == PARAGRAPH).first()
    n, most = (total["n_t"] if total else 0), classes.agg(F.max("n_e")).first()[0] or 0

    def limit(n_e: Column) -> Column:
        """Paragraphs that a term may have at most (a hair more, for rounding)."""
        return n_e * F.pow(F.lit(float(n)) / n_e, F.lit(1 - generalise)) * (1 + 1e-9)

    words = words.join(counts.where(F.col("n_t") <= limit(F.lit(float(max(most, 1))))), "term")
    holders = held.join(classes, "entity").select("key", "class", "n_e").where((F.col("n_e") > 1) & (F.col("n_e") < n)).distinct()
    met = holders.join(words, "key").where(F.col("n_t") <= limit(F.col("n_e")))
    pairs = met.groupBy("class", "term").agg(F.count("*").alias("n_et"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
    pairs = stored(pairs, "pii-pairs")
    again = pairs.where("n_et > 1")
    around = seen.select(F.explode("terms").alias("term")).join(again.select("term").distinct(), "term", "left_semi")
    again = again.join(around.groupBy("term").agg(F.count("*").alias("n_h")), "term")
    size, tested = seen.count(), pairs.count()
    rate = _disclosure(F.col("n_et"), F.col("n_t"), F.col("n_e"), n)
    chance = _log_chance(F.col("n_et").cast("double"), F.col("n_h") * F.col("n_e") / F.lit(float(max(size, 1))))
    sure = chance <= math.log(ALPHA / max(tested, 1))
    flagged = again.where(sure).select("class", "term", rate.alias("disclosure")).where(F.col("disclosure") >= generalise)
    return classes.select("entity", "class"), stored(flagged, "pii-flagged")


def disclosing_terms(texts: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """``entity, term, disclosure`` of the terms that reveal an entity."""
    classes, flagged = _evidence(texts, generalise)
    return classes.join(flagged, "class").select("entity", "term", "disclosure")


def text_terms(texts: DataFrame, classes: DataFrame, flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``_tl_key, term, d``: the terms of a text (by its hash) that disclose one of
    its entities, and the disclosure; ``_tl_key, _tl_text`` of those texts."""
    found = stored(_holding(texts).withColumnRenamed("key", "_tl_key"), "pii-holding")
    held = found.select("_tl_key", F.explode("entities").alias("entity")).join(classes, "entity")
    held = held.select("_tl_key", "class").distinct()
    words = found.select("_tl_key", F.explode("terms").alias("term")).join(flagged.select("term").distinct(), "term")
    by_term = held.join(words, "_tl_key").join(flagged, ["class", "term"])
    by_term = stored(by_term.groupBy("_tl_key", "term").agg(F.max("disclosure").alias("d")), "pii-terms-of-texts")
    whole = found.select("_tl_key", F.col("text").alias("_tl_text")).join(by_term.select("_tl_key").distinct(), "_tl_key", "left_semi")
    return by_term, whole


def _tokens(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """``_tl_key, at, token, d``: all words and stretches between words of the
    texts, in order; ``d`` where the word is one of the text's terms."""
    pattern = F.lit(f"[{BETWEEN[1:-2]}]++|[^{BETWEEN[1:-2]}]++")
    tokens = texts.select("_tl_key", F.posexplode(F.regexp_extract_all("_tl_text", pattern, F.lit(0))).alias("at", "token"))
    return tokens.withColumn("term", F.lower("token")).join(terms, ["_tl_key", "term"], "left").drop("term")


def term_spans(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """``_tl_key, _tl_term``: places of a text's terms, in order."""
    before = Window.partitionBy("_tl_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("token")
    start = F.coalesce(F.sum(size).over(before), F.lit(0))
    placed = _tokens(terms, texts).withColumn("start", start).where("d IS NOT NULL")
    span = F.struct(F.col("start"), (F.col("start") + size).alias("end"))
    return placed.groupBy("_tl_key").agg(F.array_sort(F.collect_list(span)).alias("_tl_term"))


# While terms are replaced, entities are pairs of control characters, which no
# word holds; the first of a pair that the text itself has is written as a pair.
_MARK = "\x01"
_MARKED = {"email": _MARK + "\x02", "phone": _MARK + "\x03", "card": _MARK + "\x04", "ip": _MARK + "\x05", "": _MARK + "\x06"}


def _marked(text: Column) -> Column:
    """The text with its entities as marks."""
    return F.replace(text, F.lit(_MARK), F.lit(_MARKED[""]))


def _labelled(text: Column) -> Column:
    for kind in REPLACED:
        text = F.replace(text, F.lit(_MARKED[kind]), F.lit(f"[{kind.upper()}]"))
    return F.replace(text, F.lit(_MARKED[""]), F.lit(_MARK))


def without_terms(terms: DataFrame, texts: DataFrame, remove: float = REMOVE) -> DataFrame:
    """``_tl_key, _tl_new``: texts with their entities marked and their terms
    generalised or removed."""
    marked = texts.withColumn("_tl_text", _marked(F.col("_tl_text")))
    kinds = {k: (p, hint) for k, p, hint in KINDS}
    for k in REPLACED:
        marked = marked.withColumn("_tl_text", _replaced(F.col("_tl_text"), k, *kinds[k]))
    token = F.when(F.col("d") >= remove, "").when(F.col("d").isNotNull(), "[TERM]").otherwise(F.col("token"))
    parts = _tokens(terms, marked).groupBy("_tl_key").agg(F.array_sort(F.collect_list(F.struct("at", token.alias("token")))).alias("t"))
    return parts.select("_tl_key", F.array_join(F.col("t")["token"], "").alias("_tl_new"))


def _prepared(docs: DataFrame, found) -> DataFrame:
    """``docs`` with ``text`` never null and what ``found`` says of texts with
    disclosing terms."""
    docs = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    texts = docs.select("text")
    # A stored table: the planner knows its size and broadcasts it only if small.
    terms = stored(found(*text_terms(texts, *_evidence(texts))), "pii-found")
    # Only texts with entities have terms: the others need not meet them.
    some = _any_entity(F.col("text"))
    keyed = docs.where(some).withColumn("_tl_key", F.xxhash64("text")).join(terms, "_tl_key", "left").drop("_tl_key")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in terms.schema if f.name != "_tl_key"]
    return docs.where(~some).select("*", *nothing).union(keyed)


def _joined(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def pii_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256`` and ``spans``.

    ``spans`` lists the base spans and then, as kind ``term``, the words that
    disclose an entity of the text and lie outside all base spans.
    """
    df = _prepared(docs.select("doc_id", "text"), term_spans)
    df = with_spans(df, "text", _base_kinds())
    df = df.withColumn("_tl_base", F.concat(*(F.col(f"_tl_{k}") for k, _, _ in KINDS)))
    terms = F.transform("_tl_term", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    base = F.transform("_tl_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    outside = F.filter(terms, lambda t: ~F.exists("_tl_base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    everything = F.when(F.col("_tl_term").isNotNull(), F.concat(base, outside)).otherwise(base)
    return df.select(
        "doc_id",
        *(F.size(f"_tl_{k}").cast("long").alias(f"n_{k}") for k, _, _ in KINDS),
        F.sha2(_joined(F.col("_tl_base")).cast("binary"), 256).alias("base_sha256"),
        _joined(everything).alias("spans"),
    )


def _replaced(text: Column, kind: str, pattern: str, hint: str | None) -> Column:
    """The text with a kind's valid matches as marks."""
    found = _hits(text, F.lit(pattern), hint)
    parts = F.split(text, pattern, -1)
    label = F.lit(_MARKED[kind])
    new = F.transform(found, lambda m: F.when(_valid(kind, m), label).otherwise(m))
    pieces = F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(new, i), F.lit(""))))
    return F.when(F.size(found) > 0, F.array_join(pieces, "")).otherwise(text)


@shielded
def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with entities in ``text`` generalised to ``[EMAIL]``,
    ``[PHONE]``, ``[CARD]``, ``[IP]`` and disclosing terms generalised or
    removed.  Columns and rows stay; a null text stays null."""
    names = docs.columns
    kinds = {k: (p, hint) for k, p, hint in KINDS}
    df = _prepared(docs.withColumn("_tl_null", F.col("text").isNull()), without_terms)
    df = df.withColumn("text", _marked(F.when(F.col("_tl_new").isNull(), F.col("text"))))
    for k in REPLACED:
        df = df.withColumn("text", _replaced(F.col("text"), k, *kinds[k]))
    df = df.withColumn("text", F.when(~F.col("_tl_null"), _labelled(F.coalesce("_tl_new", "text"))))
    return df.select(*names)
