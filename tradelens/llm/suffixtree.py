"""Language-model scoring with a probabilistic suffix tree over bytes.

A text is its lower-cased words joined by single blanks, between a start and
an end mark (both the line end, which no word holds).  Symbols are bytes.

1. One pass over the training texts counts words and ``DEPTH + 1``-grams of
   symbols; the counts are summed by shuffles and grow with the corpus.
2. A context (up to ``DEPTH`` symbols) is a candidate if it makes up at least
   ``P_MIN`` of all positions: at most ``1 / P_MIN`` contexts of each length,
   which bounds the model.  It is retained if its next-symbol distribution
   diverges from that of the context without its oldest symbol by ``KL_MIN``
   bits or more (or if it is needed as the ending of a retained one).
3. Next-symbol distributions are smoothed towards the shorter context's
   (Witten-Bell), down to add-one counts over 256 symbols.
4. The tree becomes an automaton whose states are the retained contexts and
   their beginnings; after any symbols the state is the longest one that ends
   them.  Texts are cut into stretches that each warm up on the ``DEPTH``
   symbols before them, so all stretches of a batch advance together.

The base score (add-one word frequencies) needs every word's count.  Words of
relative frequency ``P_WORD`` or more (at most ``1 / P_WORD``) are broadcast,
the texts' other words are joined with the counts; those are rare by
definition, so no join key is hot.

Defined results: a null or empty text is its end token alone; a null id is
trained on (its remainder is that of ''); repeated rows count and are scored
each; with nothing to learn from all distributions are uniform; an empty table
gives no rows; a very long text is scored whole, in stretches.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import as_bytes, id_remainder, stored

DEPTH, P_MIN, KL_MIN, P_WORD = 4, 2e-5, 0.02, 1e-6
MODULUS, HELD_OUT = 7, 2
MARK = b"\n"
_BITS, _STRETCH = 9, 256


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def gram_codes(texts: list[list[bytes]], depth: int = DEPTH) -> np.ndarray:
    """A code per predicted symbol: the symbol in the lowest bits, above it the
    symbols before it, nearest first, as far as the start mark (each + 1)."""
    stream = MARK * depth + b"".join(b" ".join(w) + MARK for w in texts)
    s = np.frombuffer(stream, np.uint8).astype(np.int64) + 1
    n = len(s) - depth
    code, alive = s[depth:].copy(), np.ones(n, bool)
    for d in range(1, depth + 1):
        before = s[depth - d : depth - d + n]
        code |= np.where(alive, before, 0) << (_BITS * d)
        alive &= before != MARK[0] + 1
    return code


def _counts(depth: int):
    """Counts of words and grams of a task's texts, partly summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(word, code, n) -> pa.RecordBatch:
            size = len(n)
            columns = [pa.nulls(size, pa.string()) if word is None else pa.array(word, pa.binary()).cast(pa.string())]
            columns += [pa.nulls(size, pa.int64()) if code is None else pa.array(code), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "code", "n"])

        def merged(parts):
            codes = np.concatenate([c for c, _ in parts])
            order = np.argsort(codes, kind="stable")
            codes, n = codes[order], np.concatenate([n for _, n in parts])[order]
            first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
            return codes[first], np.add.reduceat(n, first) if len(first) else n

        for batch in batches:
            group, size = [], 0
            texts = as_bytes(batch.column(0))
            for i, text in enumerate(texts):
                w = words_of(text)
                words.update(w)
                words[b""] += 1
                group.append(w)
                size += len(text)
                if size > 1 << 21 or i + 1 == len(texts):
                    found.append(np.unique(gram_codes(group, depth), return_counts=True))
                    group, size = [], 0
            if sum(len(c) for c, _ in found) > 1 << 21:
                codes, sums = merged([(codes, sums), *found])
                found = []
                if len(codes) > 1 << 21:
                    yield rows(None, codes, sums)
                    codes, sums = codes[:0], sums[:0]
            if len(words) > 400_000:
                yield rows(list(words), None, list(words.values()))
                words.clear()
        if words:
            yield rows(list(words), None, list(words.values()))
        codes, sums = merged([(codes, sums), *found])
        if len(codes):
            yield rows(None, codes, sums)

    return run


def corpus_counts(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``word, code, n``: counts of all words ('' is the end token) and grams."""
    rows = texts.select("text").mapInArrow(_counts(depth), "word string, code long, n long")
    return stored(rows.groupBy("word", "code").agg(F.sum("n").alias("n")), "pst-counts")


def retained_contexts(counts: DataFrame, depth: int = DEPTH, p_min: float = P_MIN, kl_min: float = KL_MIN) -> DataFrame:
    """``d, ctx, a, n``: next-symbol counts of the root and the retained contexts."""
    grams = counts.where("code IS NOT NULL")
    each = []
    for d in range(depth + 1):
        ctx = F.shiftright("code", _BITS).bitwiseAND(F.lit((1 << _BITS * d) - 1))
        there = F.lit(True) if d == 0 else F.shiftright(ctx, _BITS * (d - 1)) != 0
        each.append(F.when(there, F.struct(F.lit(d).alias("d"), ctx.alias("ctx"))))
    symbol = F.col("code").bitwiseAND(F.lit((1 << _BITS) - 1)).alias("a")
    rows = grams.select(F.explode(F.array_compact(F.array(*each))).alias("c"), symbol, "n")
    follow = stored(rows.groupBy("c.d", "c.ctx", "a").agg(F.sum("n").alias("n")), "pst-follow")
    positions = follow.where("d = 0").agg(F.sum("n")).first()[0] or 0
    totals = follow.groupBy("d", "ctx").agg(F.sum("n").alias("total")).where(F.col("total") >= p_min * positions)
    candidates = stored(follow.join(totals, ["d", "ctx"]), "pst-candidates")
    parent = candidates.select(
        (F.col("d") + 1).alias("d"), F.col("ctx").alias("parent"), "a", (F.col("n") / F.col("total")).alias("q")
    )
    child = candidates.where("d > 0").withColumn("parent", F.expr(f"ctx & (shiftleft(1L, {_BITS} * (d - 1)) - 1)"))
    p = F.col("n") / F.col("total")
    kl = child.join(parent, ["d", "parent", "a"]).groupBy("d", "ctx").agg(F.sum(p * F.log2(p / F.col("q"))).alias("kl"))
    endings = F.explode(F.sequence(F.lit(0), F.col("d"))).alias("d")
    kept = kl.where(F.col("kl") >= kl_min).select("ctx", endings)
    kept = kept.select("d", F.expr(f"ctx & (shiftleft(1L, {_BITS} * d) - 1)").alias("ctx")).distinct()
    root = follow.where("d = 0").select("d", "ctx", "a", "n")
    return candidates.where("d > 0").join(kept, ["d", "ctx"], "left_semi").select("d", "ctx", "a", "n").union(root)


class Automaton:
    """``step``: next state, ``logp``: log10 probability, both by
    ``state * width + class``; ``classes`` maps bytes.  The last class fills
    up stretches: it leads to the root and costs nothing."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        symbols = sorted({a - 1 for _, _, a, _ in rows} | {MARK[0]})
        self.unseen, self.fill = len(symbols), len(symbols) + 1
        self.width = width = len(symbols) + 2
        self.classes = np.full(256, self.unseen, np.uint8 if width <= 256 else np.uint16)
        self.classes[symbols] = np.arange(len(symbols))
        column = {s + 1: k for k, s in enumerate(symbols)}

        def path(d: int, ctx: int) -> tuple[int, ...]:
            """Classes of a context, oldest first."""
            return tuple(column[ctx >> _BITS * k & (1 << _BITS) - 1] for k in range(d - 1, -1, -1))

        counts: dict[tuple[int, ...], np.ndarray] = {(): np.zeros(width)}
        for d, ctx, a, n in rows:
            counts.setdefault(path(d, ctx), np.zeros(width))[column[a]] += n
        nodes = sorted({p[:k] for p in counts for k in range(len(p) + 1)}, key=lambda p: (len(p), p))
        number = {p: i for i, p in enumerate(nodes)}
        children: dict[tuple[int, ...], list[tuple[int, ...]]] = {}
        for p in nodes[1:]:
            children.setdefault(p[:-1], []).append(p)
        prob = np.empty((len(nodes), width))
        step = np.zeros((len(nodes), width), np.int32)
        own: dict[tuple[int, ...], int] = {}
        for i, p in enumerate(nodes):
            if not p:
                c = counts[p]
                prob[0] = (c + 1) / (c.sum() + 256)
                fail = 0
            else:
                fail = number[next(p[k:] for k in range(1, len(p) + 1) if p[k:] in number)]
                c = counts.get(p)
                if c is None:
                    prob[i] = prob[fail]
                else:  # the shorter context is retained as well
                    seen = np.count_nonzero(c)
                    prob[i] = (c + seen * prob[own[p[1:]]]) / (c.sum() + seen)
                step[i] = step[fail]
            if p in counts:
                own[p] = i
            for child in children.get(p, ()):
                step[i, child[-1]] = number[child]
            step[i, self.fill] = 0
        self.states = len(nodes)
        logp = np.log10(prob)
        logp[:, self.fill] = 0
        self.step, self.logp = (step * width).ravel(), logp.ravel()

    def plain(self) -> tuple:
        """The automaton as arrays and numbers, for a broadcast: an object of this
        class would need the package on the workers."""
        return self.unseen, self.fill, self.width, self.classes, self.step, self.logp

    @classmethod
    def of(cls, plain: tuple) -> "Automaton":
        self = cls.__new__(cls)
        self.unseen, self.fill, self.width, self.classes, self.step, self.logp = plain
        return self

    def score(self, texts: list[list[bytes]], depth: int = DEPTH, stretch: int = _STRETCH) -> np.ndarray:
        """log10 probability of each text, its end included."""
        size = np.array([sum(map(len, w)) + max(0, len(w) - 1) + 1 for w in texts], np.int64)
        pad = np.full(stretch, self.fill, self.classes.dtype)
        head = np.r_[pad[: depth - 1], self.classes[MARK[0]]].astype(self.classes.dtype)
        parts, begin, at = [], [], 0
        for w, n in zip(texts, size, strict=True):
            parts += [head, self.classes[np.frombuffer(b" ".join(w) + MARK, np.uint8)], pad]
            begin.append(at)
            at += depth + int(n) + stretch
        stream = np.concatenate(parts)
        pieces = -(-size // stretch)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.array(begin)[owner] + nth * stretch
        total = np.empty(len(starts))
        for a in range(0, len(starts), 16384):
            here = starts[a : a + 16384]
            state, acc = np.zeros(len(here), np.int64), np.zeros(len(here))
            for k in range(depth + stretch):
                # A stretch's own text ends where the next one of it starts.
                where = state + stream[here + k]
                if k >= depth:
                    acc += self.logp.take(where)
                state = self.step.take(where).astype(np.int64)
            total[a : a + 16384] = acc
        return np.bincount(owner, total, len(texts))


def _scored(model, heavy):
    names = ["uid", "doc_id", "held_out", "n_tokens", "known", "logs", "score", "words", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        automaton, counts = Automaton.of(model.value), heavy.value
        for batch in batches:
            texts, a, size = as_bytes(batch.column(2)), 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size <= 1 << 21 and i + 1 < len(texts):
                    continue
                part = batch.slice(a, i + 1 - a)
                split = [words_of(t) for t in texts[a : i + 1]]
                tokens, known, logs, rare = [], [], [], []
                for w in split:
                    got = Counter(w)
                    got[b""] = 1
                    hits = [(n, counts[x]) for x, n in got.items() if x in counts]
                    tokens.append(len(w) + 1)
                    known.append(sum(n for n, _ in hits))
                    logs.append(float(sum(n * v for n, v in hits)))
                    rare.append([(x, n) for x, n in got.items() if x not in counts])
                words = pa.array([[x for x, _ in r] for r in rare], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
                times = pa.array([[n for _, n in r] for r in rare], pa.list_(pa.int32()))
                ids = pa.array(np.arange(uid, uid + len(split)))
                uid += len(split)
                columns = [ids, part.column(0), part.column(1), pa.array(tokens), pa.array(known, pa.int64())]
                columns += [pa.array(logs), pa.array(automaton.score(split)), words, times]
                yield pa.RecordBatch.from_arrays(columns, names)
                a, size = i + 1, 0

    return run


def suffix_tree_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` of every document."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (id_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "text"
    )
    counts = corpus_counts(rows.where("NOT held_out"))
    words = counts.where("word IS NOT NULL").select("word", "n")
    train_tokens, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    model = Automaton([tuple(r) for r in retained_contexts(counts).collect()])  # bounded by P_MIN
    frequent = words.where(F.col("n") >= P_WORD * train_tokens).collect()  # at most 1 / P_WORD words
    heavy = {r["word"].encode(): float(np.log10(r["n"] + 1)) for r in frequent}
    broadcast = spark.sparkContext.broadcast
    schema = (
        "uid long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, "
        "words array<string>, times array<int>"
    )
    scored = stored(rows.mapInArrow(_scored(broadcast(model.plain()), broadcast(heavy)), schema), "pst-scored")
    rare = scored.select("uid", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rare = rare.select("uid", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    met = rare.join(words, "word").groupBy("uid").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs")
    )
    joined = scored.drop("words", "times").join(met, "uid", "left")
    floor = float(np.log10(train_tokens + vocabulary + 1))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
        "score",
    )
