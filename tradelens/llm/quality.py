"""Quality rules: gradient-boosted trees over document statistics.

One pass over the texts computes statistics (word counts, symbols, repeated
lines and word windows ...).  A boosted ensemble is trained in numpy on a
bounded sample of labelled rows, flattened into node arrays, and scores every
document inside the same pass.  Features listed in ``MONOTONE`` can only move
the score in the stated direction.

Defined results: a null or empty text has zero statistics and fails the base
rule (fewer than 20 words).  Repeated rows are scored alike, one result each.
Null labels are ignored; repeated labels of one id are averaged.  Without both
classes among the labels, or with fewer than 20 labelled documents found in
the table, there is no model, ``quality`` is null and only the base rule
decides: so few rows make hardly a split, and their mean would judge every text.
Other columns of the input are not read.  An empty table gives no rows; a very
long text is read whole, in time and memory proportional to its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import as_bytes, hashed_sample

#: Labelled documents used for training, chosen by the hash of their id.
SAMPLE = 20_000
#: Documents whose predicted probability of good quality is lower are rejected.
THRESHOLD = 0.5
WINDOW = 8

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "distinct_rate", "upper_rate",
    "digit_rate", "bang_rate", "top_word_rate", "words_per_line", "stop_line_rate", "longest_word", "non_ascii_rate",
]
#: Direction in which a feature may move the quality score.
MONOTONE = {"symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "bang_rate": -1, "top_word_rate": -1}

_SYMBOLS = list(b"#*$%&|<>")
_P = np.uint64(0x9E3779B97F4A7C15)
_P2 = np.uint64(0x9E3779B97F4A7C15**2 & (2**64 - 1))
_P4 = np.uint64(0x9E3779B97F4A7C15**4 & (2**64 - 1))


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Positions covered by ``window``-word windows that occur twice or more.

    Hashes of the windows rule out most texts; where two hashes are equal the
    windows are numbered exactly by doubling (1, 2, 4, 8 words).
    """
    assert window == 8
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h[:-1] * _P + h[1:]
    h = h[:-2] * _P2 + h[2:]
    h = h[:-4] * _P4 + h[4:]
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    code = ids.astype(np.int64)
    for step in (1, 2, 4):
        pair = code[:-step] * (int(code.max()) + 1) + code[step:]
        code = np.unique(pair, return_inverse=True)[1]
    again = np.bincount(code)[code] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(again)
    edge[starts] += 1
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The five base counts and the features of one text (UTF-8)."""
    words = text.split()
    n = len(words)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    chars = int(hist.sum() - hist[128:192].sum())
    word_chars = chars - int(hist[32] + hist[9:14].sum())
    symbols = int(hist[_SYMBOLS].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    if not n:
        return [0, word_chars, symbols, dup, 0], [0.0] * len(FEATURES)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeat = repeated_words(ids)
    stops = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    return [n, word_chars, symbols, dup, repeat], [
        float(np.log1p(n)),
        word_chars / n,
        symbols / n,
        dup / len(lines),
        repeat / n,
        len(number) / n,
        float(hist[65:91].sum()) / chars,
        float(hist[48:58].sum()) / chars,
        float(hist[33]) / n,
        float(np.bincount(ids).max()) / n,
        n / len(lines),
        stops / len(lines),
        float(min(200, max(map(len, words)))),
        float(hist[192:].sum()) / chars,
    ]


class Trees:
    """A boosted ensemble as flat node arrays; a leaf points to itself."""

    def __init__(self, base, roots, feature, cut, left, right, value, depth):
        self.base, self.depth = base, depth
        self.roots, self.feature = np.asarray(roots, np.int32), np.asarray(feature, np.int32)
        self.cut, self.value = np.asarray(cut, np.float64), np.asarray(value, np.float64)
        self.left, self.right = np.asarray(left, np.int32), np.asarray(right, np.int32)

    def probability(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[row, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            out[a : a + 4096] += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def train_trees(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 48, l2: float = 2.0, min_child: float = 4.0,
) -> Trees:
    """Newton boosting of logistic loss on binned features.

    A split on a monotone feature is allowed only if the children's values are
    ordered, and its midpoint bounds all values further down, so the ensemble
    is monotone in that feature.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(m) * bins
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(n, base)
    roots, feature, cut, left, right, value = [], [], [], [], [], []

    def node(v: float) -> int:
        k = len(feature)
        feature.append(0), cut.append(np.inf), left.append(k), right.append(k), value.append(v)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(node(0.0))
        todo = [(roots[-1], np.arange(n), 0, -np.inf, np.inf)]
        while todo:
            k, rows, level, low, high = todo.pop()
            G, H = g[rows].sum(), h[rows].sum()
            value[k] = float(np.clip(G / (H + l2), low, high)) * rate
            best = None
            if level < depth and H >= 2 * min_child:
                where = flat[rows].ravel()
                gl = np.bincount(where, np.repeat(g[rows], m), m * bins).reshape(m, bins).cumsum(axis=1)
                hl = np.bincount(where, np.repeat(h[rows], m), m * bins).reshape(m, bins).cumsum(axis=1)
                gr, hr = G - gl, H - hl
                vl, vr = np.clip(gl / (hl + l2), low, high), np.clip(gr / (hr + l2), low, high)
                gain = 2 * vl * gl - vl**2 * (hl + l2) + 2 * vr * gr - vr**2 * (hr + l2)
                gain -= 2 * G * (v := np.clip(G / (H + l2), low, high)) - v**2 * (H + l2)
                bad = (hl < min_child) | (hr < min_child) | (monotone[:, None] * (vr - vl) < 0)
                gain = np.where(bad, -1.0, gain)
                j, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[j, b] > 1e-6 and b < len(cuts[j]):
                    best = (j, b, vl[j, b], vr[j, b])
            if best is None:
                score[rows] += value[k]
                continue
            j, b, a, z = best
            mid, goes = (a + z) / 2, binned[rows, j] <= b
            feature[k], cut[k] = int(j), float(cuts[j][b])
            lo = (low, mid) if monotone[j] > 0 else (mid, high) if monotone[j] < 0 else (low, high)
            hi = (mid, high) if monotone[j] > 0 else (low, mid) if monotone[j] < 0 else (low, high)
            left[k], right[k] = node(0.0), node(0.0)
            todo += [(left[k], rows[goes], level + 1, *lo), (right[k], rows[~goes], level + 1, *hi)]
    return Trees(base, roots, feature, cut, left, right, value, depth)


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [statistics(t)[1] for t in as_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.float64()))], ["doc_id", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """The ensemble fitted on at most ``sample`` labelled documents."""
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    chosen = hashed_sample(marks.agg(F.avg("quality").alias("y")), "doc_id", sample)
    # At most ``sample`` (id, label) rows: a proven bound for the broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    stats = texts.mapInArrow(_statistics_of, "doc_id long, x array<double>")
    once = stats.groupBy("doc_id").agg(F.min("x").alias("x"))
    got = once.join(F.broadcast(chosen), "doc_id").select("doc_id", "x", "y").toPandas().sort_values("doc_id")
    y = (got["y"].to_numpy(np.float64) >= 0.5).astype(np.float64)
    if len(got) < 20 or y.min() == y.max():
        return None
    direction = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    return train_trees(np.array(got["x"].tolist(), np.float64), y, direction)


def _judged(got: list[tuple[list[int], list[float]]], model: Trees | None, threshold: float):
    """Base counts, base failures, quality (None without a model), verdicts."""
    base = np.array([a for a, _ in got], np.int64).reshape(len(got), len(BASE))
    failed = (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])
    p = None if model is None or not got else model.probability(np.array([b for _, b in got]))
    return base, failed, p, ~failed if p is None else ~failed & (p >= threshold)


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep; one pass."""
    model = train(docs, labels, sample)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t) for t in as_bytes(batch.column(place))]
            yield batch.filter(pa.array(_judged(got, model, threshold)[3], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, base counts, ``base_failed``, ``quality`` (probability of
    good quality, null without a model) and ``kept`` of every document."""
    model = train(docs, labels, sample)
    schema = pa.schema(
        [("doc_id", pa.int64())] + [(c, pa.int64()) for c in BASE]
        + [("base_failed", pa.bool_()), ("quality", pa.float64()), ("kept", pa.bool_())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t) for t in as_bytes(batch.column(1))]
            base, failed, p, kept = _judged(got, model, threshold)
            quality = pa.nulls(len(got), pa.float64()) if p is None else pa.array(p)
            columns = [batch.column(0).cast(pa.int64()), *map(pa.array, base.T), pa.array(failed), quality, pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    spark_schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, quality double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(score, spark_schema)
