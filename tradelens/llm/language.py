"""Language identification with a byte convolutional network, in numpy.

A text's UTF-8 bytes are cut into windows of ``LENGTH`` bytes (the last one
filled with zero bytes).  Filters of several widths slide over the one-hot
bytes; a filter's largest response in the window, rectified, feeds a softmax
layer.  Since the input is one-hot, a filter tap is a row of a 256-row table
and the convolution is a sum of table rows.  Training back-propagates through
the maximum, so a window moves only the taps at its winning positions.

A text's languages are scored by the length-weighted mean of its windows'
probabilities; all windows of the whole text count.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text if there is nothing to learn from.  A null id is not held out
and not learned from.  Repeated rows get the same result each.  Only
``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.common import as_bytes, id_remainder, softmax

LENGTH, WIDTHS, FILTERS = 256, (2, 3, 4), 16
#: Texts per language used for training, chosen by the hash of their id, and
#: windows taken from each, spread over the whole text.
PER_LANGUAGE, WINDOWS = 1000, 3
#: Hashes of ids are counted in so many ranges (a power of two).
RANGE_BITS = 16
#: Documents with this remainder of crc32(doc_id) are never learned from.
MODULUS, HELD_OUT = 4, 2


def windows(text: bytes, length: int = LENGTH) -> np.ndarray:
    """The text's windows, one per row (none for an empty text)."""
    n = -(-len(text) // length)
    out = np.zeros(n * length, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, length)


class ByteNetwork:
    """``taps[w]``: (w, 256, filters) tables; ``out``: softmax layer."""

    def __init__(self, classes: list[str], rng: np.random.Generator):
        self.classes = classes
        self.taps = {w: rng.normal(0, 0.2, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        n = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, n**-0.5, (n, len(classes))).astype(np.float32)
        self.bias = np.zeros(len(classes), np.float32)

    def features(self, x: np.ndarray, where: bool = False):
        """Largest responses (windows, filters) and, if asked, their places."""
        best, places = [], []
        for w, taps in self.taps.items():
            n = x.shape[1] - w + 1
            total = taps[0].take(x[:, :n], axis=0)
            for j in range(1, w):
                total += taps[j].take(x[:, j : j + n], axis=0)
            if where:
                at = total.argmax(axis=1)
                places.append(at)
                best.append(np.take_along_axis(total, at[:, None], 1)[:, 0])
            else:
                best.append(total.max(axis=1))
        return np.concatenate(best, axis=1), places

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.classes)), np.float32)
        for a in range(0, len(x), 32):  # keeps the responses in cache
            out[a : a + 32] = softmax(np.maximum(self.features(x[a : a + 32])[0], 0) @ self.out + self.bias)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of ``parameters``."""
        best, places = self.features(x, where=True)
        hidden = np.maximum(best, 0)
        delta = softmax(hidden @ self.out + self.bias)
        delta[np.arange(len(x)), y] -= 1
        delta /= len(x)
        back = (delta @ self.out.T) * (best > 0)
        grads, row, column = [], np.arange(len(x))[:, None], np.arange(FILTERS)
        for k, (w, at) in enumerate(zip(self.taps, places, strict=True)):
            part = back[:, k * FILTERS : (k + 1) * FILTERS].ravel()
            taps = [
                np.bincount((x[row, at + j].astype(np.int64) * FILTERS + column).ravel(), part, 256 * FILTERS)
                for j in range(w)
            ]
            grads.append(np.stack(taps).reshape(w, 256, FILTERS))
        return [*grads, hidden.T @ delta, delta.sum(axis=0)]

    def parameters(self) -> list[np.ndarray]:
        return [*self.taps.values(), self.out, self.bias]


def train_network(x: np.ndarray, y: np.ndarray, classes: list[str], epochs: int = 5, batch: int = 128, rate: float = 0.01) -> ByteNetwork:
    """Adam on windows; every second one is cut short at random, so that short
    texts are known as well."""
    rng = np.random.default_rng(7)
    net = ByteNetwork(classes, rng)
    x = x.copy()
    cut = rng.integers(8, x.shape[1], len(x))
    short = (rng.random(len(x)) < 0.5)[:, None] & (np.arange(x.shape[1]) >= cut[:, None])
    x[short] = 0
    first = [np.zeros(p.shape) for p in net.parameters()]
    second = [np.zeros(p.shape) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            rows = order[a : a + batch]
            step += 1
            for p, g, m, v in zip(net.parameters(), net.gradients(x[rows], y[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _sampled_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, langs, rows = batch.column(0), batch.column(1), []
        for text in as_bytes(batch.column(2)):
            w = windows(text)
            picked = np.unique(np.linspace(0, len(w) - 1, WINDOWS).round().astype(int)) if len(w) else []
            rows.append([w[i].tobytes() for i in picked])
        yield pa.RecordBatch.from_arrays([ids, langs, pa.array(rows, pa.list_(pa.binary()))], ["doc_id", "lang", "w"])


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> ByteNetwork | None:
    """Learns from at most ``per_language`` texts of each language."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(id_remainder("doc_id", MODULUS) != HELD_OUT)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    # Only the ranges of smallest hashes that hold a language's first texts are
    # ranked: (language, range) is no hot key, and a language's rank sees its
    # ``per_language`` texts and one range more.
    ids = known.select("doc_id", "lang", F.shiftright(F.xxhash64("doc_id"), 64 - RANGE_BITS).alias("range"))
    sizes = ids.groupBy("lang", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("range")) - F.col("n")
    low = sizes.withColumn("before", before).where(F.col("before") < per_language).select("lang", "range")
    ranked = ids.join(low, ["lang", "range"], "left_semi").withColumn("r", rank)
    chosen = ranked.where(F.col("r") <= per_language).select("doc_id").distinct()
    # At most ``per_language`` ids of each language: a proven bound.
    texts = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    got = texts.mapInArrow(_sampled_windows, "doc_id long, lang string, w array<binary>")
    rows = got.groupBy("doc_id").agg(F.min(F.struct("lang", "w")).alias("s")).select("doc_id", "s.lang", "s.w").collect()
    pairs = sorted((r["doc_id"], r["lang"], w) for r in rows for w in map(bytes, r["w"]))
    classes = sorted({c for _, c, _ in pairs})
    if not classes:
        return None
    x = np.frombuffer(b"".join(w for _, _, w in pairs), np.uint8).reshape(-1, LENGTH)
    return train_network(x, np.array([classes.index(c) for _, c, _ in pairs]), classes)


def _has_letter(text: bytes) -> bool:
    return re.search(rb"[A-Za-z]", text) is not None or any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def predict(net: ByteNetwork, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    cut = [windows(t) if _has_letter(t) else windows(b"") for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in cut])
    langs, score = ["und"] * len(texts), np.zeros(len(texts))
    if not len(owner):
        return langs, score
    x = np.concatenate(cut)
    weight = np.maximum((x != 0).sum(axis=1), 1).astype(np.float64)
    p = net.probabilities(x) * weight[:, None]
    total = np.stack([np.bincount(owner, p[:, k], len(texts)) for k in range(p.shape[1])], axis=1)
    sums = np.bincount(owner, weight, len(texts))
    for i in np.flatnonzero(sums):
        k = int(total[i].argmax())
        langs[i], score[i] = net.classes[k], min(1.0, total[i, k] / sums[i])
    return langs, score


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    net = train(docs, per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts = as_bytes(part.column(2))
                langs, score = predict(net, texts) if net else (["und"] * len(texts), np.zeros(len(texts)))
                columns = [part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    held = (id_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
