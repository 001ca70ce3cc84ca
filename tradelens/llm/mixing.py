"""Mixing to target weights with soft domain membership.

1. A multinomial logistic classifier over hashed words and word shapes is
   trained in numpy on a bounded sample of the labelled table and gives every
   document a posterior over domains.
2. Document rates ``r >= 0`` solve a least-squares problem: the expected token
   total of each domain, ``sum r_i * n_i * p_i``, shall match its target.  The
   residual is measured in the metric of the Gram matrix ``sum n_i p_i p_i'``
   (so domains of any size and overlap weigh alike and the step length is 1)
   and the gradient in the token-weighted inner product.  Projected gradient
   descent then moves rates by ``-p_i . g`` and clips them to
   ``[0, max_rate]``.  Only the K numbers of ``g`` leave an iteration, so a
   document's rate follows from its posterior and the list of ``g``: each step
   is one aggregation over the stored posteriors.
3. A document gets ``floor(rate + u)`` copies, ``u`` uniform by the hash of
   its id and text.

The targets' total is set by the ``anchor`` domain: its expected tokens divided
by its weight, so its documents keep rates of about one.  Without a
``max_rate`` (the registered query) documents of a domain that has less than
its share get rates above one, that is copies, and the targets are met up to
``TOLERANCE`` if any nonnegative rates meet them and ``STEPS`` suffice.  With
one, such a domain stops at ``max_rate`` times its tokens and stays short.

Defined results: a null or empty text has no tokens and the classifier's prior;
domains without any expected token have no part and the other weights are
scaled up; without two labelled domains all rates are one.  Repeated rows are
treated alike.  Extra columns pass through ``mixed`` untouched.  An empty table
gives no rows; a very long text is read whole, in time proportional to its
length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelens.llm.common import as_bytes, hashed_sample, per_worker, shielded, softmax, stored

#: Labelled documents used for training, chosen by the hash of their id.
SAMPLE = 8000
WORD_BITS, SHAPE_BITS = 18, 10
#: Value of a word's presence beside the shapes' shares, which add up to one.
PRESENCE = 0.3
STEPS, TOLERANCE = 25, 1e-4
#: Target token weights of the registered query and of the pipeline.
DOMAINS = {"good": 0.90, "poor": 0.07, "toxic": 0.03}
CLEAN = {"clean": 0.99, "toxic": 0.01}


def label_domain() -> Column:
    """Domains of ``DOMAINS`` by the labelled table's columns."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("good")


def toxic_domain() -> Column:
    """Domains of ``CLEAN``."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")


#: Character classes of word shapes: capitals A, other letters a, digits 0.
_CLASSES = bytes(65 if 65 <= b < 91 else 97 if 97 <= b < 123 or b >= 128 else 48 if 48 <= b < 58 else b for b in range(256))


class _Index(dict):
    """Word bucket and shape bucket of a word (a shape is the classes of the
    first and the last two bytes); starts anew at ``limit`` words."""

    def __init__(self, limit: int = 100_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        shape = word.translate(_CLASSES)
        shape = shape[:1] + shape[-2:]
        bucket = zlib.crc32(word.lower().strip(b".,;:!?")) & (1 << WORD_BITS) - 1
        packed = bucket << SHAPE_BITS | zlib.crc32(shape) & (1 << SHAPE_BITS) - 1
        if len(self) >= self.limit:
            self.clear()
        self[word] = packed
        return packed


def features(text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, indices and values of a text: presence of hashed words,
    shares of word shapes."""
    words = text.split()
    if not words:
        return 0, np.empty(0, np.int32), np.empty(0, np.float32)
    index = per_worker("mixing index", _Index)
    packed = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    buckets = np.unique(packed >> SHAPE_BITS)
    shapes, times = np.unique(packed & (1 << SHAPE_BITS) - 1, return_counts=True)
    at = np.concatenate([buckets, shapes + (1 << WORD_BITS)]).astype(np.int32)
    value = np.concatenate([np.full(len(buckets), PRESENCE), times / len(words)])
    return len(words), at, value.astype(np.float32)


class Classifier:
    def __init__(self, classes: list[str]):
        self.classes = classes
        self.weight = np.zeros(((1 << WORD_BITS) + (1 << SHAPE_BITS), len(classes)), np.float32)
        self.bias = np.zeros(len(classes), np.float32)

    def posterior(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return posterior(self.weight, self.bias, at, value)


def posterior(weight: np.ndarray, bias: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    return softmax((value @ weight[at] + bias)[None, :].astype(np.float64))[0]


def train_classifier(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: list[str], epochs: int = 5, batch: int = 64, rate: float = 0.5) -> Classifier:
    """Multinomial logistic regression by Adagrad over sparse rows; small
    samples are passed over until 400 steps are made."""
    epochs = max(epochs, -(-400 * batch // len(rows)))
    c, rng = Classifier(classes), np.random.default_rng(3)
    g2, b2 = np.full_like(c.weight, 1e-4), np.full_like(c.bias, 1e-4)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            size = np.array([len(rows[i][0]) for i in part])
            at = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            owner = np.repeat(np.arange(len(part)), size)
            z = np.stack([np.bincount(owner, value * c.weight[at, k], len(part)) for k in range(len(classes))], axis=1)
            delta = softmax(z + c.bias)
            delta[np.arange(len(part)), y[part]] -= 1
            hit, inverse = np.unique(at, return_inverse=True)
            for k in range(len(classes)):
                g = np.bincount(inverse, value * delta[owner, k], len(hit))
                g2[hit, k] += g * g
                c.weight[hit, k] -= rate * g / np.sqrt(g2[hit, k])
            g = delta.mean(axis=0)
            b2 += g * g
            c.bias -= (0.1 * g / np.sqrt(b2)).astype(np.float32)
    return c


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [features(t) for t in as_bytes(batch.column(1))]
        columns = [batch.column(0), pa.array([a for _, a, _ in got], pa.list_(pa.int32())), pa.array([v for _, _, v in got], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "at", "value"])


def train(docs: DataFrame, labels: DataFrame, domain: Column, sample: int = SAMPLE) -> Classifier | None:
    """Classifier of ``domain`` (an expression over the labelled table; null:
    not labelled), fitted on at most ``sample`` documents."""
    marks = labels.select("doc_id", domain.alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    chosen = hashed_sample(marks.groupBy("doc_id").agg(F.max("y").alias("y")), "doc_id", sample)
    # At most ``sample`` (id, domain) rows: a proven bound for the broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    rows = texts.mapInArrow(_sparse, "doc_id long, at array<int>, value array<float>")
    once = rows.groupBy("doc_id").agg(F.min(F.struct("at", "value")).alias("x"))
    got = once.join(F.broadcast(chosen), "doc_id").select("doc_id", "x.at", "x.value", "y").toArrow().sort_by("doc_id")
    names = got.column("y").to_pylist()
    classes = sorted(set(names))
    if len(classes) < 2:
        return None
    sparse = [(a.values.to_numpy(), v.values.to_numpy()) for a, v in zip(got.column("at"), got.column("value"), strict=True)]
    return train_classifier(sparse, np.array([classes.index(v) for v in names]), classes)


def with_posteriors(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """``docs`` with ``_tl_n`` (words) and ``_tl_p0``, ... (posteriors)."""
    k = len(classifier.classes) if classifier else 0
    # Plain arrays: a broadcast of our own class would need the package on the workers.
    model = docs.sparkSession.sparkContext.broadcast((classifier.weight, classifier.bias) if classifier else None)
    added = [T.StructField("_tl_n", T.LongType())] + [T.StructField(f"_tl_p{i}", T.DoubleType()) for i in range(k)]
    schema = T.StructType([*docs.schema.fields, *added])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema.fields]
        for batch in batches:
            got = [features(t) for t in as_bytes(batch.column(place))]
            columns = [*batch.columns, pa.array([n for n, _, _ in got], pa.int64())]
            if k:
                p = np.array([posterior(*model.value, a, v) for _, a, v in got]).reshape(len(got), k)
                columns += [pa.array(p[:, i]) for i in range(k)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def _dot(g: list[float]) -> Column:
    total = F.lit(0.0)
    for i, v in enumerate(g):
        total = total + F.col(f"_tl_p{i}") * F.lit(float(v))
    return total


def rate_after(moves: list[list[float]], max_rate: float | None) -> Column:
    rate = F.lit(1.0)
    for g in moves:
        rate = F.greatest(F.lit(0.0), rate - _dot(g))
        rate = rate if max_rate is None else F.least(F.lit(float(max_rate)), rate)
    return rate


def fit_rates(
    posteriors: DataFrame, classes: list[str], targets: dict[str, float], anchor: str, max_rate: float | None = 1.0,
    steps: int = STEPS,
) -> list[list[float]]:
    """The gradients ``g`` of projected descent, in order; ``rate_after`` turns
    them into a document's rate."""
    k = len(classes)
    expected = [F.sum(F.col("_tl_n") * F.col(f"_tl_p{i}")) for i in range(k)]
    gram = [F.sum(F.col("_tl_n") * F.col(f"_tl_p{i}") * F.col(f"_tl_p{j}")) for i in range(k) for j in range(k)]
    row = [x or 0.0 for x in posteriors.agg(*(c.alias(f"c{i}") for i, c in enumerate(expected + gram))).first()]
    have, gram = np.array(row[:k]), np.array(row[k:]).reshape(k, k)
    weight = np.array([targets.get(c, 0.0) for c in classes]) * (have > 0)
    if weight.sum() <= 0 or have.sum() <= 0:
        return []
    lead = classes.index(anchor) if anchor in classes and weight[classes.index(anchor)] > 0 else int(weight.argmax())
    target = weight * (have[lead] / weight[lead])
    metric = np.linalg.inv(gram + np.eye(k) * 1e-9 * gram.trace())
    moves: list[list[float]] = []
    now = have
    for _ in range(steps):
        if np.abs(now - target).sum() <= TOLERANCE * target.sum():
            break
        # Rounded: the order in which tasks add up must not change the result.
        moves.append([float(f"{v:.9e}") for v in metric @ (now - target)])
        if np.abs(moves[-1]).max() < 1e-6:
            break
        weighted = F.col("_tl_n") * rate_after(moves, max_rate)
        after = posteriors.agg(*(F.sum(weighted * F.col(f"_tl_p{i}")).alias(f"c{i}") for i in range(k))).first()
        now = np.array(list(after), np.float64)
    return moves


def _uniform() -> Column:
    """In [0, 1), by the hash of id and text."""
    h = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def _fitted(docs, labels, domain, targets, anchor, max_rate, sample, keep):
    """Columns ``keep`` of ``docs`` with posteriors and ``_tl_u``, stored (so
    the texts are classified once), the domains, and the rate's expression."""
    classifier = train(docs, labels, domain, sample)
    classes = classifier.classes if classifier else []
    scored = with_posteriors(docs.withColumn("_tl_u", _uniform()), classifier)
    added = ["_tl_u", "_tl_n", *(f"_tl_p{i}" for i in range(len(classes)))]
    scored = stored(scored.select(*keep, *added), "mixing-posteriors")
    moves = fit_rates(scored, classes, targets, anchor, max_rate) if classes else []
    return scored, classes, rate_after(moves, max_rate)


def soft_mixture(
    docs: DataFrame, labels: DataFrame, domain: Column | None = None, targets: dict[str, float] | None = None,
    anchor: str = "good", max_rate: float | None = 1.0, sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, n_tokens, p_<domain>..., rate, copies`` of every document."""
    targets = DOMAINS if targets is None else targets
    domain = label_domain() if domain is None else domain
    scored, classes, rate = _fitted(docs.select("doc_id", "text"), labels, domain, targets, anchor, max_rate, sample, ["doc_id"])
    p = [(F.col(f"_tl_p{classes.index(c)}") if c in classes else F.lit(None).cast("double")).alias(f"p_{c}") for c in sorted({*targets, *classes})]
    out = scored.withColumn("rate", rate)
    copies = F.floor(F.col("rate") + F.col("_tl_u")).cast("int").alias("copies")
    return out.select("doc_id", F.col("_tl_n").alias("n_tokens"), *p, "rate", copies)


@shielded
def mixed(
    docs: DataFrame, labels: DataFrame, domain: Column | None = None, targets: dict[str, float] | None = None,
    anchor: str = "clean", max_rate: float | None = 1.0, sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` with every row as often as its copies say."""
    targets = CLEAN if targets is None else targets
    domain = toxic_domain() if domain is None else domain
    scored, _, rate = _fitted(docs, labels, domain, targets, anchor, max_rate, sample, docs.columns)
    out = scored.withColumn("_tl_copies", F.floor(rate + F.col("_tl_u")).cast("int")).where("_tl_copies >= 1")
    if max_rate is None or max_rate > 1:
        out = out.withColumn("_tl_copy", F.explode(F.sequence(F.lit(1), F.col("_tl_copies"))))
    return out.select(*docs.columns)
