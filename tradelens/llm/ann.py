"""Approximate nearest neighbours with learned partitions.

1. A bounded sample of the vectors gives an exact neighbour graph (largest
   inner products), which is cut into partitions of nearly equal size: seeds
   from a balanced k-means, then rounds of moves along the graph that raise the
   number of neighbours in one's own partition while no partition exceeds its
   capacity.
2. A small softmax network learns to predict, from a vector, the partitions of
   its sample neighbours.
3. Every row is indexed in its most probable partition.  A query is routed to
   its ``PROBES`` most probable partitions and reranked exactly there, in
   double precision.

Partitions are searched in blocks: a partition with more than ``BLOCK`` rows
is dealt out over blocks by row hash, its queries over blocks of their own, so
a vector that a third of all rows repeat spreads over many tasks.

Defined results: a vector takes part if it is not null, not zero, holds only
finite numbers and has the most frequent dimension among such vectors (ties:
the smaller one).  Rows without an id take no part.  Rows that repeat an id are candidates
each, but never of a query with their id; a repeated query id is asked once
per distinct row and its results are ranked together.  Other columns are not
read.  Equal products go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradelens.llm.common import hashed_sample, softmax, stored

#: Vectors that the graph and the classifier are fitted on, by id hash.
SAMPLE = 12_000
PARTITIONS, PROBES, NEIGHBOURS, TOP = 64, 40, 30, 20
BLOCK, QUERY_BLOCK, QUERY_MODULUS = 8192, 2048, 20


def exact_neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """For each row the ``k`` others with the largest inner product."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12) -> np.ndarray:
    """Partition numbers of the graph's nodes, at most ``slack * n / parts`` each."""
    rng, n = np.random.default_rng(11), len(x)
    capacity = int(np.ceil(slack * n / parts))
    centre = x[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, np.int64)
    for _ in range(8):
        score = x @ centre.T
        order = np.argsort(-np.sort(score, axis=1)[:, -1])  # the surest choose first
        room = np.full(parts, capacity)
        for i in order:
            for p in np.argsort(-score[i]):
                if room[p]:
                    part[i] = p
                    room[p] -= 1
                    break
        for p in range(parts):
            if (part == p).any():
                c = x[part == p].mean(axis=0)
                centre[p] = c / (np.linalg.norm(c) or 1) * np.linalg.norm(x, axis=1).mean()
    src = np.repeat(np.arange(n), graph.shape[1])
    both = np.concatenate([src, graph.ravel()]), np.concatenate([graph.ravel(), src])
    size = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        votes = np.bincount(both[0] * parts + part[both[1]], minlength=n * parts).reshape(n, parts)
        gain = votes - votes[np.arange(n), part][:, None]
        moved = 0
        for i in np.argsort(-gain.max(axis=1)):
            p = int(gain[i].argmax())
            if gain[i, p] <= 0:
                break
            if size[p] < capacity:
                size[part[i]] -= 1
                size[p] += 1
                part[i], moved = p, moved + 1
        if not moved:
            break
    return part


class Router:
    """Softmax over partitions behind one rectified hidden layer."""

    def __init__(self, dim: int, parts: int, hidden: int = 96):
        rng = np.random.default_rng(5)
        self.scale = 1.0
        self.p = [rng.normal(0, dim**-0.5, (dim, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(np.maximum((x / self.scale) @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3])

    def train(self, x: np.ndarray, target: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 3e-3) -> Router:
        """Cross-entropy against the neighbours' partition shares, by Adam."""
        rng = np.random.default_rng(6)
        self.scale = float(np.linalg.norm(x, axis=1).mean() / np.sqrt(x.shape[1])) or 1.0
        m, v, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), batch):
                rows = order[a : a + batch]
                z = x[rows] / self.scale
                h = np.maximum(z @ self.p[0] + self.p[1], 0)
                d = (softmax(h @ self.p[2] + self.p[3]) - target[rows]) / len(rows)
                back = (d @ self.p[2].T) * (h > 0)
                step += 1
                for i, g in enumerate([z.T @ back, back.sum(axis=0), h.T @ d, d.sum(axis=0)]):
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    self.p[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return self


def fit(vectors: DataFrame, sample: int = SAMPLE, parts: int = PARTITIONS, neighbours: int = NEIGHBOURS) -> Router | None:
    """Graph, partitions and router from at most ``sample`` distinct vectors."""
    rows = hashed_sample(vectors.select("vec_id", "v"), "vec_id", sample).collect()
    if not rows:
        return None
    x = np.unique(np.array([r["v"] for r in rows], np.float64), axis=0)
    parts = max(1, min(parts, len(x) // (2 * neighbours)))
    if parts == 1:
        return Router(x.shape[1], 1)
    graph = exact_neighbours(x, neighbours)
    part = balanced_partition(x, graph, parts)
    near = np.concatenate([np.arange(len(x))[:, None], graph], axis=1)
    target = np.stack([(part[near] == p).mean(axis=1) for p in range(parts)], axis=1)
    return Router(x.shape[1], parts).train(x, target)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda e: e.isNotNull())).where(finite & F.exists("v", lambda e: e != 0))
    top = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    return rows.where(F.size("v") == (top["dim"] if top else 0))


def _routed(router: Router, probes: int):
    """Adds a row's most probable partitions, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64)
            if not len(x):
                continue
            p = np.argsort(-router.probabilities(x), axis=1, kind="stable")[:, :probes]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(p.astype(np.int32)), pa.list_(pa.int32()))], ["vec_id", "v", "parts"])

    return run


def top_of_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """Per query the ``k`` best of the block: query index, vec_id, score.

    A matrix product finds who may be among the best; their scores are then
    computed row by row, alike for equal vectors wherever they stand.
    """
    out = []
    slack = 1e-9 * (1 + np.abs(c).max() * np.abs(q).max() * c.shape[1]) if len(c) and len(q) else 0
    for a in range(0, len(q), 256):
        s = q[a : a + 256] @ c.T
        s[qid[a : a + 256, None] == cid[None, :]] = -np.inf
        if s.shape[1] > k:
            least = np.partition(s, s.shape[1] - k, axis=1)[:, -k] - slack
        else:
            least = np.full(len(s), -np.finfo(np.float64).max)
        for i in range(len(s)):
            at = np.flatnonzero(s[i] >= least[i])
            exact = (c[at] * q[a + i]).sum(axis=1)
            best = np.lexsort((cid[at], -exact))[:k]
            out.append((np.full(len(best), a + i), cid[at][best], exact[best]))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 2 + [np.empty(0)]


def _search(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        q = np.array(left.column("v").to_pylist(), np.float64)
        c = np.array(right.column("v").to_pylist(), np.float64)
        qid, cid = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        at, found, score = top_of_block(qid, q, cid, c, k) if len(q) and len(c) else ([], [], [])
        ids = pa.array(qid[at] if len(at) else [], pa.int64())
        return pa.table({"query_id": ids, "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})

    return run


def nearest(
    embeddings: DataFrame, queries: DataFrame | None = None, k: int = TOP, probes: int = PROBES, sample: int = SAMPLE,
    parts: int = PARTITIONS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query.

    ``queries`` has the columns of ``embeddings``; by default they are the rows
    whose id is divisible by ``QUERY_MODULUS``.
    """
    rows = stored(usable(embeddings), "ann-vectors")
    asked = rows.where(F.col("vec_id") % QUERY_MODULUS == 0) if queries is None else usable(queries)
    router = fit(rows, sample, parts)
    schema = "vec_id long, v array<double>, parts array<int>"
    if router is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = rows.mapInArrow(_routed(router, 1), schema).select("vec_id", "v", F.col("parts")[0].alias("part"))
    routed = asked.dropDuplicates(["vec_id", "v"]).mapInArrow(_routed(router, probes), schema)
    routed = routed.select("vec_id", "v", F.explode("parts").alias("part"))
    indexed, routed = stored(indexed, "ann-index"), stored(routed, "ann-queries")
    # One row per partition of the index: how many blocks its rows and queries take.
    many = {r["part"]: -(-r["n"] // BLOCK) for r in indexed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    asks = {r["part"]: -(-r["n"] // QUERY_BLOCK) for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    if not many or not asks:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def blocks(of: dict[int, int]):
        return F.coalesce(F.create_map(*(F.lit(x) for kv in of.items() for x in kv))[F.col("part")], F.lit(1))

    def dealt(df: DataFrame, own: str, other: str, mine: dict[int, int], theirs: dict[int, int], salt: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", F.lit(salt)), blocks(mine)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), blocks(theirs) - 1)))

    left = dealt(routed, "qb", "cb", asks, many, "q").groupBy("part", "qb", "cb")
    right = dealt(indexed, "cb", "qb", many, asks, "c").groupBy("part", "qb", "cb")
    found = left.cogroup(right).applyInArrow(_search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
