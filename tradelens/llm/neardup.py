"""Near-duplicate components by MinHash with sequential Bayesian verification.

Two texts are linked if the Jaccard similarity of their sets of word shingles
is at least ``threshold``; components are closed under links.

1. One pass over the texts hashes the shingles and keeps, per document, the
   set's size and fingerprint, band hashes (banded MinHash) and one byte of
   each MinHash value.  Equal sets are one class from here on, so groups of
   exact copies, however large, are one row each.
2. Classes that share a band are candidates.  Instead of all pairs of a
   bucket, its members are compared with its leader, the member that meets the
   most others over all its bands.
3. A pair is verified sequentially: after each batch of signature bytes the
   posterior probability that the similarity reaches the threshold (uniform
   prior) is known from the matches so far; below ``MISS`` the pair is dropped.
   What survives all batches is verified exactly on the full sets.
4. Components of the links found so far settle most buckets.  The rest, whose
   non-leaders lie in different components, are solved in groups (connected
   through such buckets): pairs that share a band and lie in different
   components are verified as in 3, and each link at once joins components.
   Large groups are dealt out as pairs of blocks, so no task holds more than
   two blocks.  So every candidate pair is verified, or its ends are connected
   anyway.

Bands are chosen so that a pair right at the threshold shares no band with
probability ``1e-5`` at most.

Defined results: a null or empty text, or one without words, has no shingles
and no links: it is its own component.  A null id is no candidate for a
component's id; if no document of a component has an id, the id is null.
Repeated rows get the same result each.
Extra columns are not read (``deduplicated`` passes them through).  An empty
table gives no rows; a very long text is one row whose set grows with it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import as_bytes, per_worker, shielded, stored
from tradelens.llm.components import connected_components

MISS = 1e-7
HASHES, BANDS, BATCH, BLOCK = 320, 40, 32, 1024
_U = np.uint64
_MIX = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F),
        _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)]
_RNG = np.random.default_rng(20)
_A = (_RNG.integers(0, 1 << 32, HASHES, np.uint64) | _U(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)


def band_rows(threshold: float) -> int:
    """The most rows a band may have for the promised miss probability."""
    for rows in range(HASHES // BANDS, 0, -1):
        if (1 - threshold**rows) ** BANDS <= 1e-5:
            return rows
    raise ValueError("threshold too low for the number of hashes")


class _Words(dict):
    """64-bit hashes of words; starts anew at ``limit`` words."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(per_worker("shingle words", _Words).__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    n = len(w) - k + 1
    h = w[:n] * _MIX[0]
    for j in range(1, k):
        h += w[j : j + n] * _MIX[j]
    return np.unique(_mixed(h + _U(k)))


def minhash(elements: np.ndarray) -> np.ndarray:
    """``HASHES`` minimum values of a non-empty set."""
    h = (elements >> _U(32)).astype(np.uint32)
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(h), 4096):
        part = h[a : a + 4096]
        for b in range(0, HASHES, 64):
            values = _A[b : b + 64, None] * part
            values += _B[b : b + 64, None]
            np.minimum(out[b : b + 64], values.min(axis=1), out=out[b : b + 64])
    return out


def band_hashes(values: np.ndarray, rows: int) -> np.ndarray:
    v = values[: BANDS * rows].reshape(BANDS, rows).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)
    for j in range(rows):
        h += v[:, j] * _MIX[j]
    return _mixed(h).view(np.int64)


_SIGNED = "doc_id long, key long, n_shingles long, print binary, bands array<long>, sig binary"


def _signed(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, bands, sigs = [], [], [], []
            for text in as_bytes(batch.column(2)):
                s = shingles(text, size)
                n.append(len(s))
                if not len(s):
                    prints.append(None), bands.append(None), sigs.append(None)
                    continue
                values = minhash(s)
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_hashes(values, rows))
                sigs.append(values.astype(np.uint8).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(prints, pa.binary())]
            columns += [pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SIGNED.split(", ")])

    return run


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For each batch end, the fewest matching bytes with which a pair may
    still reach the threshold: P(match probability >= that of the threshold |
    matches) >= ``miss`` under a uniform prior, a binomial tail."""
    q = threshold + (1 - threshold) / 256
    out = []
    for h in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(h + 1, m) * q**m * (1 - q) ** (h + 1 - m)
        out.append(m)
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Indices of the row pairs of two byte matrices that no batch prunes."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, m in enumerate(least):
        c = slice(i * BATCH, (i + 1) * BATCH)
        matches[alive] += (a[alive, c] == b[alive, c]).sum(axis=1)
        alive = alive[matches[alive] >= m]
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b|, for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _pruned(percent: int):
    least = least_matches(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sa", "sb"))
                yield batch.take(pa.array(survivors(a, b, least))).select(["a", "b"])

    return run


def _verified(percent: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            ids = [batch.column(c).to_pylist() for c in ("a", "b")]
            texts = [batch.column(c) for c in ("ta", "tb")]

            def members(side: int, i: int, ids=ids, texts=texts, sets=sets) -> np.ndarray:
                v = ids[side][i]
                if v not in sets:
                    if len(sets) > 500:
                        sets.clear()
                    sets[v] = shingles((texts[side][i].as_py() or "").encode(), size)
                return sets[v]

            good = [linked(members(0, i), members(1, i), percent) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _solved(percent: int, size: int):
    """Links that join components inside one group (or pair of blocks)."""
    least = least_matches(percent / 100)

    def run(key, table):
        m = table.num_rows
        uid, n = table.column("uid").to_numpy(), table.column("n_shingles").to_numpy()
        bands = np.array(table.column("bands").to_pylist(), np.int64).reshape(m, BANDS)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(m, HASHES)
        comp = np.unique(table.column("comp").to_numpy(), return_inverse=True)[1]
        block = table.column("block").to_numpy()
        cross = len(np.unique(block)) > 1  # a pair of blocks: each block has a task of its own
        texts, sets, out = table.column("text"), {}, []

        def members(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles((texts[i].as_py() or "").encode(), size)
            return sets[i]

        for i in range(m):
            near = (bands[i + 1 :] == bands[i]).any(axis=1) & (comp[i + 1 :] != comp[i])
            near &= 100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i])
            if cross:
                near &= block[i + 1 :] != block[i]
            at = np.flatnonzero(near) + i + 1
            at = at[survivors(np.broadcast_to(sig[i], (len(at), HASHES)), sig[at], least)]
            for j in at:
                if comp[j] != comp[i] and linked(members(i), members(j), percent):
                    out.append((uid[i], uid[j]))
                    comp[comp == comp[j]] = comp[i]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``uid, text`` of classes ``uid, rep, key``: the text of one document.

    The classes grow with the corpus, so they are never broadcast: the plan is
    the same at every size."""
    rows = docs.select(F.col("doc_id").alias("rep"), _key().alias("key"), "text")
    same = rows["rep"].eqNullSafe(needed["rep"]) & (rows["key"] == needed["key"])
    return stored(rows.join(needed.hint("merge"), same).select("uid", "text").dropDuplicates(["uid"]), "dup-texts")


def _links(docs: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """``a, b``: links between classes that give the components of all links."""
    buckets = classes.select("uid", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(buckets.join(sizes, "bucket"), "dup-buckets")
    degree = shared.groupBy("uid").agg(F.sum("size").alias("degree"))
    ranked = shared.join(degree, "uid")
    order = F.struct("degree", (-F.col("uid")).alias("least"), "n_shingles")
    leaders = ranked.groupBy("bucket").agg(F.max(order).alias("m"))
    leaders = leaders.select("bucket", (-F.col("m.least")).alias("leader"), F.col("m.n_shingles").alias("ln"))
    led = stored(shared.join(leaders, "bucket").where("uid <> leader"), "dup-led")
    length_ok = 100 * F.least("n_shingles", "ln") >= percent * F.greatest("n_shingles", "ln")
    pairs = led.where(length_ok).select(F.col("leader").alias("a"), F.col("uid").alias("b")).distinct()

    sig = classes.select("uid", "sig")
    both = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    pairs = stored(both.mapInArrow(_pruned(percent), "a long, b long"), "dup-pairs")
    # Texts of all classes that share a bucket, fetched once for both steps.
    texts = _texts_of(docs, classes.select("uid", "rep", "key").join(degree.select("uid"), "uid", "left_semi"))
    full = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    links = stored(full.mapInArrow(_verified(percent, size), "a long, b long"), "dup-links")

    # Buckets whose non-leaders are not all in one component.
    comps = connected_components(links)
    placed = led.select("bucket", "uid").join(comps.withColumnRenamed("v", "uid"), "uid", "left")
    placed = stored(placed.select("bucket", "uid", F.coalesce("comp", "uid").alias("comp")), "dup-placed")
    open_ = placed.groupBy("bucket").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("uid").alias("first"),
        F.sum(F.xxhash64("uid").cast("decimal(20,0)")).alias("members"), F.count("*").alias("n"),
    ).where("lo <> hi")
    # Buckets of the same members need one look.
    open_ = open_.groupBy("members", "n", "first").agg(F.min("bucket").alias("bucket"))
    rest = stored(placed.join(open_.select("bucket", "first"), "bucket"), "dup-rest")
    if rest.isEmpty():
        return links
    groups = connected_components(rest.select(F.col("first").alias("a"), F.col("uid").alias("b")))
    members = rest.select("uid", "comp").distinct().join(groups.select(F.col("v").alias("uid"), F.col("comp").alias("grp")), "uid")
    members = stored(members, "dup-members")
    wide = classes.select("uid", "n_shingles", "bands", "sig").join(members, "uid")
    blocks = members.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = wide.join(texts, "uid").join(blocks, "grp")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other).select(
        "*", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2")
    ).drop("other", "blocks")
    more = rows.groupBy("grp", "b1", "b2").applyInArrow(_solved(percent, size), "a long, b long")
    return links.union(stored(more, "dup-more"))


def components(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, kept`` of every document; ``key``
    is the text's hash."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), "text")
    signed = stored(rows.mapInArrow(_signed(size, band_rows(percent / 100)), _SIGNED), "dup-signed")
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "sig")]
    # min over (id, key) pairs; a null id counts as larger than any
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "key")).alias("r")
    classes = signed.where("print IS NOT NULL").groupBy("print").agg(least, *first)
    classes = classes.select("print", F.col("r.doc_id").alias("rep"), F.col("r.key").alias("key"), "n_shingles", "bands", "sig")
    classes = stored(classes.withColumn("uid", F.monotonically_increasing_id()), "dup-classes")
    links = _links(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), classes, percent, size)
    comps = connected_components(links).withColumnRenamed("v", "uid")
    whole = classes.select("uid", "print", "rep").join(comps, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    ids = whole.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_print = whole.join(ids, "comp").select("print", "component_id")
    joined = signed.select("doc_id", "key", "n_shingles", "print").join(by_print, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = joined.select("doc_id", "key", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@shielded
def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the smallest id's.

    Texts without words all stay.  Rows that repeat id and text are one
    document and stay once if it stays."""
    found = stored(components(docs, size, percent), "dup-found")
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias("_tl_id"), F.col("key").alias("_tl_k")).distinct(), "dup-gone")
    keyed = docs.withColumn("_tl_key", _key())
    same = keyed["doc_id"].eqNullSafe(gone["_tl_id"]) & (keyed["_tl_key"] == gone["_tl_k"])
    left = keyed.join(gone.hint("merge"), same, "left_anti")  # grows with the corpus
    again = found.where("kept AND n_shingles > 0").groupBy("doc_id", "key").count().where("count > 1")
    again = stored(again.select(F.col("doc_id").alias("_tl_id"), F.col("key").alias("_tl_k")), "dup-again")
    if again.isEmpty():
        return left.select(*docs.columns)
    same = left["doc_id"].eqNullSafe(again["_tl_id"]) & (left["_tl_key"] == again["_tl_k"])
    once = left.join(again, same, "left_semi").dropDuplicates(["doc_id", "_tl_key"])
    return left.join(again, same, "left_anti").union(once).select(*docs.columns)
