"""Importance resampling towards a target distribution, by prefix CRCs.

Hashed n-gram features weigh documents by how much likelier their features are
in a target corpus than in the whole; a seeded Gumbel noise per document turns
the weights into a draw without replacement.

**Features.**  A text becomes its words (runs of digits, ``a-z`` and non-ASCII
characters after lower-casing ``A-Z``) joined by one space.  One scan stores the
running CRC-32 at every word's end; the CRC at the start of the next word
follows by one table step over the space.  The CRC of any n-gram then needs no
second look at its bytes: with ``A`` the bytes before it and ``B`` the n-gram,
``crc(AB) = shift(crc(A), len(B)) xor crc(B)``, where ``shift`` multiplies by
``x^(8 len(B))`` over GF(2).  So ``crc(B)`` is the XOR of two stored prefixes, the
earlier one shifted; shifts are products of the powers ``x^(8 2^k)``, kept as
byte tables, and work on all n-grams of a batch at once.

**Passes.**  (1) Documents and target texts are scanned once; each document's
feature buckets are stored, and bucket counts are summed per task before the
shuffle.  (2) The gains (one integer per bucket, a parameter's size) go to all
tasks, and the stored buckets give the documents' weights.  (3) The draw: counts
per score find the lowest drawn score, and only documents at or above it are
sorted, by range over all tasks, and numbered.

Defined results: a null or empty text has no features and weight 0; a null
``doc_id`` draws as ``''`` and comes last among ties; ties go to the smaller
``doc_id``; repeated rows count and are drawn each; without target features the
gains still follow the formula (``t = T = 0``); an empty table gives no rows;
other columns are not read.  A text costs memory in proportion to its length.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.common import as_bytes, per_worker, stored

BUCKETS, SEED, MIN_WORDS, PERCENT = 10_000, 2024, 20, 10

#: Bytes that end a word become spaces, A-Z become a-z.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    """CRC-32's table: a byte's remainder by the reflected polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_TABLE = _crc_table()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit words, given as its values on each of four bytes."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def _shift_tables() -> list[np.ndarray]:
    """Tables of the shifts by ``2^k`` bytes, ``k`` = 0..31."""
    every = (np.arange(256, dtype=np.uint32) << np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None]).astype(np.uint32)
    one = (_TABLE[every & 255] ^ (every >> np.uint32(8))).astype(np.uint32)  # one byte of zeros
    tables = [one]
    for _ in range(31):
        tables.append(_apply(tables[-1], tables[-1].ravel()).reshape(4, 256))
    return tables


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs moved past ``lengths`` bytes: ``crc(A 0..0) xor crc(0..0)`` of each."""
    out = crc.copy()
    top = int(lengths.max(initial=0))
    for k, tables in enumerate(per_worker("crc shifts", _shift_tables)):
        if top >> k == 0:
            break
        at = np.flatnonzero(lengths >> k & 1)
        out[at] = _apply(tables, out[at])
    return out


class PrefixCrc:
    """Running CRCs of a normalised text at its words' starts and ends."""

    def __init__(self, text: bytes):
        words = text.translate(_NORMAL).split()
        self.n = len(words)
        crc32 = zlib.crc32
        sizes = np.fromiter(map(len, words), np.int64, self.n)
        self.end = np.cumsum(sizes + 1) - 1  # places of the words' ends, with one space between words
        self.start = self.end - sizes
        words[1:] = [b" " + w for w in words[1:]]
        c = 0
        self.after = np.fromiter([c := crc32(w, c) for w in words], np.uint32, self.n)
        before = np.zeros(self.n, np.uint32)
        raw = self.after[:-1] ^ _ONES
        before[1:] = _TABLE[(raw ^ np.uint32(32)) & 255] ^ (raw >> np.uint32(8)) ^ _ONES
        self.before = before

    def ngrams(self, size: int) -> np.ndarray:
        """CRC-32 of every run of ``size`` words joined by one space."""
        if self.n < size:
            return np.zeros(0, np.uint32)
        last = slice(size - 1, None)
        first = slice(0, self.n - size + 1)
        return self.after[last] ^ shifted(self.before[first], self.end[last] - self.start[first])


def features(text: bytes, sizes: range, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words and the buckets of all n-grams of the given sizes."""
    crcs = PrefixCrc(text)
    found = [crcs.ngrams(k) for k in sizes]
    return crcs.n, (np.concatenate(found) if len(found) != 1 else found[0]) % np.uint32(buckets)


_SCANNED = "doc_id long, n_words long, n_features long, found binary"


def _scan(sizes: range, buckets: int):
    """Per text: words, features and the buckets, in as few bytes as they need."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            rows = [features(t, sizes, buckets) for t in as_bytes(got.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    got.column(0),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([len(f) for _, f in rows], pa.int64()),
                    pa.array([f.astype(width).tobytes() for _, f in rows], pa.binary()),
                ],
                ["doc_id", "n_words", "n_features", "found"],
            )

    return run


def _histogram(buckets: int):
    """One row per bucket met by a task."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for got in batches:
            for x in got.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), width), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return run


def _weigh(gains: np.ndarray):
    width = "<u2" if len(gains) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            weights = []
            for x in got.column(3):
                found = np.frombuffer(x.as_buffer(), width)
                weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [*got.columns[:3], pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"]
            )

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and each row's place among the task's rows."""
    part, seen = TaskContext.get().partitionId(), 0
    for got in batches:
        place = np.arange(seen + 1, seen + 1 + got.num_rows)
        seen += got.num_rows
        yield pa.RecordBatch.from_arrays(
            [*got.columns, pa.array(np.full(got.num_rows, part, np.int32)), pa.array(place)], [*got.schema.names, "task", "place"]
        )


def _noise(doc_id: Column, seed: int) -> Column:
    """1000 times a standard Gumbel variate, floored, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _gains(counts: DataFrame, buckets: int) -> np.ndarray:
    """Integer gain of every bucket, from rows ``bucket, s, t``: one row per
    bucket, a size that the caller chose."""
    rows = counts.select("bucket", "s", "t").collect()
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in rows:
        s[r["bucket"]], t[r["bucket"]] = r["s"], r["t"]
    all_s, all_t = float(s.sum()), float(t.sum())

    def gain(s: float, t: float) -> int:
        return math.floor(1000 * math.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))))

    return np.asarray([gain(float(a), float(b)) for a, b in zip(s, t, strict=True)], np.int64)


def _bucket_counts(scanned: DataFrame, buckets: int) -> DataFrame:
    sums = scanned.select("found").mapInArrow(_histogram(buckets), "bucket long, n long")
    return sums.groupBy("bucket").agg(F.sum("n").alias("n"))


def resample(
    docs: DataFrame, target: DataFrame, max_words: int = 1, buckets: int = BUCKETS, seed: int = SEED,
    min_words: int = MIN_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.

    Features are the runs of 1 to ``max_words`` words; of the documents with at
    least ``min_words`` words the given percentage is drawn, ``rank`` numbering
    them from the highest score (null: not drawn).
    """
    sizes = range(1, max_words + 1)
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    text = F.col("text").cast("string").alias("text")
    scanned = stored(docs.select(doc_id, text).mapInArrow(_scan(sizes, buckets), _SCANNED), "resample-features")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), text).mapInArrow(_scan(sizes, buckets), _SCANNED)
    counts = _bucket_counts(scanned, buckets).withColumnRenamed("n", "s")
    counts = counts.join(_bucket_counts(wanted, buckets).withColumnRenamed("n", "t"), "bucket", "full").na.fill(0, ["s", "t"])
    gains = _gains(counts, buckets)

    weighed = scanned.mapInArrow(_weigh(gains), "doc_id long, n_words long, n_features long, weight long")
    score = F.col("weight") + _noise(F.col("doc_id"), seed)
    scored = stored(weighed.withColumn("score", score), "resample-scores")

    eligible = F.col("n_words") >= min_words
    drawn = scored.where(eligible).count() * percent // 100
    # The lowest drawn score, from the counts of scores: integers between the
    # bounds of gain and noise, so at most some 10^5 rows whatever the input.
    per_score = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")
    lowest = per_score.withColumn("above", above).where(F.col("above") < drawn).agg(F.min("score")).first()[0]
    columns = ["doc_id", "n_features", "weight", "score"]
    if lowest is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    inside = eligible & (F.col("score") >= lowest)
    # Equal rows of one id are dealt out by their place in the stored table.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    best = scored.where(inside).select(*columns, F.monotonically_increasing_id().alias("row"))
    best = best.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    schema = "doc_id long, n_features long, weight long, score long, task int, place long"
    placed = stored(best.mapInArrow(_numbered, schema), "resample-order")
    per_task = placed.groupBy("task").agg(F.max("place").alias("n"))  # one row per task of the sort
    starts = per_task.withColumn("before", F.sum("n").over(Window.orderBy("task")) - F.col("n")).drop("n")
    rank = F.col("before") + F.col("place")
    ranked = placed.join(F.broadcast(starts), "task").select(*columns, F.when(rank <= drawn, rank).cast("long").alias("rank"))
    rest = scored.where(~inside).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
