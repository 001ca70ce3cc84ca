"""Phrase collocations by Toivonen's sampling algorithm.

Frequent phrases (``min_count`` occurrences in a language) are mined exactly:

1. **The sample proposes.**  In one of ``SAMPLE`` documents (by a hash of the
   id) phrases of 1, 2, ... words are counted level by level; those that reach
   a lowered threshold are proposed.
2. **A full pass counts the proposed phrases and their negative border**: all
   words, and all occurring phrases whose two sub-phrases (without the last,
   without the first word) are proposed, whether they are themselves or not.
   These are many and nearly all rare, so they are counted as 64-bit hashes;
   equal hashes can only make a sum too high.
3. **A second full pass counts as texts** what reached ``min_count`` as a hash,
   and, around border failures (those that were not proposed), every longer
   phrase: the expansion.  That closes the counts: a frequent phrase is either
   made of proposed parts only, or it holds a smallest part that was not
   proposed; all that part's own parts were, so it stood on the border, is
   frequent as well, and failed there.

Each candidate's cuts are then joined with the counts of their two parts, and
phrases that a one word longer phrase always contains are dropped (a longer
phrase with the same count implies one with one word more).

**On Spark.**  Texts become word numbers per buffer of ``BUFFER`` words; a
phrase's number follows from its first part's number and its last word, so
counting inside a buffer is exact.  What a task found leaves it by ranges:
sorted arrays of hashes with their counts, or its sums by text.  Each range is
summed in one small task; the number of ranges follows the number of input
partitions, so ranges do not grow.  The proposed set travels as a bitmap of
``2^BITS`` bits of hashes, 8 MB whatever the corpus; a false hit only has a
phrase counted as text that need not be.  Joins salt languages and short parts,
whose phrases are many.

Defined results: a null text is empty; a null ``lang`` is ``und``; a null
``doc_id`` is sampled like the id ''; repeated rows count; ties in the ranking
go to the larger count, then the smaller phrase in UTF-8 byte order (phrases of
a language differ, so none remain); an empty table gives no rows; other columns
are not read.  A task's memory is bounded by a buffer and its longest piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.common import stored

MIN_COUNT, MAX_WORDS, BEST = 100, 5, 2000
#: One of so many documents is sampled; the sample's threshold is its share of
#: ``min_count``, lowered by this factor.
SAMPLE, LOWERED = 8, 1.5
#: Words that a task counts at a time, and bits of the proposed set.
BUFFER, BITS = 250_000, 26
#: Copies of short parts' counts in the joins.
SALTS = 16

#: Piece separators become 0xFF (no byte of UTF-8), tabs spaces, A-Z a-z.
_BREAK = b"\xff"
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256)
)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: What a task found in a range: phrases of a language, or hashes, and their
#: counts (64-bit numbers); and the sums.
_FOUND = "range int, lang string, phrases array<string>, hashes binary, counts binary"
_SUMMED = "lang string, phrase string, words int, n long, hash long"

def _tokens(data: bytes) -> list[bytes]:
    """Words in order, with a break token between pieces."""
    return data.replace(_BREAK, b" \xff ").split(b" ")


def _segments(text: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """A normalised text in parts of about ``size`` bytes, cut between pieces."""
    data, at = text.translate(_NORMAL), 0
    while len(data) - at > size:
        cut = data.rfind(_BREAK, at, at + size)
        if cut < 0:
            cut = data.find(_BREAK, at)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut + 1
    yield data[at:]


def _hashes(words: pa.Array, lang: str) -> np.ndarray:
    import xxhash

    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ h >> np.uint64(32)) * _MIX


def _has(bitmap: np.ndarray | None, mixed: np.ndarray, bits: int) -> np.ndarray:
    if bitmap is None:
        return np.zeros(len(mixed), bool)
    at = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _factorised(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    encoded = pa.array(codes).dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_numpy()


def _levels(tokens: list[bytes], lang: str, now, before, bits: int, longest: int):
    """For 1, 2, ... words, the phrases that are looked at: their counts, mixed
    hashes, which of them count as texts, and those texts.

    Without ``before`` these are all phrases whose two sub-phrases are in
    ``now``, none as text.  With ``before``, the set that ``now`` was found
    under, also phrases around a failure (in ``now`` only); texts are what is in
    ``now`` and what is around a failure.
    """
    encoded = pa.array(tokens, pa.binary()).dictionary_encode()
    words, ids = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
    listed = words.to_pylist()
    ids = ids[np.asarray([w != b"" for w in listed], bool)[ids]]  # nothing stands between two blanks
    if not len(ids):
        return
    total, inside = len(words), np.asarray([w not in (b"", _BREAK) for w in listed], bool)
    h = word_hash = _hashes(words, lang)
    expanding = before is not None

    def kinds(h: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """May be part of a longer phrase; failed or around a failure."""
        known = _has(now, _mixed(h), bits)
        failed = around | (known & ~_has(before, _mixed(h), bits)) if expanding else around
        return known | failed, failed

    opened, failed = kinds(h, np.zeros(total, bool))
    opened, failed = opened & inside, failed & inside
    texts, row = words.take(pa.array(np.flatnonzero(opened))), np.cumsum(opened) - 1
    yield np.bincount(ids, minlength=total) * inside, _mixed(h), opened, texts
    # At each place: the phrase's number, whether longer ones may follow, whether it failed.
    number, is_open, is_failed = ids, opened[ids], failed[ids]
    for k in range(2, longest + 1):
        at = np.flatnonzero(is_open[:-1] & is_open[1:])
        if not len(at):
            return
        codes, uniques = _factorised(number[at] * total + ids[at + k - 1])
        around = np.zeros(len(uniques), bool)
        around[codes] = (is_failed[:-1] | is_failed[1:])[at]  # the same for all occurrences of a phrase
        first, last = uniques // total, uniques % total
        h = h[first] * _STEP + word_hash[last]
        opened, failed = kinds(h, around)
        if expanding:  # texts are needed for these only
            mine = np.flatnonzero(opened)
            texts = pc.binary_join_element_wise(texts.take(pa.array(row[first[mine]])), words.take(pa.array(last[mine])), b" ")
            row = np.cumsum(opened) - 1
        yield np.bincount(codes, minlength=len(uniques)), _mixed(h), opened, texts
        size = len(number) - 1
        number, is_open, is_failed = np.full(size, -1), np.zeros(size, bool), np.zeros(size, bool)
        number[at], is_open[at], is_failed[at] = codes, opened[codes], failed[codes]


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different hashes and the sums of their counts."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]]))
    return hashes[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def _counter(now, before, bits: int, longest: int, ranges: int, only: int | None = None, buffer: int = BUFFER):
    """Counts by hash of the phrases whose sub-phrases are in ``now`` (of ``only``
    words, if given); with ``before``, counts by text (see ``_levels``)."""

    def array(shared) -> np.ndarray | None:
        return None if shared is None else np.frombuffer(shared.value, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = array(now), array(before)
        held: dict[str, list[bytes]] = {}
        size = 0
        border: list[tuple[np.ndarray, np.ndarray]] = []
        texts: dict[str, dict[bytes, int]] = {}
        width = np.uint64((1 << 64) // ranges + 1)

        def batch(part: np.ndarray, **columns) -> pa.RecordBatch:
            names = [c.split() for c in _FOUND.split(", ")]
            kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
            columns["range"] = pa.array(part)
            return pa.RecordBatch.from_arrays([columns[c].cast(kinds[t]) if c in columns else pa.nulls(len(part), kinds[t]) for c, t in names], [c for c, _ in names])

        def add(lang: str, phrases: pa.Array, counts: np.ndarray) -> None:
            sums = texts.setdefault(lang, {})
            for phrase, n in zip(phrases.to_pylist(), counts.tolist(), strict=True):
                sums[phrase] = sums.get(phrase, 0) + n

        def counted() -> Iterator[pa.RecordBatch]:
            """The texts' sums so far; the word count goes by the empty phrase."""
            for lang, sums in texts.items():
                parts: dict[int, list[bytes]] = {}
                for phrase in sums:
                    parts.setdefault(zlib.crc32(phrase) % ranges, []).append(phrase)
                yield batch(
                    np.asarray(list(parts)),
                    lang=pa.array([lang] * len(parts)),
                    phrases=pa.array(list(parts.values()), pa.list_(pa.binary())),
                    counts=pa.array([np.asarray([sums[x] for x in p], "<i8").tobytes() for p in parts.values()], pa.binary()),
                )
            texts.clear()

        def flush(all_of_it: bool = False) -> Iterator[pa.RecordBatch]:
            for lang, tokens in held.items():
                for level, (counts, h, text, phrases) in enumerate(_levels(tokens, lang, *bitmaps, bits, longest), 1):
                    if before is not None:
                        if level == 1:
                            add(lang, pa.array([b""]), counts.sum(keepdims=True))
                        add(lang, phrases, counts[text])
                    elif only in (None, level):
                        border.append((h[counts > 0], counts[counts > 0]))
            held.clear()
            if all_of_it or sum(map(len, texts.values())) >= buffer:
                yield from counted()
            if border and (all_of_it or sum(len(h) for h, _ in border) >= 4 * buffer):
                hashes, counts = _summed(np.concatenate([h for h, _ in border]), np.concatenate([c for _, c in border]))
                border.clear()
                part = (hashes // width).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                ends = [*cuts[1:], len(part)]
                for at in range(0, len(cuts), 256):
                    pieces = list(zip(cuts[at : at + 256], ends[at : at + 256], strict=True))
                    yield batch(
                        part[cuts[at : at + 256]],
                        hashes=pa.array([hashes[a:b].astype("<u8").tobytes() for a, b in pieces], pa.binary()),
                        counts=pa.array([counts[a:b].astype("<i8").tobytes() for a, b in pieces], pa.binary()),
                    )

        for got in batches:
            for lang, text in zip(got.column(0), got.column(1).cast(pa.binary()), strict=True):
                for part in _segments(text.as_py() or b""):
                    tokens = _tokens(part)
                    tokens.append(_BREAK)
                    held.setdefault(lang.as_py(), []).extend(tokens)
                    size += len(tokens)
                    if size >= buffer:
                        yield from flush()
                        size = 0
        yield from flush(True)

    return run


def _sums(found: DataFrame, least: int) -> DataFrame:
    """Phrases (and the languages' word counts) that reach ``least``, and border
    hashes whose counts do; one task per range."""

    def run(group: pa.Table) -> pa.Table:
        def numbers(table: pa.Table, column: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)

        texts = pc.is_valid(group.column("phrases"))
        arrays, listed = group.filter(pc.invert(texts)), group.filter(texts)
        hashes, counts = _summed(numbers(arrays, "hashes", "<u8"), numbers(arrays, "counts", "<i8"))
        hashes = hashes[counts >= least].view(np.int64)
        phrases = listed.column("phrases").combine_chunks()
        one = {"lang": listed.column("lang").combine_chunks().take(pc.list_parent_indices(phrases)), "phrase": pc.list_flatten(phrases)}
        one["words"] = pc.add(pc.count_substring(one["phrase"], " "), pc.cast(pc.not_equal(one["phrase"], ""), pa.int32()))
        rows = pa.table(one | {"n": pa.array(numbers(listed, "counts", "<i8"))})
        rows = rows.group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")])
        rows = rows.filter(pc.or_(pc.greater_equal(rows.column("n_sum"), least), pc.equal(rows.column("words"), 0)))
        few, many = rows.num_rows, len(hashes)
        columns = [pa.concat_arrays([*rows.column(c).chunks, pa.nulls(many, rows.schema.field(c).type)]) for c in ("lang", "phrase", "words", "n_sum")]
        columns.append(pa.concat_arrays([pa.nulls(few, pa.int64()), pa.array(hashes)]))
        return pa.table(columns, names=[c.split()[0] for c in _SUMMED.split(", ")])

    return found.groupBy("range").applyInArrow(run, _SUMMED)


def _bitmap(hashes: DataFrame, bits: int, more: bytes | None = None) -> bytes:
    """A bitmap of the hashes' first ``bits`` bits: at most ``2^bits / 64`` rows
    reach the driver, whatever the number of hashes."""
    place = F.shiftrightunsigned("hash", 64 - bits)
    groups = hashes.select((F.shiftright(place, 6)).alias("word"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(hash, {64 - bits}) & 63 AS INT))").alias("bit"))
    got = groups.groupBy("word").agg(F.expr("bit_or(bit)").alias("bit")).toArrow()
    bitmap = np.zeros((1 << bits) // 64, np.int64) if more is None else np.frombuffer(more, np.int64).copy()
    bitmap[got.column("word").to_numpy()] |= got.column("bit").to_numpy()
    return bitmap.astype("<i8").tobytes()


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, sample: int = SAMPLE, bits: int = BITS,
    buffer: int = BUFFER,
) -> DataFrame:
    """``lang, phrase, words, n`` of every phrase with ``min_count`` occurrences
    in its language; the row with ``words`` 0 has the language's word count."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"), "doc_id")
    picked = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(sample)) == 0
    sampled = stored(rows.where(picked).select("lang", "text"), "phrases-sample")
    rows = rows.select("lang", "text")
    ranges = max(64, 8 * rows.rdd.getNumPartitions())
    lowered = max(1, int(min_count / sample / LOWERED))
    share = lambda data: None if data is None else spark.sparkContext.broadcast(data)
    now = None
    for k in range(1, max_words + 1):
        found = sampled.mapInArrow(_counter(share(now), None, bits, k, ranges, only=k, buffer=buffer), _FOUND)
        more = _bitmap(_sums(found, lowered).select("hash"), bits, now)
        if more == now:
            break
        now = more
    counter = _counter(share(now), None, bits, max_words, ranges, buffer=buffer)
    reached = _bitmap(_sums(rows.mapInArrow(counter, _FOUND), min_count).select("hash"), bits)
    counter = _counter(share(reached), share(now), bits, max_words, ranges, buffer=buffer)
    counted = stored(_sums(rows.mapInArrow(counter, _FOUND), min_count), "phrases-counted")
    return counted.select("lang", "phrase", "words", "n")


def _part(words: str) -> str:
    return f"array_join({words}, ' ')"


def scored_phrases(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every candidate: the lowest cut."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    totals = frequent.where("words = 0").select("lang", F.col("n").alias("total"), F.explode(every).alias("salt"))
    candidates = frequent.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select(
        "lang", "phrase", "a", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"), "w", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k", "salt", F.expr(_part("slice(w, 1, k)")).alias("first"), F.expr(_part("slice(w, k + 1, size(w) - k)")).alias("rest")
    )
    # Parts of up to two words may belong to many candidates: their counts are
    # copied, and a candidate meets the copy that its salt names.
    copies = F.when(F.col("words") <= 2, every).otherwise(F.array(F.lit(0).cast("long")))
    parts = frequent.where("words > 0").select("lang", "phrase", "n", F.explode(copies).alias("salt"))

    def salt(part: str):
        return F.when(F.size(F.split(part, " ")) <= 2, F.col("salt")).otherwise(F.lit(0))

    def with_count(df: DataFrame, part: str, name: str) -> DataFrame:
        side = parts.select("lang", F.col("phrase").alias(part), F.col("salt").alias("copy"), F.col("n").alias(name))
        return df.withColumn("copy", salt(part)).join(side, ["lang", part, "copy"]).drop("copy", part)

    cuts = with_count(with_count(cuts, "first", "l"), "rest", "r").join(totals, ["lang", "salt"])
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "total", "l", "r")}
    score = F.expr("CAST((wa * wtotal * 1000BD) DIV (wl * wr) AS BIGINT)")
    cuts = cuts.withColumns({f"w{c}": v for c, v in wide.items()}).withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r", F.col("total").alias("n"))).alias("cut")
    return cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), best).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, best: int = BEST, **kw) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``best``."""
    frequent = frequent_phrases(docs, min_count, max_words, **kw)
    scored = scored_phrases(frequent)
    # The largest count of a phrase one word longer, summed up without a join key
    # that could be hot: both kinds of rows meet in one aggregation.
    w = F.split("phrase", " ")
    longer = frequent.where("words > 2").select("lang", F.col("n").alias("around"), w.alias("w"))
    inner = longer.select("lang", "around", F.explode(F.expr(f"array({_part('slice(w, 1, size(w) - 1)')}, {_part('slice(w, 2, size(w) - 1)')})")).alias("phrase"))
    own = ["a", "l", "r", "n", "score"]
    rows = scored.withColumn("around", F.lit(None).cast("long")).unionByName(
        inner.select("lang", "phrase", *[F.lit(None).cast("long").alias(c) for c in own], "around")
    )
    merged = rows.groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in (*own, "around")])
    left = merged.where("a IS NOT NULL AND (around IS NULL OR around < a)").drop("around")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within shares of a language, so that no task sees all its phrases.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = left.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= best).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", *own)
