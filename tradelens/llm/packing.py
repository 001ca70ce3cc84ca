"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens.  Queues are served in quanta of ``QUANTUM``
tokens; a window is ``WINDOW // QUANTUM`` quanta.  Source ``s`` with weight
``w`` is due its k-th quantum at virtual time ``(k + 1/2) / w``: the moment
its deficit (tokens due less tokens served) reaches half a quantum.  Serving
quanta in the order of these times is deficit round-robin whose deficits carry
over from window to window, and because the k-th quantum's time needs only the
number of quanta before it in its queue, the order carries over from partition
to partition as well: no task has to wait for another.

1. One pass tokenises the texts, fills quanta queue by queue inside each task
   and keeps, per piece of a document, its place and checksum.  The tokens a
   task has left in each queue (fewer than a quantum) are its tails.
2. Counts per task and source give each quantum its number in the whole queue,
   hence its time; a range-partitioned sort by time gives its window and slot.
3. Quanta beyond the last full window form sequences of 4, 2 and 1 quanta
   (powers of two, no padding).  Tails are laid end to end, cut at ``WINDOW``
   tokens, and what remains is cut at powers of two.  Nothing is padded.

Defined results: a null or empty text is its end token alone; a null source is
a queue of its own; repeated rows are packed each; an empty table gives no
pieces; a very long text is tokenised in parts and cut like any other.  Only
``doc_id``, ``source`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.common import per_worker, stored
from tradelens.llm.tokens import Encoder

WINDOW, QUANTUM = 1024, 128
END = b"\0\0\0\0"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, queue string, part int, quantum long, offset long, ids binary"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _cut(vocabulary: str, quantum: int):
    """Pieces of a task's documents: those of full quanta, then the tails."""
    width = 4 * quantum

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"encoder {vocabulary}", lambda: Encoder(vocabulary))
        part = TaskContext.get().partitionId()
        queues: dict[str, list] = {}  # queue: [bytes in the open quantum, its number, its pieces]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        names = [c.split()[0] for c in _PIECES.split(", ")]
        types = [pa.int64()] * 5 + [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for got in batches:
            for doc, queue, text in zip(*(c.to_pylist() for c in got.columns), strict=True):
                ids = encoder.encode(text or "") + END
                size, at = len(ids), 0
                state = queues.setdefault(queue, [0, 0, []])
                while at < size:
                    take = min(width - state[0], size - at)
                    piece = ids[at : at + take]
                    state[2].append((doc, at // 4, take // 4, zlib.crc32(piece), size // 4, state[0] // 4, piece))
                    at += take
                    state[0] += take
                    if state[0] == width:
                        rows.extend((*p[:5], queue, part, state[1], p[5], None) for p in state[2])
                        state[:] = [0, state[1] + 1, []]
                if len(rows) >= 50_000:
                    yield batch()
        offset = 0
        for queue in sorted(queues):
            for p in queues[queue][2]:
                rows.append((*p[:5], queue, part, None, offset, p[6]))
                offset += p[2]
        if rows:
            yield batch()

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and each quantum's place among the task's quanta."""
    import numpy as np

    part, seen = TaskContext.get().partitionId(), 0
    for got in batches:
        place = seen + np.cumsum(got.column("offset").to_numpy() == 0) - 1
        seen = int(place[-1]) + 1 if len(place) else seen
        columns = [*got.columns, pa.array(np.full(len(place), part, np.int32)), pa.array(place.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, [*got.schema.names, "task", "place"])


def powers(n: int) -> list[int]:
    """``n`` as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _tail_cutter(total: int, window: int, first_sequence: int):
    """Cuts tails, laid end to end, at full windows and then at powers of two."""
    full = total // window
    rest = list(itertools.accumulate(powers(total % window), initial=full * window))

    def sequence(at: int) -> tuple[int, int, int]:
        """Number, begin and end of the sequence that holds token ``at``."""
        if at < full * window:
            return at // window, at // window * window, (at // window + 1) * window
        k = next(i for i in range(len(rest) - 1) if at < rest[i + 1])
        return full + k, rest[k], rest[k + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            rows = []
            for r in got.to_pylist():
                done = 0
                while done < r["length"]:
                    at = r["at"] + done
                    number, begin, end = sequence(at)
                    take = min(end - at, r["length"] - done)
                    crc = zlib.crc32(r["ids"][4 * done : 4 * (done + take)])
                    rows.append((r["doc_id"], r["start"] + done, take, crc, r["doc_tokens"], first_sequence + number, at - begin, r["source"]))
                    done += take
            if rows:
                types = [pa.int64()] * 7 + [pa.string()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _RESULT.split(", ")])

    return run


_ORDERED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, queue string, offset long, task int, place long"
_RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def _queue(source: Column) -> Column:
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))


def pack(
    docs: DataFrame, vocabulary: str | None = None, targets: dict[str, float] | None = None, window: int = WINDOW,
    quantum: int = QUANTUM,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source``.

    ``targets`` are the sources' token weights; by default they are the
    sources' shares of all tokens, so every window has the corpus's mixture
    and all queues end together.  With other weights a queue that runs dry
    leaves its share to the others; sources without a weight come last.
    """
    if window % quantum or window & (window - 1) or quantum & (quantum - 1):
        raise ValueError("window and quantum must be powers of two, window the larger")
    slots = window // quantum
    rows = docs.select("doc_id", _queue(F.col("source").cast("string")).alias("queue"), "text")
    pieces = stored(rows.mapInArrow(_cut(vocabulary or default_vocabulary(), quantum), _PIECES), "pack-pieces")

    counts = pieces.where("quantum IS NOT NULL").groupBy("queue", "part").agg((F.max("quantum") + 1).alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    if targets is None:
        counts = counts.withColumn("weight", F.sum("n").over(Window.partitionBy("queue")).cast("double"))
    else:
        weights = [(f"+{k}", float(v)) for k, v in targets.items() if v > 0]
        known = docs.sparkSession.createDataFrame(weights, "queue string, weight double")
        counts = counts.join(F.broadcast(known), "queue", "left")  # one row per target
    counts = stored(counts, "pack-counts")
    due = (F.col("before") + F.col("quantum") + 0.5) / F.col("weight")
    timed = pieces.where("quantum IS NOT NULL").drop("ids").join(counts, ["queue", "part"])
    timed = timed.withColumn("due", F.coalesce(due, F.lit(1e300))).withColumn("number", F.col("before") + F.col("quantum"))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "queue", "offset"]
    ordered = timed.select(*keep, "due", "number").repartitionByRange("due", "queue", "number")
    ordered = ordered.sortWithinPartitions("due", "queue", "number", "offset").select(*keep)
    placed = stored(ordered.mapInArrow(_numbered, _ORDERED), "pack-order")
    per_task = placed.groupBy("task").agg((F.max("place") + 1).alias("n"))  # one row per task of the sort
    per_task = stored(per_task.withColumn("base", F.sum("n").over(Window.orderBy("task")) - F.col("n")), "pack-starts")
    quanta = per_task.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    full, rest = divmod(quanta, slots)
    index = F.col("base") + F.col("place")
    sequence, slot = F.floor(index / slots), index % slots
    for k, begin in enumerate(itertools.accumulate(powers(rest), initial=0)):  # beyond the last full window
        inside = index >= full * slots + begin
        sequence, slot = F.when(inside, full + k).otherwise(sequence), F.when(inside, index - full * slots - begin).otherwise(slot)
    source = F.when(F.col("queue") != "-", F.expr("substring(queue, 2)"))
    main = placed.join(F.broadcast(per_task.select("task", "base")), "task").select(
        *keep[:5], sequence.cast("long").alias("sequence_id"), (slot * quantum + F.col("offset")).cast("long").alias("offset"), source.alias("source")
    )

    tails = pieces.where("quantum IS NULL")
    lengths = tails.groupBy("part").agg(F.sum("length").alias("n"))  # one row per task of the first pass
    lengths = stored(lengths.withColumn("at", F.sum("n").over(Window.orderBy("part")) - F.col("n")), "pack-tails")
    total = lengths.agg(F.sum("n")).first()[0] or 0
    laid = tails.join(lengths.select("part", F.col("at").alias("part_at")), "part")
    laid = laid.select(*keep[:5], source.alias("source"), (F.col("part_at") + F.col("offset")).alias("at"), "ids")
    return main.unionByName(laid.mapInArrow(_tail_cutter(total, window, full + len(powers(rest))), _RESULT))
