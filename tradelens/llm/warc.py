"""WARC archives: deduplicating writer and splittable reader.

Writer: every row becomes one record in a gzip member of its own.  Of rows
with equal payloads of at least ``MIN_BYTES`` bytes, the one with the smallest
``page_id`` is a ``response``; the others are ``revisit`` records that refer
to it and carry no payload.  A task writes one file under a temporary name and
renames it, so a repeated task leaves one complete file.

Reader: archives are cut into byte ranges.  A task looks for the gzip magic in
its range, accepts a candidate only if it inflates to a WARC header whose
``Content-Length`` fits the member, and owns exactly the records that start
inside its range (it reads past the end to finish the last).  After a record
the next one is tried right behind it; if that fails the search goes on byte
by byte, so a damaged stretch costs only its own records.

Both go through ``pyarrow.fs`` (local, HDFS, S3, ... by the path's scheme).

Defined results: a null payload is empty; a null url is left out; rows with a
null ``page_id`` are kept (id null), never chosen as a group's response unless
no row of the group has an id; rows that repeat the smallest id of a group are
all responses.  Other columns are not read.  An empty table gives no archive
and no records; a very long payload is one record, held in memory by its task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.llm.common import stored

MIN_BYTES = 100
#: Copies of a repeated digest in the join with its pages.
SALTS = 32
MAGIC = b"\x1f\x8b\x08"
_BLOCK = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "path string, at long, record_id string, record_type string, target_uri string, refers_to string, "
    "declared_digest string, declared_bytes long, payload binary"
)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def record_bytes(page_id, url, payload: bytes, digest: str, size: int, refers_to, date: str) -> bytes:
    """One WARC record (not compressed); ``refers_to`` makes it a revisit."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.insert(4, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = _open(folder)
        final = f"{base}/part-{task.partitionId():06d}.warc.gz"
        part = f"{base}/_temporary-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, records = None, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = fs.open_output_stream(part)
                gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(gz.compress(record_bytes(*row, date)) + gz.flush())
                records += 1
        if out is not None:
            out.close()
            fs.move(part, final)
            yield pa.RecordBatch.from_arrays([pa.array([final]), pa.array([records])], ["path", "records"])

    return run


def write_warc(
    pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = "2000-01-01T00:00:00Z", level: int = 6
) -> DataFrame:
    """Writes the archives and returns ``path, records`` per file."""
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)  # there even if no page is
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    long_enough = F.col("size") >= min_bytes
    groups = rows.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = stored(groups.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-repeated")
    # Payloads that a large share of the pages repeat are dealt out over copies
    # of their digest, so no join task gets them all.
    copies = repeated.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("salt", salt).join(copies, ["digest", "salt"], "left")
    refers = F.when(long_enough & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    payload = F.when(refers.isNull(), F.col("payload")).otherwise(F.lit("").cast("binary"))
    out = joined.select("page_id", "url", payload.alias("payload"), "digest", "size", refers.alias("refers_to"))
    return stored(out.mapInArrow(_writer(folder, date, level), "path string, records long"), "warc-files")


def parse_record(data: bytes) -> dict | None:
    """The fields of an inflated member, or None if it is no whole record."""
    head, found, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        return None
    if len(block) != size + 4 or block[size:] != b"\r\n\r\n":
        return None
    block, declared = block[:size], None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, block = block.partition(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        declared = int(length[1]) if length else None
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "declared_digest": fields.get("warc-payload-digest"),
        "declared_bytes": declared,
        "payload": block,
    }


def _member(read, at: int) -> tuple[dict, int] | None:
    """The record whose member starts at ``at``, and the member's length."""
    inflate, data, used = zlib.decompressobj(31), bytearray(), 0
    while not inflate.eof:
        block = read(at + used, 512 if not used else _BLOCK)
        if not block:
            return None
        try:
            data += inflate.decompress(block)
        except zlib.error:
            return None
        if len(data) >= 7 and not data.startswith(b"WARC/1."):
            return None
        used += len(block)
    record = parse_record(bytes(data))
    return None if record is None else (record, used - len(inflate.unused_data))


def records_in(read, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """The records that start in ``[start, end)``; ``read(at, n)`` gives bytes."""
    at, ahead, ahead_at = start, b"", start
    while at < end:
        if not ahead_at <= at < ahead_at + len(ahead) - 2:
            ahead_at, ahead = at, read(at, min(_BLOCK, end - at) + 2)
            if len(ahead) < 3:
                return
        found = ahead.find(MAGIC, at - ahead_at)
        if found < 0:
            at = max(at + 1, ahead_at + len(ahead) - 2)
            continue
        at = ahead_at + found
        if at >= end:
            return
        got = _member(read, at)
        if got is None:
            at += 1
            continue
        yield at, got[0]
        at += got[1]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RECORD.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    for got in batches:
        for r in got.to_pylist():
            fs, path = _open(r["path"])
            rows, held = [], 0
            with fs.open_input_file(path) as f:
                for at, record in records_in(lambda a, n, f=f: f.read_at(n, a), r["start"], r["stop"]):
                    rows.append(record | {"path": r["path"], "at": at})
                    held += len(record["payload"])
                    if held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
            if rows:
                yield batch(rows)


def read_warc(spark: SparkSession, folder: str, split_bytes: int | None = None) -> DataFrame:
    """One row per record of the ``*.warc.gz`` files in ``folder``.

    ``split_bytes`` is the length of the byte ranges (default: the session's
    ``spark.sql.files.maxPartitionBytes``).
    """
    if split_bytes is None:
        conf = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
        split_bytes = int(conf.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.select("path", "length").where("length > 0")  # names and sizes; contents are not read
    ranges = files.select("path", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start"))
    ranges = ranges.withColumn("stop", F.col("start") + split_bytes)
    tasks = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    return ranges.repartition(int(tasks)).mapInArrow(_reader, _RECORD)


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: of
    responses as found in the payload, of revisits as their record states."""

    def page(c: str):
        return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    response = F.col("record_type") == "response"
    declared = F.regexp_replace("declared_digest", "^sha256:", "")
    return records.select(
        page("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(declared).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
