"""Helpers shared by the pipeline operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.session import ensure_checkpoint_dir

#: The white space that separates words: space and 0x09-0x0D.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tradelens/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: what follows reads a table that outlives the executors
    that made it, and the work above it runs once.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(col: str, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text of an Arrow column; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def hashed_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest hash of ``key``: a bounded sample
    that does not depend on partitioning or row order."""
    return df.orderBy(F.xxhash64(key), key).limit(limit)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def per_worker(key: str, make):
    """What ``make`` returned for ``key``, kept by a Python worker from task to
    task (functions arrive anew with each task, and their globals with them)."""
    import sys
    import types

    kept = sys.modules.setdefault("_tradelens_worker", types.ModuleType("_tradelens_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def shielded(operator):
    """For operators that return the columns of their first argument: input
    columns named like the helpers' (``_tl_...``) go by another name inside."""
    import functools

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        names = docs.columns
        inside = [f"in_{i}" if c.lower().startswith("_tl_") else c for i, c in enumerate(names)]
        return operator(docs.toDF(*inside), *args, **kwargs).toDF(*names)

    return run
