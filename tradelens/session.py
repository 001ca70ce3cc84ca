"""SparkSession construction and cluster-level settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tradelens job relies on.  ANSI mode stays on (Spark 4
# default): every division is guarded, every text->number goes through
# ``try_cast``.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# Settings for large inputs (tens of TB): many shuffle partitions that AQE
# coalesces at run time, ~256 MiB scan splits and shuffle partitions, and
# skew-join splitting for hot keys.  Tune the partition count to the cluster.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tradelens",
    extra_conf: dict | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Return (or create) a session with the tradelens defaults.

    On a cluster, call without ``master`` (the launcher decides) and with
    ``cluster=True`` for ``CLUSTER_CONF``.  Tests pass ``master="local[*]"``
    and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system; we never
    override it, and we refuse to invent one (a machine-local folder would
    not survive the loss of an executor).  Only a ``local[...]`` session
    (tests, benchmarks) gets a scratch folder when it is unset.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it to a shared folder (HDFS/S3/...) "
            "so checkpointed tables survive executor loss"
        )
    path = tempfile.mkdtemp(prefix="tradelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
