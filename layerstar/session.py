"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL configuration.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # left-outer fact joins: AQE splits a hot key (or the NULL-key partition)
    # on the streamed fact side
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # broadcast only what is measured to be small: the planner checks the
    # estimate, AQE checks the real size of the finished stage
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "layerstar",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the settings above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """One process: driver and tasks see the same folders."""
    return master == "local" or master.startswith("local[")


def work_root(spark: SparkSession) -> str:
    """The shared folder for materialised layers and lineage cuts.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster sets it; it must
    be set, since a folder of the driver's machine is none of the executors'.
    Only in local mode with nothing set (tests) a private temporary folder is
    made and registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = local_root(spark.sparkContext.master)
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def local_root(master: str) -> str:
    """A temporary folder for a local session; an error for any other."""
    if not is_local(master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: {master} needs a folder that the driver "
                           "and all executors share")
    return tempfile.mkdtemp(prefix="layerstar-", dir=os.environ.get("TMPDIR", "/tmp"))
