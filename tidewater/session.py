"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.ui.enabled": "false",
}

SMALL_TASKS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
}


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the warehouse jobs expect; ``conf`` overrides them.

    The number of shuffle partitions is left to the cluster: with AQE on, give it a generous start value
    (``spark.sql.adaptive.coalescePartitions.initialPartitionNum``) and let Spark merge small partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_small_tasks(spark: SparkSession) -> None:
    """Let AQE cut shuffled data into parts of 16 MB, from up to 400 parts, unless the session has values of its own.

    A task that joins and aggregates holds up to forty times the bytes it reads: 64 MB, Spark's default, makes some
    gigabytes, and a small fixed number of partitions makes tasks that grow with the data.
    """
    for key, value in SMALL_TASKS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for stream checkpoints and intermediate tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder: on a cluster the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@functools.cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidewater-")
