"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins whose partitions all turn out small are hashed instead of sorted.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def job_session(app_name: str) -> SparkSession:
    """Session of a spark-submit job."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with a partition per 128 MB of input, and at least one per core.

    Adaptive execution merges partitions that turn out small but does not
    divide large ones, so the number has to be high enough from the start.
    """
    wanted = -(-input_bytes // SHUFFLE_PARTITION_BYTES)
    cores = spark.sparkContext.defaultParallelism
    partitions = min(max(wanted, cores), MAX_SHUFFLE_PARTITIONS)
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    return partitions


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach, for checkpoints and scratch tables.

    It is the one named in ``spark.checkpoint.dir``. Only a local session may
    go without and gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = os.path.join(tempfile.gettempdir(), f"vinilo-{spark.sparkContext.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """The frame written out once, so that later passes do not run its plan again."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
