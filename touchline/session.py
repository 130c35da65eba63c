"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_MB = 1024 * 1024
_local_base: str | None = None


def scale_settings(shuffled_bytes: int, partition_bytes: int = 128 * _MB) -> dict[str, str]:
    """Settings sized from the bytes a job is expected to shuffle.

    The partition count starts high enough that one partition fits an executor's memory; adaptive execution
    then merges small partitions and splits skewed ones, so over-estimating is cheap.
    """
    partitions = max(200, -(-shuffled_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(
    app_name: str = "touchline", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_settings(cores: int) -> dict[str, str]:
    """Settings for one machine: tests and the bench."""
    return {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def _scratch_base(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only in local mode."""
    global _local_base
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="touchline-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def _run_folder(spark: SparkSession) -> str:
    return f"{_scratch_base(spark)}/touchline-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below this application's part of the shared scratch folder."""
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables and checkpoints of this application; results that still read them are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """From now on each execution's shuffle files go when it ends, not when the driver's collector finds them unused.

    A later task that misses them makes Spark repeat their stage, as after the loss of an executor.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{_run_folder(spark)}/checkpoints")
