"""Spark session defaults shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Every bucket (day, hour, week) is a UTC bucket.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "65535",
}
# The order view has tens of computed columns: made in one method it would be
# above the 8000 bytes of code that the JVM compiles, and would be interpreted.
ORDER_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}
# Orders for each task of a shuffle, however many there are; AQE merges those
# that turn out small.
ROWS_PER_SHUFFLE_TASK = 500_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# What a task reads of files or of merged partitions, where the session sets nothing.
TASK_CONF = {
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "flowcubes") -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is left to ``spark-submit`` on a cluster; tests and the bench
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for key, value in SESSION_CONF.items():
        if key != "spark.ui.enabled":
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def size_shuffles(spark: SparkSession, rows: int) -> int:
    """Deal the shuffles over ``rows`` orders to tasks in proportion, so that
    the groups or sorted rows that one task holds do not grow with the input.
    Never fewer than ``spark.sql.shuffle.partitions``. Returns how many."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_SHUFFLE_TASK))
    spark.conf.set(INITIAL_PARTITIONS, str(tasks))
    already = spark.conf.getAll
    for key, value in TASK_CONF.items():
        if key not in already:
            spark.conf.set(key, value)
    return tasks


def reset_shuffles(spark: SparkSession) -> None:
    """Undo ``size_shuffles``."""
    spark.conf.unset(INITIAL_PARTITIONS)
    for key, value in TASK_CONF.items():
        if spark.conf.get(key) == value:
            spark.conf.unset(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; a scratch folder is created only for local runs and tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="flowcubes-ckpt-", dir=os.environ.get("FLOWCUBES_SCRATCH"))
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local
