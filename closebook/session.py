"""Spark session settings used by tests, the bench and the driver entry."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from closebook.sources import storage


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "closebook") -> SparkSession:
    """Session tuned for the operators in this package.

    * AQE on: partitions coalesce after the (small) monthly aggregates,
      sort-merge joins turn into broadcast joins when a side proves small at
      runtime, and skewed join partitions are split.
    * Session time zone pinned to UTC: the testdata timestamps are
      ``timestamp_ntz`` and every month key must not move with the host zone.
    * UI off: batch jobs, no web server.
    * ``shuffle_partitions`` ~ cores locally; on a cluster size it to the data
      (AQE then coalesces towards ``advisoryPartitionSizeInBytes``).
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # AQE merges shuffle partitions below this size; the default (1 MB)
        # collapses small shuffles onto 1-2 tasks. Partitions of a large
        # input are far bigger, so this only keeps small inputs parallel.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CLOSEBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is (an
    unset setting on a cluster is an error, never a machine-local folder).
    Only a local master without the setting (tests) gets a scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(checkpoints must survive executor loss)")
    local = tempfile.mkdtemp(prefix="closebook-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared checkpoint folder.

    The data is persisted (memory, spilling to disk) while the checkpoint is
    written, so it is computed once rather than once for the materialising
    job and again for the checkpoint write; it is released afterwards and
    every later use reads the checkpoint files. These are removed when the
    application ends (Spark keeps them, though no other application can read them).
    """
    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cut = df.checkpoint(eager=True)
    finally:
        df.unpersist()
    files = cut._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if files.isDefined():
        storage.remove_at_exit(df.sparkSession, files.get())
    return cut
