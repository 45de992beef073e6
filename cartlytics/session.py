"""Session helpers.

``configure`` applies the settings every operator assumes (UTC session zone,
AQE with skew-join handling).  ``local_session`` is for tests and the bench.
``many_tasks`` gives a query a session of its own with smaller tasks;
``shared_folder`` names the place for intermediate tables.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

TASK_BYTES = "16m"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def many_tasks(spark: SparkSession, tasks: int) -> SparkSession:
    """A session with the settings of ``spark`` whose shuffles are cut into
    ``tasks`` parts at least, joined to no more than ``TASK_BYTES``.

    For SQL text, whose exchanges cannot be dealt out one by one."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    parts = "spark.sql.shuffle.partitions"
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own.conf.set(first, str(max(tasks, int(own.conf.get(first, None) or own.conf.get(parts)))))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    It is the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    folder).  Only a local master, where there is one machine, may do without:
    it gets a scratch folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartlytics-shared-"))
    return spark.sparkContext.getCheckpointDir()


def local_session(cores: int | str = "8", shuffle_partitions: int = 8,
                  app_name: str = "cartlytics") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CARTLYTICS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
