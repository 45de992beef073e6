"""Compute an intermediate result once and cut its lineage.

Used where one result feeds a planning pass and then the main job: without it
the upstream joins would run twice, and a planning pass could disagree with the
main job on an input that changes between reads.  The rows are written as
Parquet to the folder that the cluster names in ``spark.checkpoint.dir``, which
all executors share, so a lost executor does not lose them.  Without that
setting a local master gets a scratch folder; any other master is refused.

``clear(spark)`` removes everything this application has written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cartlytics-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder, removed by ``clear`` like the others."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete this application's materialised tables (call when done with them)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
