"""Typed file streams of the six tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.schemas import SCHEMAS


def read_table_stream(spark: SparkSession, directory: str, table: str, fmt: str = "csv",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over files of ``table`` landing in ``directory``.

    The declared schema is applied (file streams never infer), and CSV rows
    with a bad value, or a header in another order, fail the query, as the
    batch load does.
    """
    reader = spark.readStream.schema(SCHEMAS[table]).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", ",").option("mode", "FAILFAST").option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)
