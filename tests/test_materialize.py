"""Intermediate tables: where they go, and that they can be removed."""

from __future__ import annotations

import pytest

from cartlytics.plans.materialize import clear, materialize
from cartlytics.session import shared_folder


def test_written_once_and_cleared(spark):
    source = spark.range(10).selectExpr("id", "uuid() as u")
    kept = materialize(source)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, kept.collect()))
    assert "parquet" in kept.inputFiles()[0] and kept.inputFiles()[0].startswith("file:")
    clear(spark)
    with pytest.raises(Exception, match="(?i)not exist|no such file"):
        kept.collect()


def test_a_cluster_must_name_the_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.conf.get = lambda key, default=None: "hdfs://shared/folder/"
    assert shared_folder(Session()) == "hdfs://shared/folder"
