"""Connected components of an edge table by alternating large and small stars.

Every round is a few equi-joins and pre-aggregated minima, written to the
shared folder; nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_shuffles, save


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) that is not itself
    the smallest of its component; ``component`` is that smallest node."""
    pairs = save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        own = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(own, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(own.select("a", F.col("low").alias("b"))).distinct())
        pairs = save(small, "star")
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        free_shuffles(edges.sparkSession)  # the round's plans and joins go before the next
        before = tuple(seen)
