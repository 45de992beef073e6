"""Distributed running totals over a global order.

``SUM(...) OVER (ORDER BY ...)`` without PARTITION BY moves every row into one
task.  Here rows are range-partitioned by the order, totalled once per range
(one row a range), and the running sum inside a range starts from the total of
the ranges before it.  Exact for whole numbers and decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .materialize import materialize

_PLACE_BITS = 33  # of monotonically_increasing_id: the place within its partition


def add_running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str], suffix: str = "_so_far",
                       buckets: int | None = None) -> DataFrame:
    """``df`` with the sum of each of ``values`` over all rows up to and with
    this one by ``order`` (NULLs first; ties in any order).  NULL values count as 0.

    Rows are written once, in order.  ``buckets`` overrides the number of ranges
    (the session's shuffle partitions, of which AQE joins small neighbours)."""
    ranged = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    placed = materialize(ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_id", _PLACE_BITS))
    totals = placed.groupBy("_range").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    zero = F.lit(0)
    offsets = totals.select("_range", *[F.coalesce(F.sum(v).over(before), zero).alias(f"_before_{v}") for v in values])
    within = Window.partitionBy("_range").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(offsets), "_range")
    return out.select(*df.columns, *[
        (F.col(f"_before_{v}") + F.coalesce(F.sum(v).over(within), zero)).alias(f"{v}{suffix}") for v in values])
