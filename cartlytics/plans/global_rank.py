"""Distributed global ROW_NUMBER / RANK.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.
Here the rows are range-partitioned instead:

1. Rows are range-partitioned by the value *and* the tiebreak columns (any
   sortable type, strings too), so a value that a third of all rows share is
   split over many ranges.  Their number is the session's shuffle partitions,
   of which the planner joins small neighbours, so it follows the data's size.
2. Each range is sorted and written, once, with its position (range number and
   place within the range).
3. Rows per range (one row per range) give prefix offsets, which are broadcast
   back; the global row number is offset + place + 1, without any window.
4. A rank is taken in one window per range.  A value that spans ranges has its
   rank corrected by the smallest row number of that value; there are at most
   as many such values as ranges, and they are broadcast.

The ranges only affect balance, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .materialize import materialize

TARGET_ROWS = 1_000_000
_PLACE_BITS = 33  # of monotonically_increasing_id: the place within its partition


def range_count(n: int, target_rows: int = TARGET_ROWS) -> int:
    return max(1, math.ceil(n / target_rows))


def add_row_number(df: DataFrame, value: str, descending: bool = False,
                   tiebreak: Sequence[str] = (), rn_col: str | None = "rn",
                   rank_col: str | None = None, buckets: int | None = None) -> tuple[DataFrame, int]:
    """Add global ``row_number`` (by ``value``, then ``tiebreak`` ascending)
    and/or ``rank`` (by ``value`` only) without a single-partition window.

    Nulls sort last in either direction.  ``buckets`` overrides the number of
    ranges.  Returns the new DataFrame and the row count.
    """
    v = F.col(value)
    by_value = v.desc_nulls_last() if descending else v.asc_nulls_last()
    order = [by_value, *[F.col(c).asc_nulls_last() for c in tiebreak]]
    ranged = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    placed = materialize(ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    n = placed.count()
    placed = placed.select("*", F.shiftright("_id", _PLACE_BITS).alias("_range"),
                           F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place")).drop("_id")

    ranges = placed.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_size"), F.min_by(F.struct(value), "_place").alias("_first"),
        F.max_by(F.struct(value), "_place").alias("_last"))
    in_order = Window.orderBy("_range")  # one row per range
    offset = F.coalesce(F.sum("_size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("_range", offset.alias("_offset"), "_first",
                           F.lag("_last").over(in_order).alias("_before"))
    out = placed.join(F.broadcast(ranges.select("_range", "_offset")), "_range")
    number = F.col("_offset") + F.col("_place") + 1
    if rank_col:
        spanning = ranges.where(F.col("_first").eqNullSafe(F.col("_before")))
        spanning = spanning.select(F.col(f"_first.{value}").alias("_value")).distinct()
        starts = (out.join(F.broadcast(spanning), v.eqNullSafe(F.col("_value")))
                  .groupBy("_value").agg(F.min(number).alias("_start")))
        within = Window.partitionBy("_range").orderBy(by_value)
        out = (out.withColumn("_rank", F.col("_offset") + F.rank().over(within))
               .join(F.broadcast(starts), v.eqNullSafe(F.col("_value")), "left")
               .withColumn(rank_col, F.coalesce("_start", "_rank")).drop("_rank", "_value", "_start"))
    if rn_col:
        out = out.withColumn(rn_col, number)
    return out.drop("_range", "_place", "_offset"), n
