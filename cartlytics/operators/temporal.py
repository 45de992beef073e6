"""Joins in time: the last row at or before (as-of), and all rows in an interval.

Neither joins on an inequality.  Time is cut into buckets, and a bucket's rows
meet on equal (keys, bucket), so a customer with a third of all rows is as many
tasks as there are buckets.

- As-of: both sides are laid together and sorted within (keys, bucket); the
  right side's row is carried forward.  What lies before the bucket is one row,
  the last of its bucket for those keys, so the halo is an aggregate, not a copy
  of the rows.
- Interval: the left side's row is dealt to the buckets that its interval
  touches (a number fixed by the bucket width, never by the data).

Rows with a NULL key or time match nothing; the as-of join keeps such left rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import col


def micros(ts: str | Column) -> Column:
    """A timestamp or date as microseconds since 1970 (the session zone is UTC)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def bucket_of(at: Column, width: int) -> Column:
    """floor(at / width) of whole numbers, exact."""
    return ((at - F.pmod(at, F.lit(width))) / width).cast("long")


def _width(tolerance: timedelta) -> int:
    width = tolerance // timedelta(microseconds=1)
    if width <= 0:
        raise ValueError("the tolerance must be positive")
    return width


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
              tolerance: timedelta, columns: Sequence[str], tiebreak: Sequence[str] = (),
              splits: int = 1) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` that has equal
    ``on`` keys and lies at or before ``left_ts``, by ``tolerance`` at most.

    Of right rows at one time the largest by ``tiebreak`` (then by ``columns``)
    counts; NULLs are smallest.  ``splits`` cuts the tolerance into so many
    buckets, for keys that are hot within one.  ``columns`` may include
    ``right_ts`` and must not clash with the left side's names.
    """
    clash = {c.lower() for c in columns} & {c.lower() for c in left.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    span = _width(tolerance)
    width = max(1, math.ceil(span / splits))
    keys = [f"_k{i}" for i in range(len(on))]

    def placed(df: DataFrame, ts: str, payload: list[Column]) -> DataFrame:
        at = micros(ts)
        return df.select(*[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)], at.alias("_at"),
                         bucket_of(at, width).alias("_bucket"), *payload)

    usable = F.col(left_ts).isNotNull()
    for c in on:
        usable = usable & F.col(c).isNotNull()
    payload = F.struct(*[F.col(c) for c in left.columns]).alias("_left")
    # rows that can match nothing bypass the window: a hot NULL key is no group
    lefts = placed(left.where(usable), left_ts, [payload])

    known = right.where(F.col(right_ts).isNotNull())
    for c in on:
        known = known.where(F.col(c).isNotNull())
    row = F.struct(micros(right_ts).alias("_when"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)],
                   *[F.col(c) for c in columns])
    rights = placed(known, right_ts, [row.alias("_right")])
    last = rights.groupBy(*keys, "_bucket").agg(F.max("_right").alias("_right"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(splits)))  # buckets that the halo reaches
    halo = last.select(*keys, "_bucket", "_right", ahead.alias("_ahead")).select(
        *keys, F.col("_right._when").alias("_at"), (F.col("_bucket") + F.col("_ahead")).alias("_bucket"), "_right")
    rights = rights.select(*keys, "_at", "_bucket", "_right").unionByName(halo)

    every = lefts.select(*keys, "_at", "_bucket", F.lit(1).alias("_side"), "_left",
                         F.lit(None).cast(rights.schema["_right"].dataType).alias("_right"))
    every = every.unionByName(rights.select(
        *keys, "_at", "_bucket", F.lit(0).alias("_side"),
        F.lit(None).cast(lefts.schema["_left"].dataType).alias("_left"), "_right"))
    so_far = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    carried = every.withColumn("_last", F.last("_right", ignorenulls=True).over(so_far)).where("_side = 1")
    near = F.col("_at") - F.col("_last._when") <= span
    matched = carried.select(*[F.col(f"_left.`{c}`").alias(c) for c in left.columns],
                             *[F.when(near, F.col(f"_last.`{c}`")).alias(c) for c in columns])
    others = left.where(~F.coalesce(usable, F.lit(False))).select(
        *left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns])
    return matched.unionByName(others)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
                  before: timedelta, after: timedelta = timedelta(0), columns: Sequence[str] = ()) -> DataFrame:
    """Pairs with equal ``on`` keys and ``left_ts - before <= right_ts <= left_ts + after``:
    the left row and ``columns`` of the right one.

    The join's keys are equal (keys, bucket); the exact bounds are checked on
    the pairs of a bucket and its neighbours.
    """
    lo, hi = before // timedelta(microseconds=1), after // timedelta(microseconds=1)
    width = max(1, lo + hi)
    keys = [f"_k{i}" for i in range(len(on))]
    at = micros(left_ts)
    first, last = (bucket_of(at + shift, width) for shift in (-lo, hi))
    usable = at.isNotNull()
    # an interval of the bucket's width touches two buckets at most
    lefts = left.where(usable).select(
        F.struct(*[F.col(c) for c in left.columns]).alias("_left"), *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)],
        at.alias("_from"), F.explode(F.array_distinct(F.array(first, last))).alias("_bucket"))
    rights = right.select(*[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)], micros(right_ts).alias("_when"),
                          bucket_of(micros(right_ts), width).alias("_bucket"),
                          *[F.col(c) for c in columns])
    near = F.col("_when").between(F.col("_from") - lo, F.col("_from") + hi)
    pairs = lefts.join(rights, [*keys, "_bucket"]).where(near)
    return pairs.select(*[F.col(f"_left.`{c}`").alias(c) for c in left.columns], *columns)
