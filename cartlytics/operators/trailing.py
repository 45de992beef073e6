"""Totals over a trailing stretch of time (RANGE frames), at the data's size.

``trailing_range`` is for one series, or any keys: the total from ``t - span`` to
``t`` is the running total at ``t`` less the running total just before
``t - span``.  Both are read off one distributed running total over the order
(keys, time), in which each time also stands once as a mark at ``t - span``.
Neither a hot key nor the lack of keys makes a large task; sums are exact.

``trailing_window`` is for keys, with any window aggregate: time is cut into
buckets of the span, and a bucket's window sees the rows of the bucket before as
a halo.  A key with many rows is as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..plans.running_total import add_running_totals
from .temporal import bucket_of, micros


def trailing_range(df: DataFrame, ts: str, value: str, span: timedelta, keys: Sequence[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """(keys, ts, value, trailing_value, trailing_rows): one row per key and time.

    ``value`` is the sum at that time and ``trailing_value`` the sum over the
    closed range from ``ts - span`` to ``ts``; both are NULL over NULLs only.
    Values must be whole numbers or decimals.  Rows with a NULL time are left out.
    """
    kind = df.schema[value].dataType.typeName()
    if kind in ("double", "float"):
        raise ValueError(f"{value} must be a whole number or a decimal, to be subtracted exactly")
    width = span // timedelta(microseconds=1)
    at_time = df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(
        F.sum(value).alias("_value"), F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_known"))
    at = micros(ts)
    here = at_time.select(*keys, ts, at.alias("_at"), F.lit(1).alias("_side"), "_value", "_rows", "_known")
    marks = at_time.select(*keys, ts, (at - width).alias("_at"), F.lit(0).alias("_side"),
                           F.lit(None).cast(at_time.schema["_value"].dataType).alias("_value"),
                           F.lit(0).cast("long").alias("_rows"), F.lit(0).cast("long").alias("_known"))
    totals = add_running_totals(here.unionByName(marks), [*keys, "_at", "_side"], ["_value", "_rows", "_known"],
                                buckets=buckets)
    one = totals.groupBy(*keys, ts).agg(
        F.max("_value").alias(value),
        *[(F.max(F.when(F.col("_side") == 1, F.col(f"{c}_so_far"))) - F.max(F.when(F.col("_side") == 0, F.col(f"{c}_so_far"))))
          .alias(f"_{c}") for c in ("_value", "_rows", "_known")])
    return one.select(*keys, ts, value, F.when(F.col("__known") > 0, F.col("__value")).alias(f"trailing_{value}"),
                      F.col("__rows").alias("trailing_rows"))


def trailing_window(df: DataFrame, ts: str, span: timedelta, keys: Sequence[str],
                    measures: Callable[[WindowSpec], Sequence[Column]]) -> DataFrame:
    """``df`` with ``measures(window)`` over each row's closed range of time
    from ``ts - span`` to ``ts`` within its keys.

    Rows with a NULL time are left out; NULL keys are a key of their own.
    """
    if not keys:
        raise ValueError("without keys use trailing_range")
    width = span // timedelta(microseconds=1)
    rows = df.where(F.col(ts).isNotNull()).withColumn("_at", micros(ts))
    own = bucket_of(F.col("_at"), width)
    # each row stands in its bucket and, as part of the halo, in the next
    dealt = rows.withColumn("_ahead", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_bucket", own + F.col("_ahead"))
    frame = Window.partitionBy(*keys, "_bucket").orderBy("_at").rangeBetween(-width, 0)
    out = dealt.select("*", *measures(frame)).where("_ahead = 0")
    return out.drop("_at", "_ahead", "_bucket")
