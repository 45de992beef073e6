"""A stored daily revenue report that changed orders are merged into.

The table has one folder a month and one row a day: revenue, orders, how many of
them have a revenue, and the number of the last batch that touched the month.  A batch of changes becomes
differences per day; only the months they fall in are read, added up and
overwritten.

- A run that dies before its commit leaves the old files: Spark writes the new
  ones beside them and moves them in at the end.
- A run that dies while moving has replaced some months.  Repeating the batch
  finds its number there, leaves those months alone and finishes the others, so
  a batch counts once however often it is applied.  Batches come in order.
- A day whose orders are all gone keeps a row of zero orders, which reading
  leaves out: a month without rows could not be overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import day_of, month_of
from ..plans.materialize import materialize

SCHEMA = "day date, revenue decimal(38,2), orders long, priced long, batch long, month string"
_SUMS = ("revenue", "orders", "priced")
NO_MONTH = "none"


def _daily(orders: DataFrame, sign: int) -> DataFrame:
    return orders.groupBy(day_of("order_ts").alias("day")).agg(
        (F.coalesce(F.sum("revenue_usd"), F.lit(0)) * sign).cast("decimal(38,2)").alias("revenue"),
        (F.count(F.lit(1)) * sign).alias("orders"), (F.count("revenue_usd") * sign).alias("priced"))


def differences(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """(day, revenue, orders, priced): what changes when orders ``before`` become
    ``after``; None for no such orders (pure inserts or deletions)."""
    parts = [_daily(rows, sign) for rows, sign in ((before, -1), (after, 1)) if rows is not None]
    if not parts:
        raise ValueError("before or after is needed")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy("day").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _with_month(days: DataFrame) -> DataFrame:
    return days.withColumn("month", F.coalesce(F.date_format(month_of("day"), "yyyy-MM"), F.lit(NO_MONTH)))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def create(path: str, orders: DataFrame, batch: int = 0) -> None:
    """Write the report of ``orders`` (may be empty) as a new table."""
    days = _with_month(_daily(orders, 1)).withColumn("batch", F.lit(batch).cast("long"))
    days.repartition("month").write.partitionBy("month").parquet(path)


def apply_changes(spark: SparkSession, path: str, changes: DataFrame, batch: int) -> None:
    """Merge one batch of ``differences`` into the table at ``path``."""
    changes = materialize(_with_month(changes))
    months = [r.month for r in changes.select("month").distinct().collect()]  # bounded by the calendar
    if not months:
        return
    old = _stored(spark, path).where(F.col("month").isin(months))
    done = [r.month for r in old.groupBy("month").agg(F.max("batch").alias("b")).where(F.col("b") >= batch).collect()]
    due = ~F.col("month").isin(done) if done else F.lit(True)
    added = old.select("day", *_SUMS, "month").unionByName(changes).where(due).groupBy("day", "month").agg(
        *[F.sum(c).cast("decimal(38,2)" if c == "revenue" else "long").alias(c) for c in _SUMS])
    new = materialize(added.withColumn("batch", F.lit(batch).cast("long")))
    new.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(day, revenue, orders): days with orders; revenue is NULL over NULLs only."""
    return _stored(spark, path).where("orders <> 0").select(
        "day", F.when(F.col("priced") > 0, F.col("revenue")).alias("revenue"), "orders")
