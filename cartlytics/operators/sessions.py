"""Sessions by inactivity, and the time to the next event, for hot users too.

A user's events are not sorted in one place.  Time is cut into buckets; inside a
(user, bucket) sessions are found from the gap to the event before.  Those pieces
(at most bucket / gap + 1 a bucket, whatever the number of events) are then
joined over the borders of a user's buckets where the gap allows.

Events without user or time take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .temporal import bucket_of, micros

_MICROS = timedelta(microseconds=1)


def _placed(events: DataFrame, key: str, ts: str, bucket: timedelta) -> DataFrame:
    rows = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return rows.withColumn("_at", micros(ts)).withColumn("_bucket", bucket_of(F.col("_at"), bucket // _MICROS))


def _numbered(rows: DataFrame, group: Sequence[str], start: str, end: str, limit: int) -> DataFrame:
    """Adds ``_session``: a running number that rises where the gap from the row before exceeds ``limit``."""
    order = Window.partitionBy(*group).orderBy(start)
    gap = F.col(start) - F.lag(end).over(order)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_new", F.when(gap <= limit, 0).otherwise(1)).withColumn("_session", F.sum("_new").over(so_far))


def sessions(events: DataFrame, gap: timedelta = timedelta(minutes=30), key: str = "customer_id", ts: str = "event_ts",
             bucket: timedelta = timedelta(days=1), sums: Sequence[str] = ()) -> DataFrame:
    """(key, session, started_ts, ended_ts, events, sums): an event within
    ``gap`` of the one before belongs to its session; numbers start at 1."""
    limit = gap // _MICROS
    rows = _numbered(_placed(events, key, ts, bucket), [key, "_bucket"], "_at", "_at", limit)
    adds = [F.sum(s).alias(s) for s in sums]
    pieces = rows.groupBy(key, "_bucket", "_session").agg(
        F.min("_at").alias("_start"), F.max("_at").alias("_end"), F.min(ts).alias("started_ts"),
        F.max(ts).alias("ended_ts"), F.count(F.lit(1)).alias("events"), *adds).drop("_bucket", "_session")
    whole = _numbered(pieces, [key], "_start", "_end", limit)
    return whole.groupBy(key, F.col("_session").alias("session")).agg(
        F.min("started_ts").alias("started_ts"), F.max("ended_ts").alias("ended_ts"), F.sum("events").alias("events"), *adds)


def time_to_next(events: DataFrame, keep: Column, key: str = "customer_id", ts: str = "event_ts",
                 tiebreak: Sequence[str] = ("event_id",), bucket: timedelta = timedelta(days=1)) -> DataFrame:
    """The events that ``keep`` selects, with ``next_ts`` and ``seconds_to_next``
    of the next such event of the same user (NULL for the last)."""
    rows = _placed(events.where(keep), key, ts, bucket)
    inside = Window.partitionBy(key, "_bucket").orderBy("_at", *tiebreak)
    rows = rows.withColumn("_next", F.lead("_at").over(inside)).withColumn("_next_ts", F.lead(ts).over(inside))
    # the first event of each bucket, one row a user and bucket, carried to the bucket before
    firsts = rows.groupBy(key, "_bucket").agg(F.min("_at").alias("_first"), F.min(ts).alias("_first_ts"))
    order = Window.partitionBy(key).orderBy("_bucket")
    firsts = firsts.select(key, "_bucket", F.lead("_first").over(order).alias("_ahead"),
                           F.lead("_first_ts").over(order).alias("_ahead_ts"))
    seconds = (F.coalesce("_next", "_ahead") - F.col("_at")) / 1e6
    return rows.join(firsts, [key, "_bucket"]).select(
        *events.columns, F.coalesce("_next_ts", "_ahead_ts").alias("next_ts"), seconds.alias("seconds_to_next"))
