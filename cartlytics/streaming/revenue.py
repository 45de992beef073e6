"""Daily revenue as a stream: late and repeated orders, each counted once.

Orders arrive in files.  An order that arrives again within the watermark's
delay is dropped by its id, tumbling windows add up the rest in the state store,
and a window is written when the watermark has passed its end: no order that is
late by less than the delay is lost, and what was written never changes.  The
file sink's log makes a window appear exactly once even if a run is repeated
from its checkpoint.

Partial sums combine before the shuffle to the state, so a busy day is no hot
task; the state holds open windows and the ids of the delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

WATERMARK = "2 days"
WINDOW = "1 day"


def windowed_revenue(orders: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    """(window_start, orders, revenue) of a stream, or of a table, of orders.

    Orders without a time fall in no window.  Orders without an id are one
    order; give them ids before, if they are several."""
    rows = orders.select("order_id", F.col("order_ts").cast("timestamp").alias("order_ts"), "revenue_usd")
    rows = rows.where("order_ts IS NOT NULL")
    if rows.isStreaming:
        once = rows.withWatermark("order_ts", watermark).dropDuplicatesWithinWatermark(["order_id"])
    else:
        once = rows.dropDuplicates(["order_id"])
    totals = once.groupBy(F.window("order_ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue_usd").alias("revenue"))
    return totals.select(F.col("w.start").alias("window_start"), "orders", "revenue")


def write_windows(orders: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK, window: str = WINDOW) -> StreamingQuery:
    """Process all files that are there, write closed windows to ``path`` and
    stop; the next call with the same checkpoint goes on from there."""
    out = windowed_revenue(orders, watermark, window)
    return (out.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows written so far."""
    return spark.read.schema("window_start timestamp, orders long, revenue decimal(22,2)").parquet(path)
