"""Header against item revenue, and the rows that two tables do not share."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import line_revenue

CAUSES = ("no header", "no items", "no amount", "differs", "equal")


def reconciled_orders(orders: DataFrame, order_items: DataFrame, tolerance: Decimal = Decimal("0.00")) -> DataFrame:
    """(order_id, header_usd, items_usd, cause): one row for every order id of
    either side, the NULL id being one.

    Items are summed per order before the full join, so a hot order is one row.
    Repeated headers of an order are added up.  The cause is ``no header`` or
    ``no items`` (one side lacks the order), ``no amount`` (a side has only
    NULLs), ``equal`` within ``tolerance``, else ``differs``.
    """
    header = orders.groupBy("order_id").agg(F.sum("revenue_usd").alias("header_usd"), F.lit(True).alias("_h"))
    items = order_items.groupBy(F.col("order_id").alias("_item_order")).agg(
        F.sum(line_revenue()).alias("items_usd"), F.lit(True).alias("_i"))
    # a NULL id meets the other side's NULL id: equal stand-ins make it a plain key
    sides = header.withColumn("_k", F.coalesce("order_id", F.lit(0))).withColumn("_null", F.col("order_id").isNull()).join(
        items.withColumn("_k", F.coalesce("_item_order", F.lit(0))).withColumn("_null", F.col("_item_order").isNull()),
        ["_k", "_null"], "full")
    gap = F.abs(F.col("header_usd") - F.col("items_usd"))
    cause = (F.when(F.col("_h").isNull(), "no header").when(F.col("_i").isNull(), "no items")
             .when(gap.isNull(), "no amount").when(gap <= F.lit(tolerance), "equal").otherwise("differs"))
    return sides.select(F.coalesce("order_id", "_item_order").alias("order_id"), "header_usd", "items_usd", cause.alias("cause"))


def reconciliation_summary(reconciled: DataFrame) -> DataFrame:
    """(cause, orders, header_usd, items_usd, gap_usd) for each cause that occurs."""
    gap = F.col("header_usd") - F.col("items_usd")
    return reconciled.groupBy("cause").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("header_usd").alias("header_usd"),
        F.sum("items_usd").alias("items_usd"), F.sum(F.abs(gap)).alias("gap_usd"))


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(columns, side, copies): rows of one side that the other does not have,
    with how many more copies; ``side`` is ``left`` or ``right``.

    Columns are matched by position and named as on the left.  NULLs equal each
    other.  Rows are counted with a sign, so one shuffle of distinct rows (equal
    rows combine before it) gives both EXCEPT ALLs."""
    names = left.columns
    both = left.withColumn("_n", F.lit(1)).unionAll(right.toDF(*names).withColumn("_n", F.lit(-1)))
    off = both.groupBy(*names).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return off.select(*names, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("copies"))
