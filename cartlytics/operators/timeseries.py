"""Daily header revenue with trailing row-count moving averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import day_of


def trailing_mean(value: str, order: str, rows: int,
                  partition_by: Sequence[str] = ()) -> F.Column:
    """Mean of the last ``rows`` rows; NULL until ``rows`` non-null values
    are in the window (pandas ``rolling(rows).mean()``).  Counts rows, not
    calendar days.  Σ stays exact for decimals and is divided as DOUBLE.
    """
    key = F.col(order).asc_nulls_last()
    w = Window.orderBy(key) if not partition_by else Window.partitionBy(*partition_by).orderBy(key)
    w = w.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(value).over(w) == rows,
                  F.sum(value).over(w).cast("double") / F.lit(float(rows)))


def revenue_moving_avg(orders: DataFrame, windows: Sequence[int] = (7, 28),
                       segment: Sequence[str] = (), ordered: bool = True) -> DataFrame:
    """Σ ``revenue_usd`` per day, plus ``ma{k}`` for each window size.

    After the (partially aggregated) daily roll-up there is one row per day
    and segment; the ordered window runs over that calendar-bounded series.
    With ``segment`` keys each segment is its own window partition.
    """
    keys = [*segment, day_of("order_ts").alias("day")]
    daily = orders.groupBy(*keys).agg(F.sum("revenue_usd").alias("revenue"))
    cols = [F.col(c) for c in segment] + [F.col("day"), F.col("revenue")]
    cols += [trailing_mean("revenue", "day", k, segment).alias(f"ma{k}") for k in windows]
    out = daily.select(*cols)
    return out.orderBy(*segment, F.asc_nulls_last("day")) if ordered else out
