"""Stored sketches that merge for any range of days.

Exact distinct counts and quantiles cannot be added up over days.  One row a day
holds a HyperLogLog sketch of the customers and a KLL sketch of the order values
(both of fixed size), besides the exact count and sum.  Any range, month or
weekday is then merged from those rows, without the orders.

Bounds: the distinct count's standard error is 1.04 / sqrt(2**lg_k) of the count
at most; the rank of a quantile is off by ``KLL_RANK_ERROR`` of the rows at most,
with 99 per cent confidence.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_of

LG_K = 12
KLL_K = 200
KLL_RANK_ERROR = 0.0165


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / math.sqrt(2 ** lg_k)


def daily_sketches(orders: DataFrame, keys: Sequence[str] = (), lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """(keys, day, orders, revenue, customers, value_sketch): one row a day.

    NULL customers and revenues are in ``orders`` but in no sketch; orders
    without a time have the NULL day."""
    value = F.col("revenue_usd").cast("double")
    return orders.groupBy(*keys, day_of("order_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue_usd").alias("revenue"),
        F.hll_sketch_agg("customer_id", lg_k).alias("customers"),
        F.kll_sketch_agg_double(value, F.lit(kll_k)).alias("value_sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str | Column] = (), first: date | None = None,
                    last: date | None = None, quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """(by, orders, revenue, customers_est, p50_est, ...): sketches of the days
    from ``first`` to ``last`` (closed; None: open) merged and read.

    ``by`` are columns or expressions over the stored rows, such as the month of
    ``day``.  Without any value a quantile is NULL."""
    rows = sketches
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last))
    merged = rows.groupBy(*by).agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"),
        F.hll_union_agg("customers").alias("_hll"), F.kll_merge_agg_double("value_sketch").alias("_kll"))
    known = F.kll_sketch_get_n_double("_kll") > 0
    names = [c for c in merged.columns if c not in ("_hll", "_kll")]
    return merged.select(*names, F.hll_sketch_estimate("_hll").alias("customers_est"), *[
        F.when(known, F.kll_sketch_get_quantile_double("_kll", F.lit(q))).alias(f"p{round(100 * q)}_est") for q in quantiles])


def sketch_check(orders: DataFrame, estimates: DataFrame, period: Column, quantiles: Sequence[float] = (0.5, 0.9),
                 lg_k: int = LG_K) -> DataFrame:
    """Exact figures of each period beside whether its estimates keep their bounds.

    ``estimates`` is ``merged_sketches(..., by=[period.alias("period")])``.  A
    count is in bound within 4 standard errors and one; a quantile is in bound
    if its rank among the values is within 3 rank errors of the one asked for."""
    value = F.col("revenue_usd").cast("double")
    rows = orders.select(period.alias("period"), "customer_id", value.alias("value"))
    near = rows.join(estimates.select("period", "customers_est", *[f"p{round(100 * q)}_est" for q in quantiles]),
                     rows["period"].eqNullSafe(estimates["period"])).drop(estimates["period"])
    at = [F.col(f"p{round(100 * q)}_est") for q in quantiles]
    exact = near.groupBy("period").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_id").alias("customers"),
        F.count("value").alias("_n"), F.max("customers_est").alias("_est"),
        *[F.count(F.when(F.col("value") < a, 1)).alias(f"_below{i}") for i, a in enumerate(at)],
        *[F.count(F.when(F.col("value") <= a, 1)).alias(f"_upto{i}") for i, a in enumerate(at)])
    off = F.abs(F.col("_est") - F.col("customers"))
    slack = 3 * KLL_RANK_ERROR
    return exact.select(
        "period", "orders", "customers",
        (off <= 4 * distinct_error(lg_k) * F.col("customers") + 1).alias("customers_in_bound"),
        *[((F.col(f"_below{i}") <= (q + slack) * F.col("_n")) & (F.col(f"_upto{i}") >= (q - slack) * F.col("_n")))
          .alias(f"p{round(100 * q)}_in_bound") for i, q in enumerate(quantiles)])
