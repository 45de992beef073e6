"""Global customer ranking and recency weights, without a single partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.global_rank import add_row_number
from ..plans.materialize import materialize
from .revenue import sorted_if


def ranked_customers(orders: DataFrame, customers: DataFrame, ordered: bool = True,
                     buckets: int | None = None) -> DataFrame:
    """Σ order revenue per customer with ROW_NUMBER and RANK by revenue desc.

    ``rn`` breaks revenue ties by ``customer_id`` (the reference leaves them
    open); ``rnk`` ranks on revenue alone, ties sharing a rank with gaps.
    Sorted by revenue, highest first.
    """
    per_customer = orders.groupBy("customer_id").agg(F.sum("revenue_usd").alias("revenue"))
    joined = (customers.select("customer_id", "country")
              .join(per_customer, "customer_id")
              .select("customer_id", "country", "revenue"))
    ranked, _ = add_row_number(joined, "revenue", descending=True, tiebreak=["customer_id"],
                               rn_col="rn", rank_col="rnk", buckets=buckets)
    return sorted_if(ranked.select("customer_id", "country", "revenue", "rn", "rnk"), ordered, "rn")


def customers_by_orders(orders: DataFrame, customers: DataFrame, ordered: bool = True,
                        buckets: int | None = None) -> DataFrame:
    """The same ranking by number of orders, where many customers tie."""
    per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
    joined = customers.select("customer_id", "country").join(per_customer, "customer_id")
    ranked, _ = add_row_number(joined, "orders", descending=True, tiebreak=["customer_id"],
                               rn_col="rn", rank_col="rnk", buckets=buckets)
    return sorted_if(ranked.select("customer_id", "country", "orders", "rn", "rnk"), ordered, "rn")


def recency_weight(customers: DataFrame, floor: float = 0.3, buckets: int | None = None) -> DataFrame:
    """Order-draw weight per customer: rank by signup date (first occurrence,
    i.e. ties by customer_id) scaled linearly from ``floor`` to 1 and
    normalised to sum 1.

    Ranks run 1..n, so Σ (floor + (1-floor)·r/n) = floor·n + (1-floor)(n+1)/2
    and no second pass over the data is needed for the total.
    """
    dated = materialize(customers.select("customer_id", "signup_date"))
    ranked, n = add_row_number(dated.where(F.col("signup_date").isNotNull()), "signup_date",
                               tiebreak=["customer_id"], rn_col="r", buckets=buckets)
    total = F.lit(float(n))
    raw = F.lit(floor) + F.lit(1.0 - floor) * F.col("r").cast("double") / total
    norm = F.lit(floor) * total + F.lit((1.0 - floor) / 2.0) * (total + F.lit(1.0))
    weighted = ranked.select("customer_id", (raw / norm).alias("weight"))
    missing = dated.where(F.col("signup_date").isNull()).select(
        "customer_id", F.lit(None).cast("double").alias("weight"))
    return weighted.unionByName(missing)
