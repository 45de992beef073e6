"""Signup and first-purchase cohorts, their matrices, and retention.

The long forms are the scalable results; the matrices pivot them on a month
list that is bounded by the calendar (read once, or passed in).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import month_of, months_apart, ratio
from ..plans.materialize import materialize
from .revenue import revenue_per_order, sorted_if


def signup_cohort_revenue(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                          ordered: bool = True) -> DataFrame:
    """Σ item revenue by signup month × order month.

    Items are summed per order and then per (customer, order month) before
    the customer dimension is joined, so the customer join sees one row per
    customer and month instead of one per line item.
    """
    per_order = revenue_per_order(order_items).select("order_id", "line_revenue")
    per_customer_month = (orders.select("order_id", "customer_id", month_of("order_ts").alias("order_month"))
                          .join(per_order, "order_id")
                          .groupBy("customer_id", "order_month")
                          .agg(F.sum("line_revenue").alias("line_revenue")))
    signup = customers.select("customer_id", F.trunc("signup_date", "month").alias("signup_month"))
    out = (per_customer_month.join(signup, "customer_id")
           .groupBy("signup_month", "order_month")
           .agg(F.sum("line_revenue").alias("revenue_usd")))
    return sorted_if(out, ordered, F.asc_nulls_last("signup_month"), F.asc_nulls_last("order_month"))


MAX_MONTHS = 2400
NO_MONTH = "no_month"


def month_values(df: DataFrame, column: str) -> list[date]:
    """Distinct non-null months of ``column``; more than ``MAX_MONTHS`` (two
    centuries: surely bad dates) is an error."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull())
             .distinct().orderBy(column).limit(MAX_MONTHS + 1).collect()]
    if len(found) > MAX_MONTHS:
        raise ValueError(f"{column} has more than {MAX_MONTHS} months; pass the months wanted as columns")
    return found


def month_range(first: date, last: date) -> list[date]:
    """Every month's first day from ``first`` to ``last``."""
    start, stop = first.year * 12 + first.month - 1, last.year * 12 + last.month - 1
    return [date(m // 12, m % 12 + 1, 1) for m in range(start, stop + 1)]


def pivot_months(long: DataFrame, row_key: str, column_key: str, value: str,
                 months: Sequence[date] | None = None, fill=0) -> DataFrame:
    """Long → wide: one column per month (named ``YYYY-MM-01``) and ``no_month``
    for rows without one; missing = ``fill``.  No row is lost: a month outside
    a given list fails the query.
    """
    if months is None:
        long = materialize(long)      # the value scan and the pivot read it once
        months = month_values(long, column_key)
    names = [m.strftime("%Y-%m-01") for m in months]
    month = F.col(column_key)
    known = F.col("_month").isin(names) if names else F.lit(False)
    named = long.select(row_key, F.coalesce(F.date_format(month, "yyyy-MM-01"), F.lit(NO_MONTH)).alias("_month"),
                        F.col(value).alias("_value"))
    named = named.withColumn("_month", F.when(known | (F.col("_month") == NO_MONTH), F.col("_month")).otherwise(
        F.raise_error(F.concat(F.lit("month outside the given list: "), F.col("_month"))).cast("string")))
    # one maximum per row and month, then one place in an array for each month
    wide = named.groupBy(row_key).pivot("_month", [*names, NO_MONTH]).agg(F.max("_value"))
    return wide.select(row_key, *[F.coalesce(F.col(f"`{c}`"), F.lit(fill)).alias(c) for c in [*names, NO_MONTH]])


def cohort_revenue_matrix(cohort_revenue: DataFrame, months: Sequence[date] | None = None) -> DataFrame:
    long = cohort_revenue.select("signup_month", "order_month",
                                 F.col("revenue_usd").cast("double").alias("revenue_usd"))
    return pivot_months(long, "signup_month", "order_month", "revenue_usd", months, 0.0)


def purchase_cohorts(orders: DataFrame, ordered: bool = True) -> DataFrame:
    """First-purchase month × purchase month → distinct customers.

    Orders are first reduced to distinct (customer, month) pairs (partial
    aggregation absorbs hot customers); the cohort month is then a window
    minimum over at most one row per calendar month per customer, and the
    distinct count becomes a plain count.
    """
    months = (orders.where(F.col("customer_id").isNotNull())
              .select("customer_id", month_of("order_ts").alias("purchase_month"))
              .distinct())
    per_customer = Window.partitionBy("customer_id")
    out = (months.withColumn("cohort_month", F.min("purchase_month").over(per_customer))
           .groupBy("cohort_month", "purchase_month")
           .agg(F.count(F.lit(1)).alias("customers")))
    return sorted_if(out, ordered, F.asc_nulls_last("cohort_month"), F.asc_nulls_last("purchase_month"))


def cohort_customer_matrix(cohorts: DataFrame, months: Sequence[date] | None = None) -> DataFrame:
    return pivot_months(cohorts, "cohort_month", "purchase_month", "customers", months, 0)


def cohort_retention(cohorts: DataFrame, max_offset: int = 3, ordered: bool = True) -> DataFrame:
    """Share of each cohort active ``k`` months after its first month, k ≤ max_offset.

    The divisor is the cohort's own offset-0 size (the corrected reading of
    "divide by the first column").  Offsets with no active customer are
    absent, i.e. read as 0.
    """
    with_offset = (cohorts.where(F.col("cohort_month").isNotNull() & F.col("purchase_month").isNotNull())
                   .withColumn("month_offset", months_apart("cohort_month", "purchase_month")))
    per_cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("month_offset") == 0, F.col("customers"))).over(per_cohort)
    out = (with_offset.where(F.col("month_offset").between(0, max_offset))
           .withColumn("cohort_size", size)
           .select("cohort_month", "month_offset", "customers", "cohort_size",
                   ratio("customers", "cohort_size").alias("retention")))
    return sorted_if(out, ordered, "cohort_month", "month_offset")


def cohort_retention_calendar(cohorts: DataFrame, n_months: int = 4, ordered: bool = True) -> DataFrame:
    """The literal matrix reading: each cohort's customers in the first
    ``n_months`` calendar months, divided by its count in the first calendar
    month (0-filled).  Every cohort but the earliest has 0 there, so its
    retention is NULL (x/0 and 0/0 both become NULL).
    """
    cohorts = materialize(cohorts.select("cohort_month", "purchase_month", "customers"))
    firsts = [r[0] for r in cohorts.where(F.col("purchase_month").isNotNull())
              .select("purchase_month").distinct().orderBy("purchase_month").limit(n_months).collect()]
    if not firsts:
        return cohorts.select("cohort_month", "purchase_month",
                              F.lit(None).cast("double").alias("retention")).limit(0)
    first_month = F.lit(firsts[0])
    grid = (cohorts.select("cohort_month").distinct()
            .select("cohort_month", F.explode(F.array(*[F.lit(m) for m in firsts])).alias("purchase_month")))
    cells = grid.join(cohorts.select("cohort_month", "purchase_month", "customers"),
                      ["cohort_month", "purchase_month"], "left")
    cells = cells.withColumn("customers", F.coalesce(F.col("customers"), F.lit(0)))
    per_cohort = Window.partitionBy("cohort_month")
    base = F.max(F.when(F.col("purchase_month") == first_month, F.col("customers"))).over(per_cohort)
    out = (cells.withColumn("base", F.coalesce(base, F.lit(0)))
           .select("cohort_month", "purchase_month", ratio("customers", "base").alias("retention")))
    return sorted_if(out, ordered, F.asc_nulls_last("cohort_month"), "purchase_month")


def retention_matrix(cohorts: DataFrame, n_months: int = 4) -> DataFrame:
    """``cohort_retention_calendar`` as a matrix: cohort_month, then ``m0`` to
    ``m{n-1}`` for the first calendar months; a month that does not occur is NULL.

    One row a cohort; the places come from at most ``n_months`` dates."""
    long = materialize(cohort_retention_calendar(cohorts, n_months, ordered=False))
    months = [r[0] for r in long.select("purchase_month").distinct().orderBy("purchase_month").collect()]
    places = [F.col("purchase_month") == F.lit(m) for m in months] + [F.lit(False)] * (n_months - len(months))
    return long.groupBy("cohort_month").agg(
        *[F.max(F.when(at, F.col("retention"))).alias(f"m{k}") for k, at in enumerate(places)])
