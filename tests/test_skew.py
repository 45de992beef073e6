"""Results stay exact when one customer owns a third of all orders."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlytics.operators import cohorts, quality, ranking, revenue


@pytest.fixture(scope="module")
def skewed(spark):
    n_orders = 3000
    orders = spark.range(n_orders).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400 + 100).alias("customer_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(days=(F.col("id") % 200).cast("int"))).alias("order_ts"),
        F.lit("web").alias("source"),
        ((F.col("id") % 97) + 1).cast("decimal(10,2)").alias("revenue_usd"))
    items = spark.range(n_orders * 2).select(
        (F.col("id") % n_orders).alias("order_id"),
        (F.col("id") % 40).alias("product_id"),
        ((F.col("id") % 4) + 1).cast("int").alias("qty"),
        ((F.col("id") % 13) + 2).cast("decimal(10,2)").alias("unit_price_usd"))
    customers = spark.range(100, 500).select(
        F.col("id").alias("customer_id"), F.lit(None).cast("date").alias("signup_date"),
        F.lit("QA").alias("country"), F.lit("x").alias("channel"))
    customers = customers.unionByName(spark.createDataFrame(
        [(7, None, "ZU", "radio")], "customer_id long, signup_date date, country string, channel string"))
    return {"orders": orders, "order_items": items, "customers": customers}


def test_ltv_with_hot_customer(skewed):
    ltv = {r["customer_id"]: (r["orders"], r["revenue_usd"])
           for r in revenue.customer_ltv(skewed["customers"], skewed["orders"], skewed["order_items"]).collect()}
    lines = skewed["order_items"].withColumn("rev", F.col("qty") * F.col("unit_price_usd"))
    plain = (skewed["orders"].join(lines, "order_id").groupBy("customer_id")
             .agg(F.countDistinct("order_id").alias("o"), F.sum("rev").alias("r")).collect())
    assert ltv == {r["customer_id"]: (r["o"], r["r"]) for r in plain}
    assert ltv[7][0] == 1000


def test_rank_with_hot_customer(skewed):
    out = ranking.ranked_customers(skewed["orders"], skewed["customers"], buckets=6)
    per = skewed["orders"].groupBy("customer_id").agg(F.sum("revenue_usd").alias("revenue"))
    w = Window.orderBy(F.desc_nulls_last("revenue"), "customer_id")
    exp = {r[0]: (r[1], r[2]) for r in per.select(
        "customer_id", F.row_number().over(w),
        F.rank().over(Window.orderBy(F.desc_nulls_last("revenue")))).collect()}
    assert {r["customer_id"]: (r["rn"], r["rnk"]) for r in out.collect()} == exp


def test_cohorts_and_keys_with_hot_customer(skewed):
    pc = {(r[0], r[1]): r[2] for r in cohorts.purchase_cohorts(skewed["orders"]).collect()}
    months = (skewed["orders"].select("customer_id", F.trunc(F.to_date("order_ts"), "month").alias("m")))
    first = months.groupBy("customer_id").agg(F.min("m").alias("c"))
    plain = (months.join(first, "customer_id").groupBy("c", "m")
             .agg(F.countDistinct("customer_id").alias("n")).collect())
    assert pc == {(r[0], r[1]): r[2] for r in plain}
    fk = {r["edge"]: r["violations"] for r in quality.check_foreign_keys(
        {"orders": skewed["orders"], "customers": skewed["customers"],
         "order_items": skewed["order_items"]}, skip_missing=True).collect()}
    assert fk["orders.customer_id -> customers.customer_id"] == 0
    assert fk["orders.order_id -> order_items.order_id"] == 0
