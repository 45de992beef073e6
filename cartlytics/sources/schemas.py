"""Declared schemas of the six product-analytics tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.IntegerType(), False),
    T.StructField("signup_date", T.DateType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("age_band", T.StringType(), True),
    T.StructField("income_band", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("price_usd", MONEY, True),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.IntegerType(), False),
    T.StructField("customer_id", T.IntegerType(), True),
    T.StructField("order_ts", T.TimestampNTZType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("revenue_usd", MONEY, True),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.IntegerType(), True),
    T.StructField("product_id", T.IntegerType(), True),
    T.StructField("qty", T.IntegerType(), True),
    T.StructField("unit_price_usd", MONEY, True),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.IntegerType(), False),
    T.StructField("customer_id", T.IntegerType(), True),
    T.StructField("event_ts", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
])

MARKETING_EXPERIMENTS = T.StructType([
    T.StructField("exp_id", T.IntegerType(), False),
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("group", T.StringType(), True),
    T.StructField("exposed_ts", T.TimestampNTZType(), True),
    T.StructField("converted", T.BooleanType(), True),
    T.StructField("conversion_ts", T.TimestampNTZType(), True),
])

SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "events": EVENTS,
    "marketing_experiments": MARKETING_EXPERIMENTS,
}

# Declared primary keys; order_items has none.
PRIMARY_KEYS: dict[str, str] = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "events": "event_id",
    "marketing_experiments": "exp_id",
}

# Documented (not declared) relationships: (child, fk column, parent, pk column).
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("events", "customer_id", "customers", "customer_id"),
    ("marketing_experiments", "user_id", "customers", "customer_id"),
]
