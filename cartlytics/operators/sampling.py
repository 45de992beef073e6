"""Referentially intact, reproducible sample of the six tables.

A fixed number of customers is chosen by the order of ``md5(seed:id)`` (then
the id): exactly ``n`` rows, the same under any partitioning, unlike
``df.sample``.  Children follow their parents by semi-join; products, the
dimension, are kept whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize


def sample_key(seed: int | str, id_col: str) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def sample_customers(customers: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """The ``n`` customers first in md5 order (top-k, never a full sort)."""
    return (customers.withColumn("_k", sample_key(seed, "customer_id"))
            .orderBy("_k", "customer_id").limit(n).drop("_k"))


BROADCAST_KEYS = 200_000


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def referential_sample(tables: dict[str, DataFrame], n: int = 500, seed: int = 42) -> dict[str, DataFrame]:
    """Sampled customers, their orders, those orders' items, their events and
    experiment rows, and all products.

    ``n`` is the caller's and one customer can own a large share of all
    orders, so neither key set is broadcast unseen: both are written, counted,
    and broadcast only up to ``BROADCAST_KEYS`` rows; beyond that the
    semi-join is left to the planner.
    """
    customers = materialize(sample_customers(tables["customers"], n, seed))
    keys = _small(customers.select("customer_id"))
    orders = materialize(tables["orders"].join(keys, "customer_id", "left_semi"))
    items = tables["order_items"].join(_small(orders.select("order_id")), "order_id", "left_semi")
    events = tables["events"].join(keys, "customer_id", "left_semi")
    experiments = tables["marketing_experiments"].join(
        keys.withColumnRenamed("customer_id", "user_id"), "user_id", "left_semi")
    return {
        "customers": customers,
        "products": tables["products"],
        "orders": orders,
        "order_items": items,
        "events": events,
        "marketing_experiments": experiments,
    }
