from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartlytics.operators import quality as Q
from cartlytics.operators import sampling
from cartlytics.sources import schemas as S
from cartlytics.sources.roles import RoleTables
from tests.conftest import SF_SMALL, D, d, ts


def test_sample_is_exact_intact_and_partition_independent(spark):
    tables = RoleTables(spark, SF_SMALL).all()
    s = sampling.referential_sample(tables, n=40, seed=42)
    assert s["customers"].count() == 40
    assert s["products"].count() == tables["products"].count()
    ids = s["customers"].select("customer_id")
    assert s["orders"].join(ids, "customer_id", "left_anti").count() == 0
    assert s["order_items"].join(s["orders"].select("order_id"), "order_id", "left_anti").count() == 0
    assert s["events"].join(ids, "customer_id", "left_anti").count() == 0
    assert s["marketing_experiments"].join(ids.withColumnRenamed("customer_id", "user_id"),
                                           "user_id", "left_anti").count() == 0
    shuffled = dict(tables, customers=tables["customers"].repartition(7, "channel"))
    again = sampling.referential_sample(shuffled, n=40, seed=42)["customers"]
    assert sorted(r[0] for r in ids.collect()) == sorted(r[0] for r in again.select("customer_id").collect())
    other = sampling.sample_customers(tables["customers"], 40, seed=7)
    assert sorted(r[0] for r in other.select("customer_id").collect()) != \
        sorted(r[0] for r in ids.collect())


def test_key_checks(spark):
    customers = spark.createDataFrame([
        (1, d("2024-01-01"), "QA", None, None, "radio"), (1, d("2024-01-02"), "ZU", None, None, "radio"),
        (2, d("2024-01-03"), "TK", None, None, "flyer")], S.CUSTOMERS.fromJson(
            {**S.CUSTOMERS.jsonValue(), "fields": [{**f, "nullable": True} for f in S.CUSTOMERS.jsonValue()["fields"]]}))
    customers = customers.unionByName(spark.createDataFrame(
        [(None, d("2024-01-04"), "VB", None, None, "radio")], customers.schema))
    products = spark.createDataFrame([(10, "p", "garden", D(5))], S.PRODUCTS)
    orders = spark.createDataFrame([
        (100, 1, ts("2024-02-01 00:00:00"), "web", D(5)),
        (101, 9, ts("2024-02-02 00:00:00"), "web", D(5)),       # orphan order
        (102, 2, ts("2024-02-03 00:00:00"), "web", D(5))],      # order without item
        S.ORDERS)
    items = spark.createDataFrame([(100, 10, 1, D(5)), (101, 10, 1, D(5)), (555, 11, 1, D(5))], S.ORDER_ITEMS)
    tables = {"customers": customers, "products": products, "orders": orders, "order_items": items}
    pk = {r["table_name"]: r for r in Q.check_primary_keys(tables, skip_missing=True).collect()}
    c = pk["customers"]
    assert (c["n_rows"], c["null_keys"], c["duplicate_keys"], c["duplicate_rows"]) == (4, 1, 1, 1)
    assert pk["orders"]["duplicate_keys"] == 0 and pk["orders"]["n_rows"] == 3
    fk = {r["edge"]: r["violations"] for r in Q.check_foreign_keys(tables, skip_missing=True).collect()}
    assert fk["orders.customer_id -> customers.customer_id"] == 1
    assert fk["order_items.order_id -> orders.order_id"] == 1
    assert fk["order_items.product_id -> products.product_id"] == 1
    assert fk["orders.order_id -> order_items.order_id"] == 1
    assert fk["events.customer_id -> customers.customer_id"] is None and pk["events"]["n_rows"] is None
    with pytest.raises(KeyError, match="events"):
        Q.check_foreign_keys(tables)
    with pytest.raises(KeyError, match="events"):
        Q.check_primary_keys(tables)


def test_role_checks_on_test_tables(spark):
    tables = RoleTables(spark, SF_SMALL).all()
    pk = Q.check_primary_keys(tables, skip_missing=True)
    assert pk.agg(F.sum("duplicate_keys") + F.sum("null_keys")).first()[0] == 0


def test_export_with_sample_writes_both_sets(spark, tmp_path):
    from cartlytics.sources.roles import RoleTables
    from cartlytics.sources.tables import export_with_sample, list_tables

    tables = RoleTables(spark, SF_SMALL).all()
    sets = export_with_sample(tables, str(tmp_path), n=20, fmt="parquet")
    for name in tables:
        full, sample = (spark.read.parquet(f"{tmp_path}/{kind}/{name}.parquet") for kind in ("full", "samples"))
        assert full.count() == tables[name].count() and sample.count() == sets["samples"][name].count()
    customers, orders = (spark.read.parquet(f"{tmp_path}/samples/{t}.parquet") for t in ("customers", "orders"))
    assert customers.count() == 20 and orders.join(customers, "customer_id", "left_anti").isEmpty()
    assert list_tables(tables).count() == 6
