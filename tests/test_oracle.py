"""Every registered query against its DuckDB oracle on the smallest tables,
and the shared role projections against their SQL text."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from cartlytics.oracle import SQL
from cartlytics.registry import QUERIES
from cartlytics.sources.roles import ROLE_SQL, RoleTables, with_roles
from tests.conftest import SF_SMALL

TABLES = "nation customer part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    exp = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_every_query_has_an_oracle(con):
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    for name, sql in SQL.items():  # the driver stores each as a view
        con.execute(f"CREATE OR REPLACE VIEW v_{name} AS {sql}")


def test_ranks_by_orders_have_ties_and_steps_lose_customers(spark):
    ranked = E.queries()["customers_by_orders"](spark, SF_SMALL)
    assert ranked.where("rn <> rnk").count() > 10
    steps = E.queries()["order_funnel_steps"](spark, SF_SMALL).first()
    assert steps["visit"] > steps["signup"] > 0


@pytest.mark.parametrize("role,method", [
    ("r_customers", "customers"), ("r_products", "products"), ("r_orders", "orders"),
    ("r_order_items", "order_items"), ("r_events", "events"), ("r_order_events", "order_events"),
    ("r_experiments", "marketing_experiments")])
def test_role_dataframe_equals_role_sql(spark, con, role, method):
    df = getattr(RoleTables(spark, SF_SMALL), method)()
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(with_roles(f"SELECT * FROM {role}", role))
    exp = _canon([d[0] for d in res.description], res.fetchall())
    assert got == exp
    assert role in ROLE_SQL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_date", "daily_revenue_usd"] and df.count() > 0
