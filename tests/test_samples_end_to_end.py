"""The operators on the small invented CSV set in tests/data (all six tables)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cartlytics.operators import experiment, funnel, quality, revenue
from cartlytics.reports import REPORTS, build_reports
from cartlytics.sources.schemas import SCHEMAS
from cartlytics.sources.tables import load_tables_csv

SAMPLES = os.path.join(os.path.dirname(__file__), "data")


@pytest.fixture(scope="module")
def t(spark):
    return load_tables_csv(spark, SAMPLES, enforce=True)


def test_types_and_counts(t):
    assert set(t) == set(SCHEMAS)
    counts = {name: df.count() for name, df in t.items()}
    assert counts["customers"] == 40 and counts["products"] == 12 and counts["orders"] == 90
    for name, df in t.items():
        assert [f.dataType for f in df.schema] == [f.dataType for f in SCHEMAS[name]]


def test_keys_intact(t):
    assert quality.check_primary_keys(t).agg(F.sum("null_keys") + F.sum("duplicate_keys")).first()[0] == 0
    assert quality.check_foreign_keys(t).agg(F.sum("violations")).first()[0] == 0


def test_header_revenue_equals_the_items(t):
    items = revenue.order_revenue(t["orders"], t["order_items"]).withColumnRenamed("revenue_usd", "items")
    both = items.join(t["orders"].select("order_id", "revenue_usd"), "order_id")
    assert both.where("items <> revenue_usd").count() == 0 and both.count() == 90


def test_funnel_loses_customers(t):
    row = funnel.funnel_steps(funnel.customer_funnel(t["events"])).first()
    assert row["visit"] == 40 > row["signup"] > row["purchase"] > 0


def test_experiment_arms(t):
    arms = {r["grp"]: r["users"] for r in experiment.ab_conversion(t["marketing_experiments"]).collect()}
    assert arms == {"A": 20, "B": 20}


def test_every_report_runs(t):
    built = build_reports(t)
    assert set(built) == set(REPORTS)
    assert all(df.count() >= 1 for df in built.values())
