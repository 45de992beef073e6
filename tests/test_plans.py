"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest

from cartlytics.registry import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    plan = _plan(QUERIES["daily_revenue"](spark, SF_SMALL))
    assert "l_discount" not in plan and "l_shipdate" not in plan
    assert "l_extendedprice" in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = QUERIES["customer_ltv"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_funnel_is_single_aggregation(spark):
    plan = _plan(QUERIES["customer_funnel"](spark, SF_SMALL))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def _window_specs(plan: str) -> list[str]:
    import re
    return re.findall(r"windowspecdefinition\(([^,]*),", plan)


@pytest.mark.parametrize("name,windows", [("ranked_customers", 1), ("customers_by_orders", 1), ("recency_weight", 0)])
def test_rank_windows_run_per_range(spark, name, windows):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    specs = set(_window_specs(plan))
    per_range = [s for s in specs if s.startswith("_range") and " ASC" not in s]
    assert len(per_range) == windows
    assert all(s.startswith("_range") for s in specs)  # the others order one row per range


def test_summary_orders_only_values_in_brackets(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from cartlytics.operators import revenue
    from cartlytics.plans import global_rank

    monkeypatch.setattr(global_rank, "add_row_number", None)  # not used any more
    df = spark.range(20_000).selectExpr("id", "cast(id * 3 as decimal(12,2)) as x")
    seen = []
    agg = DataFrame.agg

    def spy(self, *exprs):
        out = agg(self, *exprs)
        seen.append(_plan(out))
        return out

    monkeypatch.setattr(DataFrame, "agg", spy)
    row = revenue.distribution_summary(df, "x").first()
    assert row["p50"] == 3 * (20_000 - 1) / 2
    with_window = [p for p in seen if "Window" in p]
    assert len(with_window) == 1 and "Filter" in with_window[0]


def test_counts_and_keys_need_no_join_to_nations(spark):
    for name in ("table_row_counts", "check_primary_keys", "check_foreign_keys"):
        assert "n_nationkey" not in _plan(QUERIES[name](spark, SF_SMALL))


def test_sampled_items_broadcast_only_measured_keys(spark, monkeypatch):
    from cartlytics.operators import sampling

    assert "BroadcastHashJoin" in _plan(QUERIES["sampled_order_items"](spark, SF_SMALL))
    monkeypatch.setattr(sampling, "BROADCAST_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(QUERIES["sampled_order_items"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pvalue_has_no_python(spark):
    plan = _plan(QUERIES["ab_pvalue"](spark, SF_SMALL))
    assert "Python" not in plan and "Arrow" not in plan


def test_customer_ranking_is_sorted(spark):
    rows = QUERIES["ranked_customers"](spark, SF_SMALL).collect()
    assert [r["rn"] for r in rows] == list(range(1, len(rows) + 1))
