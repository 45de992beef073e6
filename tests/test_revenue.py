from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartlytics.operators import revenue as R
from cartlytics.operators import ranking, timeseries
from tests.conftest import d


def test_daily_revenue_inner_join_drops_order_without_items(shop):
    out = R.daily_revenue(shop["orders"], shop["order_items"]).collect()
    assert [(r["order_date"], r["daily_revenue_usd"]) for r in out] == [
        (d("2024-03-01"), Decimal("300.00")),   # two orders on one day
        (d("2024-03-03"), Decimal("300.00")),   # a day gap before
        (d("2024-04-02"), Decimal("300.00")),
    ]


def test_category_and_top_products(shop):
    cat = {r["category"]: (r["revenue_usd"], r["products_sold"])
           for r in R.category_performance(shop["order_items"], shop["products"]).collect()}
    assert cat == {"kitchen": (Decimal("500.00"), 1), "lighting": (Decimal("370.00"), 1),
                   "garden": (Decimal("30.00"), 1)}
    top = R.top_products(shop["order_items"], shop["products"], 2).collect()
    assert [(r["product_name"], r["item_lines"]) for r in top] == [
        ("Brindle Kettle", 2), ("Corvid Lantern", 3)]


def test_sums_agree_across_keys(shop):
    daily = R.daily_revenue(shop["orders"], shop["order_items"]).agg(F.sum("daily_revenue_usd")).first()[0]
    cat = R.category_performance(shop["order_items"], shop["products"]).agg(F.sum("revenue_usd")).first()[0]
    ltv = R.customer_ltv(shop["customers"], shop["orders"], shop["order_items"]).agg(F.sum("revenue_usd")).first()[0]
    assert daily == cat == ltv == Decimal("900.00")


def test_customer_ltv_counts_distinct_orders(shop):
    out = {r["customer_id"]: (r["orders"], r["revenue_usd"])
           for r in R.customer_ltv(shop["customers"], shop["orders"], shop["order_items"]).collect()}
    assert out == {1: (2, Decimal("300.00")), 2: (1, Decimal("300.00")), 4: (1, Decimal("300.00"))}


def test_order_revenue_keeps_orders_without_items(shop):
    out = {r["order_id"]: r["revenue_usd"] for r in R.order_revenue(shop["orders"], shop["order_items"]).collect()}
    assert out[103] is None and out[100] == Decimal("250.00") and out[104] == Decimal("300.00")


def _ltv(spark, values):
    return spark.createDataFrame([(i + 1, Decimal(str(v))) for i, v in enumerate(values)],
                                 "customer_id long, revenue_usd decimal(12,2)")


def test_summary_percentiles_linear(spark):
    row = R.ltv_summary(_ltv(spark, [1, 2, 4])).first()
    assert row["count"] == 3
    assert math.isclose(row["mean"], 7 / 3)
    assert math.isclose(row["std"], math.sqrt(7 / 3))
    assert (row["min"], row["max"]) == (1.0, 4.0)
    assert [round(row[k], 9) for k in ("p50", "p75", "p90", "p95")] == [2.0, 3.0, 3.6, 3.8]


def test_summary_single_value(spark):
    row = R.ltv_summary(_ltv(spark, [5])).first()
    assert row["count"] == 1 and row["p50"] == 5.0 and row["p95"] == 5.0 and row["std"] is None


def test_histogram_edges(spark):
    rows = R.ltv_histogram(_ltv(spark, [1, 2, 4]), 30).collect()
    assert len(rows) == 30 and sum(r["customers"] for r in rows) == 3
    got = {r["bucket"]: r["customers"] for r in rows if r["customers"]}
    assert got == {1: 1, 11: 1, 30: 1}          # max sits on the last (closed) edge
    assert rows[0]["bin_low"] == 1.0 and math.isclose(rows[-1]["bin_high"], 4.0)
    one = {r["bucket"]: r["customers"] for r in R.ltv_histogram(_ltv(spark, [5, 5]), 30).collect()
           if r["customers"]}
    assert one == {16: 2}                          # numpy widens min = max by 0.5


def test_ranked_customers_ties_and_null(shop):
    out = {r["customer_id"]: (r["rn"], r["rnk"])
           for r in ranking.ranked_customers(shop["orders"], shop["customers"], buckets=3).collect()}
    assert out == {1: (1, 1), 2: (2, 1), 4: (3, 1), 3: (4, 4)}


def test_recency_weight_sums_to_one(spark, shop):
    w = ranking.recency_weight(shop["customers"], 0.3, buckets=2)
    rows = {r["customer_id"]: r["weight"] for r in w.collect()}
    assert math.isclose(sum(rows.values()), 1.0)
    # rank 1..4 → 0.3 + 0.7 r / 4, normalised
    raw = [0.3 + 0.7 * r / 4 for r in range(1, 5)]
    assert [round(rows[c], 12) for c in (1, 2, 3, 4)] == [round(x / sum(raw), 12) for x in raw]


@pytest.mark.parametrize("n_rows", [6, 7, 28, 29])
def test_moving_average_counts_rows(spark, n_rows):
    from datetime import datetime, timedelta
    orders = spark.createDataFrame(
        [(i, 1, datetime(2024, 1, 1) + timedelta(days=2 * i), "web", Decimal(i + 1)) for i in range(n_rows)],
        "order_id long, customer_id long, order_ts timestamp_ntz, source string, revenue_usd decimal(10,2)")
    rows = timeseries.revenue_moving_avg(orders).collect()
    assert len(rows) == n_rows
    for i, r in enumerate(rows):
        if i < 6:
            assert r["ma7"] is None
        else:
            assert math.isclose(r["ma7"], sum(range(i - 5, i + 2)) / 7)
        if i < 27:
            assert r["ma28"] is None
        else:
            assert math.isclose(r["ma28"], sum(range(i - 26, i + 2)) / 28)


def test_top_products_merges_equal_names_and_breaks_ties(spark):
    from cartlytics.sources import schemas as S
    from tests.conftest import D
    products = spark.createDataFrame([
        (1, "Twin", "kitchen", D(10)), (2, "Twin", "kitchen", D(10)),   # same name+category merge
        (3, "Bravo", "garden", D(10)), (4, "Alpha", "garden", D(10)), (5, "Zulu", "garden", D(10)),
    ], S.PRODUCTS)
    items = spark.createDataFrame([
        (1, 1, 1, D(30)), (2, 2, 1, D(30)),                 # Twin: 60 over 2 lines
        (3, 3, 1, D(40)), (4, 4, 1, D(40)), (5, 5, 1, D(40)),  # three-way tie at 40
    ], S.ORDER_ITEMS)
    top = R.top_products(items, products, 3).collect()
    assert [(r["product_name"], r["revenue_usd"], r["item_lines"]) for r in top] == [
        ("Twin", Decimal("60.00"), 2), ("Alpha", Decimal("40.00"), 1), ("Bravo", Decimal("40.00"), 1)]


def test_line_sums_same_on_long_and_decimal_paths(spark, shop):
    fast = sorted(map(tuple, R.revenue_per_order(shop["order_items"]).collect()))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        slow = sorted(map(tuple, R.revenue_per_order(shop["order_items"]).collect()))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert fast == slow
    assert dict((k, v) for k, v, _ in fast)[104] == Decimal("300.00")


def test_summary_approximate_close_to_exact(spark):
    vals = [(i * 37) % 1000 for i in range(2000)]
    ltv = _ltv(spark, vals)
    exact = R.ltv_summary(ltv).first()
    approx = R.ltv_summary(ltv, approximate=True).first()
    assert exact.asDict().keys() == approx.asDict().keys()
    for k in ("count", "mean", "std", "min", "max"):
        assert math.isclose(exact[k], approx[k], rel_tol=1e-9)
    for k in ("p50", "p75", "p90", "p95"):
        assert abs(exact[k] - approx[k]) <= 2.0


def test_large_lines_do_not_overflow(spark):
    items = spark.createDataFrame([(1, 2, 1000, Decimal("9999999999999999.99"))],
                                  "order_id int, product_id int, qty int, unit_price_usd decimal(18,2)")
    assert R.revenue_per_order(items).first()["line_revenue"] == Decimal("9999999999999999990.00")


@pytest.mark.parametrize("values,std", [
    ([Decimal("1000000000.00"), Decimal("1000000000.01"), Decimal("1000000000.02")], 0.01),
    ([Decimal("50000000.00") + Decimal(i % 100) / 100 for i in range(100_000)],
     math.sqrt(9999 / 12 * 100_000 / 99_999) / 100),
])
def test_deviation_of_large_values_does_not_cancel(spark, values, std):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(14,2)")
    assert abs(R.distribution_summary(df, "x").first()["std"] - std) < 1e-6


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_percentiles_equal_numpy(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    x = {1: rng.normal(size=3000), 2: rng.integers(0, 4, 5000).astype(float), 3: np.array([7.5])}[seed]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    row = R.distribution_summary(df, "x", (0.0, 0.01, 0.5, 0.9), accuracy=50).first()
    for p, name in ((0, "p0"), (0.01, "p1"), (0.5, "p50"), (0.9, "p90")):
        assert abs(row[name] - np.quantile(x, p)) < 1e-9, p
    assert row["count"] == len(x)


def test_customer_listed_twice_gives_one_row(spark, shop):
    twice = shop["customers"].unionByName(shop["customers"].where("customer_id = 1"))
    rows = R.customer_ltv(twice, shop["orders"], shop["order_items"]).where("customer_id = 1").collect()
    once = R.customer_ltv(shop["customers"], shop["orders"], shop["order_items"]).where("customer_id = 1").first()
    assert len(rows) == 1 and rows[0]["orders"] == once["orders"] and rows[0]["revenue_usd"] == 2 * once["revenue_usd"]


@pytest.mark.parametrize("seed", range(4))
def test_a_missed_bracket_is_sought_on_its_side(spark, seed):
    """Whatever bracket was missed, the new one holds the positions and is narrow."""
    from cartlytics.operators.revenue import narrowed

    rng = random.Random(seed)
    values = sorted(float(rng.choice([5, 5, rng.randrange(10), rng.randrange(2000)])) for _ in range(900))
    vals = spark.createDataFrame([(v,) for v in values], "v double").cache()
    for bracket in ((3.0, 4.0), (700.0, 900.0), (5.0, 5.0), (-9.0, -1.0), (1e9, 2e9), (1500.0, 1500.5)):
        counts = (sum(v < bracket[0] for v in values), sum(v <= bracket[1] for v in values))
        at = rng.randrange(1, 900)
        need = (at, at + 1)
        (lo, hi), below = narrowed(vals, (values[0], values[-1]), bracket, need, counts, 900, 200)
        inside = [v for v in values if lo <= v <= hi]
        assert below == sum(v < lo for v in values) and below < need[0] and need[1] <= below + len(inside)
        held = below < need[0] <= need[1] <= counts[1] and lo == bracket[0]
        assert held or len(set(inside)) <= 120
