from __future__ import annotations

from pyspark.sql import functions as F

from cartlytics.operators import funnel as FN
from cartlytics.sources.roles import RoleTables
from tests.conftest import SF_SMALL, d, ts


def _events(spark):
    rows = [
        (1, 1, "2024-01-02 10:00:00", "visit"), (2, 1, "2024-01-03 10:00:00", "signup"),
        (3, 1, "2024-01-05 10:00:00", "purchase"), (4, 1, "2024-02-01 10:00:00", "visit"),
        (5, 2, "2024-01-01 09:00:00", "signup"), (6, 2, "2024-02-05 09:00:00", "visit"),
        (7, 3, "2024-01-10 09:00:00", "visit"), (8, 3, "2024-01-11 09:00:00", "purchase"),
        (9, 4, "2024-01-10 09:00:00", "trial_start"), (10, 4, "2024-01-12 09:00:00", "cancel"),
        (11, 5, "2024-03-01 09:00:00", "signup"), (12, 5, "2024-03-02 09:00:00", "purchase"),
        (13, 6, "2024-04-07 09:00:00", "visit"),                  # a month with no signup
    ]
    return spark.createDataFrame([(e, c, ts(t), k) for e, c, t, k in rows],
                                 "event_id long, customer_id long, event_ts timestamp_ntz, event_type string")


def three_cte_funnel(events):
    """The reference's join form, for comparison."""
    def first(step, name):
        return (events.where(F.col("event_type") == step).groupBy("customer_id")
                .agg(F.min("event_ts").alias(name)))
    return (first("visit", "visit_ts").join(first("signup", "signup_ts"), "customer_id", "left")
            .join(first("purchase", "purchase_ts"), "customer_id", "left"))


def _set(df):
    return sorted(tuple(r) for r in df.select("customer_id", "visit_ts", "signup_ts", "purchase_ts").collect())


def test_one_pass_equals_join_form(spark):
    ev = _events(spark)
    assert _set(FN.customer_funnel(ev)) == _set(three_cte_funnel(ev))
    real = RoleTables(spark, SF_SMALL).order_events()
    assert _set(FN.customer_funnel(real)) == _set(three_cte_funnel(real))


def test_funnel_steps(spark):
    row = FN.funnel_steps(FN.customer_funnel(_events(spark))).first()
    assert (row["visit"], row["signup"], row["purchase"]) == (4, 2, 2)
    assert row["visit_to_signup"] == 0.5 and row["signup_to_purchase"] == 1.0
    assert row["visit_to_purchase"] == 0.5


def test_funnel_zero_denominator_is_null(spark):
    ev = _events(spark).where(F.col("event_type") == "visit")
    row = FN.funnel_steps(FN.customer_funnel(ev)).first()
    assert row["signup"] == 0 and row["signup_to_purchase"] is None


def test_monthly_keeps_null_month(spark):
    rows = {r["month"]: (r["visitors"], r["signups"], r["purchasers"])
            for r in FN.monthly_funnel(_events(spark)).collect()}
    assert rows == {d("2024-01-01"): (2, 1, 2), d("2024-02-01"): (1, 1, 0), None: (2, 1, 1),
                    d("2024-04-01"): (1, 0, 0)}
    rates = {r["month"]: (r["visit_to_signup"], r["signup_to_purchase"])
             for r in FN.monthly_funnel_rates(FN.monthly_funnel(_events(spark))).collect()}
    assert rates[d("2024-02-01")] == (1.0, 0.0)
    assert rates[d("2024-04-01")] == (0.0, None)          # no signups: the rate is NULL
    assert FN.monthly_funnel(_events(spark)).collect()[-1]["month"] is None
