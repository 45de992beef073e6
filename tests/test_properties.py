"""Property tests on generated inputs and on the test tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlytics.operators import cohorts as C
from cartlytics.operators import funnel as FN
from cartlytics.operators import revenue as R
from cartlytics.plans.global_rank import add_row_number
from cartlytics.sources.roles import RoleTables
from tests.conftest import SF_SMALL
from tests.test_funnel import three_cte_funnel

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.one_of(st.none(), st.integers(min_value=-3, max_value=3), st.integers(min_value=-10**6, max_value=10**6))


@SETTINGS
@given(vals=st.lists(values, min_size=1, max_size=60), desc=st.booleans(),
       buckets=st.integers(min_value=1, max_value=7))
def test_rank_matches_window(spark, vals, desc, buckets):
    df = spark.createDataFrame(list(enumerate(vals)), "id long, v long")
    out, n = add_row_number(df, "v", descending=desc, tiebreak=["id"], rn_col="rn",
                            rank_col="rnk", buckets=buckets)
    vo = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
    exp = df.select("id", F.row_number().over(Window.orderBy(vo, "id")).alias("rn"),
                    F.rank().over(Window.orderBy(vo)).alias("rnk"))
    assert n == len(vals)
    assert sorted(map(tuple, out.select("id", "rn", "rnk").collect())) == sorted(map(tuple, exp.collect()))


steps = st.sampled_from(["visit", "signup", "purchase", "trial_start", "cancel"])


@SETTINGS
@given(evs=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40), steps), min_size=1, max_size=40))
def test_one_pass_funnel_equals_join_form(spark, evs):
    t0 = datetime(2024, 1, 1)
    rows = [(i, c, t0 + timedelta(days=d), k) for i, (c, d, k) in enumerate(evs)]
    ev = spark.createDataFrame(rows, "event_id long, customer_id long, event_ts timestamp_ntz, event_type string")
    cols = ["customer_id", "visit_ts", "signup_ts", "purchase_ts"]
    got = sorted(map(tuple, FN.customer_funnel(ev).select(cols).collect()))
    exp = sorted(map(tuple, three_cte_funnel(ev).select(cols).collect()))
    assert got == exp


def test_revenue_totals_agree_on_test_tables(spark):
    r = RoleTables(spark, SF_SMALL)
    daily = R.daily_revenue(r.orders(), r.order_items()).agg(F.sum("daily_revenue_usd")).first()[0]
    cat = R.category_performance(r.order_items(), r.products()).agg(F.sum("revenue_usd")).first()[0]
    ltv = R.customer_ltv(r.customers(), r.orders(), r.order_items()).agg(F.sum("revenue_usd")).first()[0]
    assert daily == cat == ltv


def test_cohort_and_histogram_invariants(spark):
    r = RoleTables(spark, SF_SMALL)
    ret = C.cohort_retention(C.purchase_cohorts(r.orders(), ordered=False), 3)
    assert {x[0] for x in ret.where("month_offset = 0").select("retention").collect()} == {1.0}
    ltv = R.customer_ltv(r.customers(), r.orders(), r.order_items(), ordered=False)
    hist = R.ltv_histogram(ltv, 30)
    assert hist.agg(F.sum("customers")).first()[0] == ltv.count()
    assert hist.count() == 30
