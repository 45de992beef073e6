from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartlytics.operators import cohorts as C
from tests.conftest import d, ts


def _orders(spark):
    rows = [(1, 1, "2024-01-03"), (2, 1, "2024-03-09"), (3, 1, "2024-04-01"), (4, 1, "2024-01-20"),
            (5, 2, "2024-02-14"), (6, 2, "2024-03-02"),
            (7, 3, "2024-01-31")]
    return spark.createDataFrame([(o, c, ts(t + " 00:00:00")) for o, c, t in rows],
                                 "order_id long, customer_id long, order_ts timestamp_ntz")


def test_purchase_cohorts(spark):
    got = {(r["cohort_month"], r["purchase_month"]): r["customers"]
           for r in C.purchase_cohorts(_orders(spark)).collect()}
    assert got == {(d("2024-01-01"), d("2024-01-01")): 2, (d("2024-01-01"), d("2024-03-01")): 1,
                   (d("2024-01-01"), d("2024-04-01")): 1, (d("2024-02-01"), d("2024-02-01")): 1,
                   (d("2024-02-01"), d("2024-03-01")): 1}


def test_retention_offsets(spark):
    ret = {(r["cohort_month"], r["month_offset"]): r["retention"]
           for r in C.cohort_retention(C.purchase_cohorts(_orders(spark)), 3).collect()}
    assert ret == {(d("2024-01-01"), 0): 1.0, (d("2024-01-01"), 2): 0.5, (d("2024-01-01"), 3): 0.5,
                   (d("2024-02-01"), 0): 1.0, (d("2024-02-01"), 1): 1.0}


def test_retention_calendar_literal_form(spark):
    ret = {(r["cohort_month"], r["purchase_month"]): r["retention"]
           for r in C.cohort_retention_calendar(C.purchase_cohorts(_orders(spark)), 4).collect()}
    jan, feb, mar, apr = (d(f"2024-0{m}-01") for m in (1, 2, 3, 4))
    assert ret[(jan, jan)] == 1.0 and ret[(jan, feb)] == 0.0 and ret[(jan, mar)] == 0.5
    # a later cohort has 0 in the first calendar column: x/0 and 0/0 are NULL
    assert all(ret[(feb, m)] is None for m in (jan, feb, mar, apr))
    assert len(ret) == 8


def test_customer_matrix_zero_filled(spark):
    m = C.cohort_customer_matrix(C.purchase_cohorts(_orders(spark)))
    assert m.columns == ["cohort_month", "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "no_month"]
    rows = {r["cohort_month"]: tuple(r)[1:] for r in m.collect()}
    assert rows == {d("2024-01-01"): (2, 0, 1, 1, 0), d("2024-02-01"): (0, 1, 1, 0, 0)}


def test_signup_cohort_revenue_and_matrix(shop):
    long = C.signup_cohort_revenue(shop["customers"], shop["orders"], shop["order_items"])
    got = {(r["signup_month"], r["order_month"]): float(r["revenue_usd"]) for r in long.collect()}
    assert got == {(d("2024-01-01"), d("2024-03-01")): 600.0, (d("2024-02-01"), d("2024-04-01")): 300.0}
    wide = C.cohort_revenue_matrix(long)
    rows = {r["signup_month"]: (r["2024-03-01"], r["2024-04-01"]) for r in wide.collect()}
    assert rows == {d("2024-01-01"): (600.0, 0.0), d("2024-02-01"): (0.0, 300.0)}
    assert long.agg(F.sum("revenue_usd")).first()[0] == 900


def _long(spark):
    return spark.createDataFrame([(d("2024-01-01"), d("2024-01-01"), 5), (d("2024-01-01"), d("2024-02-01"), 2),
                                  (d("2024-01-01"), None, 3), (None, d("2024-02-01"), 4)],
                                 "cohort_month date, purchase_month date, customers long")


def test_matrix_keeps_rows_without_a_month(spark):
    rows = {r["cohort_month"]: r for r in C.cohort_customer_matrix(_long(spark)).collect()}
    first = rows[d("2024-01-01")]
    assert (first["2024-01-01"], first["2024-02-01"], first["no_month"]) == (5, 2, 3)
    assert (rows[None]["2024-01-01"], rows[None]["2024-02-01"], rows[None]["no_month"]) == (0, 4, 0)


def test_matrix_fails_on_a_month_outside_the_list(spark):
    with pytest.raises(PySparkException, match="month outside the given list: 2024-02-01"):
        C.cohort_customer_matrix(_long(spark), [d("2024-01-01")]).collect()


def test_too_many_months_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(C, "MAX_MONTHS", 1)
    with pytest.raises(ValueError, match="more than 1 months"):
        C.cohort_customer_matrix(_long(spark))


def test_month_range():
    got = C.month_range(d("2023-11-15"), d("2024-02-01"))
    assert got == [d("2023-11-01"), d("2023-12-01"), d("2024-01-01"), d("2024-02-01")]
