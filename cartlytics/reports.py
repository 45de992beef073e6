"""Every report over a user's own six tables.

``build_reports(tables)`` returns the named results on the tables given (for
example loaded with ``sources.tables.load_tables_csv``); the query registry is
derived from the same table of reports.  What several reports need (lifetime
values, cohorts, arm counts) is computed once and shared through ``Inputs``.
Reports that plan from data (ranks, summary, histogram, matrices, sample) run
those planning passes when they are built; the rest runs at the action.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import cohorts, experiment, funnel, quality, ranking, revenue, sampling, timeseries
from .plans.materialize import materialize
from .sources import tables as tbl
from .sources.schemas import PRIMARY_KEYS

Tables = dict[str, DataFrame]
SAMPLE = ("customers", "products", "orders", "order_items", "events", "marketing_experiments")
SAMPLE_SIZE, SAMPLE_SEED = 500, 42


class Inputs:
    """The tables and the intermediate results that reports share.

    With ``keep`` each shared result is written once and read by every report
    that needs it; a single query goes without.
    """

    def __init__(self, tables: Tables, keep: bool = True, months: Sequence[date] | None = None):
        self.tables, self.months = tables, months
        self._keep = materialize if keep else (lambda df: df)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @cached_property
    def ltv(self) -> DataFrame:
        return self._keep(revenue.customer_ltv(self["customers"], self["orders"], self["order_items"], ordered=False))

    @cached_property
    def signup_cohorts(self) -> DataFrame:
        return self._keep(cohorts.signup_cohort_revenue(
            self["customers"], self["orders"], self["order_items"], ordered=False))

    @cached_property
    def purchase_cohorts(self) -> DataFrame:
        return self._keep(cohorts.purchase_cohorts(self["orders"], ordered=False))

    @cached_property
    def funnel(self) -> DataFrame:
        return self._keep(funnel.customer_funnel(self["events"]))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._keep(funnel.monthly_funnel(self["events"]))

    @cached_property
    def conversion(self) -> DataFrame:
        return self._keep(experiment.ab_conversion(self["marketing_experiments"]))

    @cached_property
    def sample(self) -> Tables:
        return sampling.referential_sample(self.tables, SAMPLE_SIZE, SAMPLE_SEED)


_LINES = ("orders", "order_items")
_LTV = ("customers", "orders", "order_items")
_EXP = ("marketing_experiments",)



def _nulls_last(*names):
    return [F.asc_nulls_last(n) for n in names]


# report name -> (required tables, builder)
REPORTS: dict[str, tuple[tuple[str, ...], Callable[[Inputs], DataFrame]]] = {
    "daily_revenue": (_LINES, lambda t: revenue.daily_revenue(t["orders"], t["order_items"])),
    "category_performance": (("order_items", "products"),
                             lambda t: revenue.category_performance(t["order_items"], t["products"])),
    "top_products": (("order_items", "products"),
                     lambda t: revenue.top_products(t["order_items"], t["products"], 10)),
    "customer_ltv": (_LTV, lambda t: revenue.by_revenue(t.ltv)),
    "ltv_summary": (_LTV, lambda t: revenue.ltv_summary(t.ltv)),
    "ltv_histogram": (_LTV, lambda t: revenue.ltv_histogram(t.ltv, 30)),
    "signup_cohort_revenue": (_LTV, lambda t: t.signup_cohorts.orderBy(*_nulls_last("signup_month", "order_month"))),
    "cohort_revenue_matrix": (_LTV, lambda t: cohorts.cohort_revenue_matrix(t.signup_cohorts, t.months)),
    "ranked_customers": (("orders", "customers"),
                         lambda t: ranking.ranked_customers(t["orders"], t["customers"])),
    "customers_by_orders": (("orders", "customers"),
                            lambda t: ranking.customers_by_orders(t["orders"], t["customers"])),
    "revenue_moving_avg": (("orders",), lambda t: timeseries.revenue_moving_avg(t["orders"], (7, 28))),
    "purchase_cohorts": (("orders",), lambda t: t.purchase_cohorts.orderBy(*_nulls_last("cohort_month", "purchase_month"))),
    "cohort_customer_matrix": (("orders",), lambda t: cohorts.cohort_customer_matrix(t.purchase_cohorts, t.months)),
    "cohort_retention": (("orders",), lambda t: cohorts.cohort_retention(t.purchase_cohorts, 3)),
    "cohort_retention_calendar": (("orders",), lambda t: cohorts.cohort_retention_calendar(t.purchase_cohorts, 4)),
    "customer_funnel": (("events",), lambda t: t.funnel),
    "funnel_steps": (("events",), lambda t: funnel.funnel_steps(t.funnel)),
    "monthly_funnel": (("events",), lambda t: t.monthly.orderBy(*_nulls_last("month"))),
    "monthly_funnel_rates": (("events",), lambda t: funnel.monthly_funnel_rates(t.monthly).orderBy(*_nulls_last("month"))),
    "ab_conversion": (_EXP, lambda t: t.conversion),
    "ab_ztest": (_EXP, lambda t: experiment.ab_ztest(t["marketing_experiments"])),
    "ab_pvalue": (_EXP, lambda t: experiment.ab_pvalue(t["marketing_experiments"])),
    "ab_confidence": (_EXP, lambda t: experiment.ab_confidence(t.conversion, 0.05)),
    "order_revenue": (_LINES, lambda t: revenue.order_revenue(t["orders"], t["order_items"])),
    "referential_sample": (SAMPLE, lambda t: tbl.table_row_counts(t.sample)),
    **{f"sampled_{name}": (SAMPLE, lambda t, name=name: t.sample[name]) for name in SAMPLE if name != "products"},
    "recency_weight": (("customers",), lambda t: ranking.recency_weight(t["customers"], 0.3)),
    "check_primary_keys": (tuple(PRIMARY_KEYS), lambda t: quality.check_primary_keys(t.tables)),
    "check_foreign_keys": (SAMPLE, lambda t: quality.check_foreign_keys(t.tables)),
    "table_row_counts": ((), lambda t: tbl.table_row_counts(t.tables)),
    "table_preview": (("orders",), lambda t: tbl.table_preview(t["orders"], "order_id", 5)),
    **{f"preview_{name}": ((name,), lambda t, name=name: tbl.table_preview(t[name], PREVIEW_KEYS[name], 5))
       for name in SAMPLE},
}

#: A repeatable first-rows order per table (line items have no key of their own).
PREVIEW_KEYS = {**{t: [k] for t, k in PRIMARY_KEYS.items()},
                "order_items": ["order_id", "product_id", "qty", "unit_price_usd"]}


def build_reports(tables: Tables, names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Named report DataFrames over ``tables``; a missing table is an error."""
    wanted = names if names is not None else tuple(REPORTS)
    missing = sorted({t for name in wanted for t in REPORTS[name][0] if t not in tables})
    if missing:
        raise KeyError(f"tables not given: {', '.join(missing)}")
    inputs = Inputs(tables)
    return {name: REPORTS[name][1](inputs) for name in wanted}


def available_reports(tables: Tables) -> tuple[dict[str, DataFrame], list[str]]:
    """The reports that the given tables allow, and the names of the others."""
    able = tuple(name for name, (needs, _) in REPORTS.items() if tables and all(t in tables for t in needs))
    return build_reports(tables, able), [name for name in REPORTS if name not in able]
