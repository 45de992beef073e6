"""Step funnels over an event table.

The reference builds the per-customer funnel from three filtered CTEs joined
back together; here it is one scan and one aggregation with conditional
``min`` per step (``tests/test_funnel.py`` checks the two forms agree).
Partial aggregation keeps a hot customer from landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import period_start, ratio

DEFAULT_STEPS = ("visit", "signup", "purchase")


def _first_step_times(steps: Sequence[str]) -> list:
    return [F.min(F.when(F.col("event_type") == s, F.col("event_ts"))).alias(f"{s}_ts") for s in steps]


def customer_funnel(events: DataFrame, steps: Sequence[str] = DEFAULT_STEPS) -> DataFrame:
    """First time of each step per customer who did the first step.

    Later steps need not follow earlier ones in time (as in the reference).
    """
    first = steps[0]
    later = [f"{s}_ts" for s in steps[1:]]
    known = F.col("customer_id").isNotNull()
    return (events.where(F.col("event_type").isin(list(steps)))
            .groupBy("customer_id")
            .agg(*_first_step_times(steps))
            .where(F.col(f"{first}_ts").isNotNull())
            # a NULL customer joins no later step in the reference's join form
            .select("customer_id", f"{first}_ts",
                    *[F.when(known, F.col(c)).alias(c) for c in later]))


def funnel_steps(funnel: DataFrame, steps: Sequence[str] = DEFAULT_STEPS) -> DataFrame:
    """Customers reaching each step, step-to-step rates, and first-to-last rate."""
    counts = funnel.agg(*[F.count(f"{s}_ts").alias(s) for s in steps])
    rates = [ratio(b, a).alias(f"{a}_to_{b}") for a, b in zip(steps, steps[1:])]
    if len(steps) > 2:
        rates.append(ratio(steps[-1], steps[0]).alias(f"{steps[0]}_to_{steps[-1]}"))
    return counts.select(*steps, *rates)


def monthly_funnel(events: DataFrame, steps: Sequence[str] = DEFAULT_STEPS,
                   grain: str = "month") -> DataFrame:
    """Customers by the period of their first first-step event, with how many
    of them ever reached each later step.

    All customers with any event count, as in the reference: those who never
    did the first step fall into a NULL period (kept, sorted last).
    """
    first = steps[0]
    per_customer = events.groupBy("customer_id").agg(*_first_step_times(steps))
    aggs = [F.count(F.lit(1)).alias(_plural(steps[0]))]
    aggs += [F.count(f"{s}_ts").alias(_plural(s)) for s in steps[1:]]
    return (per_customer
            .groupBy(period_start(f"{first}_ts", grain).alias(grain))
            .agg(*aggs)
            .orderBy(F.asc_nulls_last(grain)))


def _plural(step: str) -> str:
    """Column name of a step count: visit → visitors, signup → signups, purchase → purchasers."""
    special = {"visit": "visitors", "purchase": "purchasers"}
    return special.get(step, f"{step}s")


def monthly_funnel_rates(monthly: DataFrame, steps: Sequence[str] = DEFAULT_STEPS) -> DataFrame:
    """Adds ``a_to_b`` step-through rates; a zero denominator gives NULL."""
    names = [_plural(s) for s in steps]
    rates = [ratio(nb, na).alias(f"{a}_to_{b}")
             for (a, na), (b, nb) in zip(zip(steps, names), zip(steps[1:], names[1:]))]
    return monthly.select(*monthly.columns, *rates)
