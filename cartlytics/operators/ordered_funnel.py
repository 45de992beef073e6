"""Funnels whose steps must follow each other in time, within a time limit.

A customer reaches step k if there are events of the steps 1 to k in this order
(equal times allowed), the last no later than ``within`` after the first.

The fold over a customer's events is a state machine whose partial states merge,
so a customer's events never meet in one place.  For a stretch of time a state
holds, for steps i < j:

- ``starts[j]``: the latest start of a run of steps 1 to j in the stretch,
- ``ends[i][j]``: the earliest time by which the steps i+1 to j have followed
  each other in the stretch,
- ``level``: the highest step reached.

Two neighbouring stretches combine from these alone: an earlier start goes on
where a later stretch ends soon enough.  The state has K + K(K-1)/2 times for K
steps, whatever the number of events.

States of (customer, chunk of time) come from running windows inside a chunk;
chunks of a customer, one for each ``chunk`` with any event at most, merge in
order.  A customer with a third of all rows is as many tasks as it has chunks.

Events without customer or time take no part, nor do kinds that are no step.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ratio
from .funnel import DEFAULT_STEPS
from .temporal import bucket_of, micros


def _pairs(k: int) -> list[tuple[int, int]]:
    """Steps i < j, from the second step on, whose passage is kept."""
    return [(i, j) for i in range(1, k) for j in range(i + 1, k + 1)]


def chunk_states(events: DataFrame, steps: Sequence[str], within: timedelta, chunk: timedelta) -> DataFrame:
    """(customer_id, chunk, level, s1..sK, e_i_j): one state per customer and chunk."""
    k, limit = len(steps), within // timedelta(microseconds=1)
    step = F.coalesce(*[F.when(F.col("event_type") == s, F.lit(n + 1)) for n, s in enumerate(steps)])
    rows = events.select("customer_id", micros("event_ts").alias("at"), step.alias("step"))
    rows = rows.where("customer_id IS NOT NULL AND at IS NOT NULL AND step IS NOT NULL")
    rows = rows.withColumn("chunk", bucket_of(F.col("at"), chunk // timedelta(microseconds=1)))
    # repeated events at one time change nothing, so they need not be sought out
    so_far = Window.partitionBy("customer_id", "chunk").orderBy("at", "step").rowsBetween(Window.unboundedPreceding, 0)
    is_step = [F.col("step") == n for n in range(k + 1)]
    rows = rows.withColumn("s1", F.when(is_step[1], F.col("at")))
    for j in range(2, k + 1):
        started = F.max(f"s{j - 1}").over(so_far)
        rows = rows.withColumn(f"s{j}", F.when(is_step[j] & (F.col("at") - started <= limit), started))
    for i, j in _pairs(k):
        here = F.when(is_step[j], F.col("at"))
        if j > i + 1:
            here = F.when(is_step[j] & F.min(f"e_{i}_{j - 1}").over(so_far).isNotNull(), F.col("at"))
        rows = rows.withColumn(f"e_{i}_{j}", here)
    return rows.groupBy("customer_id", "chunk").agg(
        *[F.max(f"s{j}").alias(f"s{j}") for j in range(1, k + 1)],
        *[F.min(f"e_{i}_{j}").alias(f"e_{i}_{j}") for i, j in _pairs(k)])


def _merged(a: Column, b: Column, k: int, limit: int) -> list[Column]:
    """The fields of the state of two neighbouring stretches, ``a`` first."""
    def least(options):
        return F.least(*options) if len(options) > 1 else options[0]

    starts = [F.greatest(a["s1"], b["s1"])]
    for j in range(2, k + 1):
        going = [F.when(b[f"e_{i}_{j}"] - a[f"s{i}"] <= limit, a[f"s{i}"]) for i in range(1, j)]
        starts.append(F.greatest(a[f"s{j}"], b[f"s{j}"], *going))
    ends = []
    for i, j in _pairs(k):
        # the first part in a, the rest in b; or all of it in either
        ends.append(least([a[f"e_{i}_{j}"], b[f"e_{i}_{j}"],
                           *[F.when(a[f"e_{i}_{m}"].isNotNull(), b[f"e_{m}_{j}"]) for m in range(i + 1, j)]]))
    names = [f"s{j}" for j in range(1, k + 1)] + [f"e_{i}_{j}" for i, j in _pairs(k)]
    return [c.alias(n) for c, n in zip([*starts, *ends], names, strict=True)]


def ordered_funnel(events: DataFrame, steps: Sequence[str] = DEFAULT_STEPS, within: timedelta = timedelta(days=2),
                   chunk: timedelta = timedelta(days=7)) -> DataFrame:
    """(customer_id, level): the highest step that each customer with any event
    of the steps reached in order and in time; 0 where only later steps occur."""
    if len(steps) < 2 or len(set(steps)) < len(steps):
        raise ValueError("two or more different steps")
    k, limit = len(steps), within // timedelta(microseconds=1)
    names = [f"s{j}" for j in range(1, k + 1)] + [f"e_{i}_{j}" for i, j in _pairs(k)]
    states = chunk_states(events, steps, within, chunk)
    # one state for each chunk of the calendar at most
    ordered = states.groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct("chunk", *names))).alias("chunks"))
    none = F.struct(*[F.lit(None).cast("long").alias(n) for n in names])
    whole = F.aggregate("chunks", none, lambda a, b: F.struct(*_merged(a, b, k, limit)))
    reached = F.coalesce(*[F.when(F.col(f"whole.s{j}").isNotNull(), F.lit(j)) for j in range(k, 0, -1)], F.lit(0))
    return ordered.select("customer_id", whole.alias("whole")).select("customer_id", reached.alias("level"))


def ordered_funnel_steps(funnel: DataFrame, steps: Sequence[str] = DEFAULT_STEPS) -> DataFrame:
    """Customers reaching each step, step-to-step rates, and first-to-last rate."""
    counts = funnel.agg(*[F.count(F.when(F.col("level") >= n + 1, 1)).alias(s) for n, s in enumerate(steps)])
    rates = [ratio(b, a).alias(f"{a}_to_{b}") for a, b in zip(steps, steps[1:], strict=False)]
    if len(steps) > 2:
        rates.append(ratio(steps[-1], steps[0]).alias(f"{steps[0]}_to_{steps[-1]}"))
    return counts.select(*steps, *rates)
