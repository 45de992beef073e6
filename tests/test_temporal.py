"""As-of and interval joins, ordered funnels, trailing totals and sessions against brute force."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from cartlytics.extended import BUILDERS
from cartlytics.operators import ordered_funnel, sessions, temporal, trailing
from cartlytics.plans.running_total import add_running_totals
from cartlytics.sources.roles import RoleTables
from tests.conftest import SF_SMALL

START = datetime(2024, 1, 1)
EVENTS = "event_id long, customer_id long, event_ts timestamp_ntz, event_type string"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _events(rng, n, customers=4, minutes=600, kinds=("visit", "signup", "purchase", "other")):
    """Whole minutes tie often; customer 0 has about a third of the rows; some ids and times are NULL."""
    rows = []
    for i in range(n):
        who = 0 if rng.random() < 0.33 else rng.randrange(customers)
        at = START + timedelta(minutes=rng.randrange(minutes))
        rows.append((i, None if rng.random() < 0.03 else who, None if rng.random() < 0.03 else at, rng.choice([*kinds, None])))
    return rows


@pytest.mark.parametrize("tolerance,splits", [(5, 1), (45, 1), (45, 4), (1000, 3)])
def test_asof_join(spark, tolerance, splits):
    rng = random.Random(tolerance)
    left, right = _events(rng, 150), _events(rng, 120)
    span = timedelta(minutes=tolerance)
    got = temporal.asof_join(
        spark.createDataFrame(left, EVENTS), spark.createDataFrame(right, EVENTS).toDF("r_id", "customer_id", "r_ts", "r_kind"),
        ["customer_id"], "event_ts", "r_ts", span, ["r_id", "r_ts"], tiebreak=["r_id"], splits=splits).collect()
    want = []
    for i, who, at, kind in left:
        fit = [(t, j) for j, w, t, _ in right if who is not None and at and w == who and t and at - span <= t <= at]
        best = max(fit, default=(None, None))
        want.append((i, who, at, kind, best[1], best[0]))
    assert sorted(map(tuple, got)) == sorted(want)


def test_asof_join_of_empty_sides_several_keys_and_clashes(spark):
    some = spark.createDataFrame(_events(random.Random(1), 20), EVENTS)
    other = some.toDF("r_id", "customer_id", "r_ts", "event_type").where("false")
    out = temporal.asof_join(some, other, ["customer_id", "event_type"], "event_ts", "r_ts", timedelta(1), ["r_id"])
    assert out.count() == 20 and out.where("r_id IS NOT NULL").isEmpty()
    assert temporal.asof_join(some.limit(0), other, ["customer_id"], "event_ts", "r_ts", timedelta(1), ["r_id"]).isEmpty()
    with pytest.raises(ValueError):
        temporal.asof_join(some, some, ["customer_id"], "event_ts", "event_ts", timedelta(1), ["event_id"])
    with pytest.raises(ValueError):
        temporal.asof_join(some, other, ["customer_id"], "event_ts", "r_ts", timedelta(0), ["r_id"])


@pytest.mark.parametrize("before,after", [(10, 0), (0, 0), (7, 25), (500, 500)])
def test_interval_join(spark, before, after):
    rng = random.Random(before + after)
    left, right = _events(rng, 80), _events(rng, 80)
    got = temporal.interval_join(
        spark.createDataFrame(left, EVENTS), spark.createDataFrame(right, EVENTS).toDF("r_id", "customer_id", "r_ts", "r_kind"),
        ["customer_id"], "event_ts", "r_ts", timedelta(minutes=before), timedelta(minutes=after), ["r_id"])
    want = [(i, j) for i, w, t, _ in left for j, v, u, _ in right if w is not None and w == v and t and u
            and t - timedelta(minutes=before) <= u <= t + timedelta(minutes=after)]
    assert sorted((r.event_id, r.r_id) for r in got.collect()) == sorted(want)


def test_joins_in_time_have_no_inequality_join_and_split_customers_by_time(spark):
    t = RoleTables(spark, SF_SMALL)
    for name in ("purchase_last_visit", "purchase_touches", "order_last_finished"):
        plan = _plan(BUILDERS[name](t))
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "_bucket" in plan
    assert "Join" not in _plan(BUILDERS["purchase_last_visit"](t))


def _brute_level(rows, steps, within):
    best = 0
    times = {s: sorted(t for t, k in rows if k == s) for s in steps}
    for start in times[steps[0]]:
        at, level = start, 1
        for s in steps[1:]:
            later = [t for t in times[s] if at <= t <= start + within]
            if not later:
                break
            at, level = later[0], level + 1
        best = max(best, level)
    return best


@pytest.mark.parametrize("steps,within,chunk", [
    (("visit", "signup", "purchase"), 30, 7), (("visit", "signup", "purchase"), 90, 60),
    (("a", "b", "c", "d"), 40, 5), (("visit", "signup"), 3, 1), (("a", "b", "c", "d", "e"), 200, 33)])
def test_ordered_funnel(spark, steps, within, chunk):
    rng = random.Random(len(steps) * within)
    rows = _events(rng, 400, customers=30, minutes=300, kinds=(*steps, "other"))
    got = ordered_funnel.ordered_funnel(spark.createDataFrame(rows, EVENTS), steps, timedelta(minutes=within),
                                        timedelta(minutes=chunk))
    held: dict = {}
    for _, who, at, kind in rows:
        if who is not None and at and kind in steps:
            held.setdefault(who, []).append((at, kind))
    want = {who: _brute_level(r, steps, timedelta(minutes=within)) for who, r in held.items()}
    assert {r.customer_id: r.level for r in got.collect()} == want
    assert len(set(want.values())) > 1


def test_funnel_states_do_not_grow_with_the_events(spark):
    rng = random.Random(5)
    for n in (50, 2000):
        rows = [(i, 1, START + timedelta(seconds=rng.randrange(86400 * 3)), rng.choice(["visit", "signup", "purchase"]))
                for i in range(n)]
        states = ordered_funnel.chunk_states(spark.createDataFrame(rows, EVENTS), ("visit", "signup", "purchase"),
                                             timedelta(hours=1), timedelta(days=1))
        assert states.count() == 3 and len(states.columns) == 2 + 3 + 3
    plan = _plan(ordered_funnel.ordered_funnel(spark.createDataFrame(rows, EVENTS)))
    lists = re.findall(r"collect_list\((.{0,20})", plan)
    assert lists and all("chunk" in x for x in lists)  # states, one a chunk, and no events
    with pytest.raises(ValueError):
        ordered_funnel.ordered_funnel(states, ("visit",))


ORDERS = "order_id long, customer_id long, order_ts timestamp_ntz, revenue_usd decimal(12,2)"


def _orders(rng, n):
    return [(i, w, t, None if rng.random() < 0.1 else Decimal(rng.randrange(100_000)) / 100)
            for i, w, t, _ in _events(rng, n, minutes=400)]


@pytest.mark.parametrize("keys,minutes,buckets", [((), 7, 5), ((), 60, 1), (("customer_id",), 15, 6), (("customer_id",), 500, 3)])
def test_trailing_range(spark, keys, minutes, buckets):
    rows, span = _orders(random.Random(minutes), 200), timedelta(minutes=minutes)
    got = trailing.trailing_range(spark.createDataFrame(rows, ORDERS), "order_ts", "revenue_usd", span, keys, buckets=buckets)
    want = set()
    for _, who, at, _ in rows:
        if at is None:
            continue
        same = [r for r in rows if r[2] is not None and (not keys or r[1] == who)]

        def total(lo, same=same, at=at):
            found = [r[3] for r in same if lo <= r[2] <= at and r[3] is not None]
            return (sum(found) if found else None), sum(lo <= r[2] <= at for r in same)

        want.add((*([who] if keys else []), at, total(at)[0], *total(at - span)))
    assert {tuple(r) for r in got.collect()} == want
    assert got.count() == len(want)


def test_trailing_totals_have_no_window_without_partitions(spark):
    t = RoleTables(spark, SF_SMALL)
    plan = _plan(BUILDERS["trailing_revenue"](t))
    windows = re.findall(r"windowspecdefinition\(([^,]*),", plan)
    assert windows and all(w.startswith("_range") for w in windows)
    ordered = [w for w in windows if " ASC" in w]
    assert len(set(ordered)) <= 1  # one row for each range
    with pytest.raises(ValueError):
        trailing.trailing_range(spark.range(1).selectExpr("now() AS ts", "1.5D AS v"), "ts", "v", timedelta(1))


def test_trailing_window(spark):
    rows, span = _orders(random.Random(3), 200), timedelta(minutes=33)
    got = trailing.trailing_window(
        spark.createDataFrame(rows, ORDERS), "order_ts", span, ["customer_id"],
        lambda w: [F.count(F.lit(1)).over(w).alias("n"), F.max("revenue_usd").over(w).alias("most")])
    want = []
    for i, who, at, v in rows:
        if at is not None:
            near = [r for r in rows if r[1] == who and r[2] is not None and at - span <= r[2] <= at]
            want.append((i, who, at, v, len(near), max((r[3] for r in near if r[3] is not None), default=None)))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(ValueError):
        trailing.trailing_window(got, "order_ts", span, [], lambda w: [])


def test_running_totals_over_many_ranges_with_a_hot_value(spark):
    rng = random.Random(2)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(50), None if i % 11 == 0 else rng.randrange(1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long, v long")
    got = add_running_totals(df, ["k", "id"], ["v"], buckets=15)
    so_far, want = 0, {}
    for i, k, v in sorted(rows, key=lambda r: (r[1], r[0])):
        so_far += v or 0
        want[i] = so_far
    assert {r.id: r.v_so_far for r in got.collect()} == want
    assert add_running_totals(df.limit(0), ["k", "id"], ["v"]).isEmpty()


def _brute_sessions(times, gap):
    out: list[list] = []
    for t in sorted(times):
        if out and t - out[-1][-1] <= gap:
            out[-1].append(t)
        else:
            out.append([t])
    return [(k + 1, s[0], s[-1], len(s)) for k, s in enumerate(out)]


@pytest.mark.parametrize("gap,bucket", product((2, 9, 300), (1, 10, 1440)))
def test_sessions(spark, gap, bucket):
    rows = _events(random.Random(gap), 250)
    df = spark.createDataFrame(rows, EVENTS).withColumn("one", F.lit(1))
    got = sessions.sessions(df, timedelta(minutes=gap), bucket=timedelta(minutes=bucket), sums=["one"])
    want = []
    for who in {r[1] for r in rows if r[1] is not None}:
        for k, a, b, n in _brute_sessions([r[2] for r in rows if r[1] == who and r[2]], timedelta(minutes=gap)):
            want.append((who, k, a, b, n, n))
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("bucket", [1, 60, 100_000])
def test_time_to_next(spark, bucket):
    rows = _events(random.Random(bucket), 300)
    got = sessions.time_to_next(spark.createDataFrame(rows, EVENTS), F.col("event_type") == "purchase",
                                bucket=timedelta(minutes=bucket))
    kept = sorted((w, t, i) for i, w, t, k in rows if k == "purchase" and w is not None and t)
    want = []
    for a, b in zip(kept, [*kept[1:], (None, None, None)], strict=True):
        same = a[0] == b[0]
        want.append((a[2], b[1] if same else None, (b[1] - a[1]).total_seconds() if same else None))
    assert sorted((r.event_id, r.next_ts, r.seconds_to_next) for r in got.collect()) == sorted(want)
