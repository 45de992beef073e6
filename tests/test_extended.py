"""Sketches, cubes, stored reports, reconciliation, JSON columns, resampling and the stream."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from cartlytics.extended import BUILDERS
from cartlytics.functions.columns import month_of
from cartlytics.operators import cubes, props, reconcile, resampling, sketches
from cartlytics.oracle import SQL
from cartlytics.registry import QUERIES
from cartlytics.sources import report_table
from cartlytics.sources.roles import RoleTables
from cartlytics.streaming import revenue as stream
from tests.conftest import SF_SMALL, D, ts
from tests.test_oracle import _canon

ORDERS = "order_id long, customer_id long, order_ts timestamp_ntz, revenue_usd decimal(12,2)"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


#: Every so many rows a NULL, in the columns that the roles read.
NULLS = {"orders": ("o_orderkey", {"o_orderdate": 17, "o_custkey": 23, "o_totalprice": 29}),
         "events": ("event_id", {"user_id": 13, "ts": 19, "props": 7, "event_type": 31}),
         "lineitem": ("l_orderkey * 7 + l_linenumber", {"l_quantity": 37, "l_partkey": 41}),
         "part": ("p_partkey", {"p_type": 11}), "customer": ("c_custkey", {"c_nationkey": 9})}


@pytest.fixture(scope="module")
def with_nulls(tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("nulls"), duckdb.connect()
    for t in "nation customer part orders lineitem events".split():
        key, every = NULLS.get(t, ("", {}))
        put = ", ".join(f"CASE WHEN ({key}) % {n} = 0 THEN NULL ELSE {c} END AS {c}" for c, n in every.items())
        con.execute(f"COPY (SELECT * {f'REPLACE ({put})' if put else ''} FROM '{SF_SMALL}/{t}.parquet') TO '{folder}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", [*BUILDERS, "purchase_cohorts", "cohort_customer_matrix", "ab_conversion", "monthly_funnel",
                                  "signup_cohort_revenue", "customer_ltv", "ranked_customers"])
def test_queries_over_null_keys_times_and_amounts(spark, with_nulls, name):
    folder, con = with_nulls
    df = QUERIES[name](spark, folder)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(SQL[name])
    assert got == _canon([d[0] for d in res.description], res.fetchall())


# --- sketches


def _sketch_orders(rng, n=6000):
    """A third of the orders are one customer's; some values, ids and times are NULL."""
    rows = []
    for i in range(n):
        who = 1 if i % 3 == 0 else rng.randrange(2000)
        at = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 90))
        rows.append((i, None if i % 50 == 0 else who, None if i % 70 == 0 else at,
                     None if i % 40 == 0 else Decimal(int(rng.paretovariate(1.2) * 100)) / 100))
    return rows


def test_merged_sketches_keep_their_bounds_over_any_range(spark):
    rows = _sketch_orders(random.Random(1))
    stored = sketches.daily_sketches(spark.createDataFrame(rows, ORDERS)).cache()
    for first, last in ((None, None), (date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 20), date(2024, 2, 25)),
                        (date(2024, 3, 1), None)):
        got = sketches.merged_sketches(stored, [], first, last, (0.1, 0.5, 0.99)).first()
        own = [r for r in rows if (first is None or (r[2] and r[2].date() >= first)) and (last is None or (r[2] and r[2].date() <= last))]
        customers = {r[1] for r in own if r[1] is not None}
        assert got.orders == len(own) and got.revenue == sum(r[3] for r in own if r[3] is not None)
        assert abs(got.customers_est - len(customers)) <= 4 * sketches.distinct_error() * len(customers) + 1
        values = sorted(float(r[3]) for r in own if r[3] is not None)
        for q, est in ((0.1, got.p10_est), (0.5, got.p50_est), (0.99, got.p99_est)):
            assert sum(v < est for v in values) <= (q + 3 * sketches.KLL_RANK_ERROR) * len(values)
            assert sum(v <= est for v in values) >= (q - 3 * sketches.KLL_RANK_ERROR) * len(values)


def test_merging_reads_stored_rows_and_not_the_orders(spark):
    t = RoleTables(spark, SF_SMALL)
    stored = sketches.daily_sketches(t.orders())
    assert "partial_hll_sketch_agg" in _plan(stored)
    assert stored.count() <= 2500  # a row a day
    none = sketches.merged_sketches(stored.where("false"), [month_of("day").alias("m")])
    assert none.isEmpty()
    empty = spark.createDataFrame([(1, None, datetime(2024, 1, 1), None)], ORDERS)
    got = sketches.merged_sketches(sketches.daily_sketches(empty)).first()
    assert (got.orders, got.revenue, got.customers_est, got.p50_est) == (1, None, 0, None)


def test_sketch_check_sees_a_wrong_estimate(spark):
    orders = spark.createDataFrame(_sketch_orders(random.Random(2), 900), ORDERS)
    merged = sketches.merged_sketches(sketches.daily_sketches(orders), [month_of("day").alias("period")])
    good = sketches.sketch_check(orders, merged, month_of("order_ts"))
    assert good.where("NOT (customers_in_bound AND p50_in_bound AND p90_in_bound)").isEmpty()
    wrong = merged.withColumn("p50_est", F.col("p90_est")).withColumn("customers_est", F.col("customers_est") * 2)
    bad = sketches.sketch_check(orders, wrong, month_of("order_ts"))
    assert bad.where("customers_in_bound OR p50_in_bound").where("orders > 50").isEmpty()


# --- cubes


@pytest.mark.parametrize("sets", [None, [("a",), ("b", "c"), ()]])
def test_distinct_cube(spark, sets):
    rng = random.Random(4)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice(["p", "q"]),
             None if i % 17 == 0 else 5 if i % 3 == 0 else rng.randrange(-200, 200), rng.randrange(100)) for i in range(800)]
    df = spark.createDataFrame(rows, "a string, b int, c string, id long, v long")
    dims = ("a", "b", "c")
    sets = sets or cubes.cube_sets(dims)
    got = {(tuple(r[:3]), r.level): (r.v, r.ids) for r in cubes.distinct_cube(df, dims, "id", ["v"], sets, "ids").collect()}
    want: dict = {}
    for s in sets:
        level = sum((d not in s) << (2 - k) for k, d in enumerate(dims))
        for r in rows:
            key = (tuple(x if d in s else None for d, x in zip(dims, r, strict=False)), level)
            total, ids = want.setdefault(key, [0, set()])
            want[key][0] += r[4]
            if r[3] is not None:
                ids.add(r[3])
    assert got == {k: (v, len(ids)) for k, (v, ids) in want.items()}


def test_cube_reads_line_items_once_and_shuffles_words_not_customers(spark):
    t = RoleTables(spark, SF_SMALL)
    plan = _plan(BUILDERS["revenue_cube"](t))
    body = plan.split("Initial Plan")[0] if "Initial Plan" in plan else plan
    assert body.count("lineitem.parquet") == 1 and "Expand" in plan
    assert "partial_bit_or" in plan and "count(distinct" not in plan.lower()
    assert cubes.rollup_sets("abc") == [("a", "b", "c"), ("a", "b"), ("a",), ()]
    out = BUILDERS["revenue_rollup"](t)
    assert out.where("customers < 10").isEmpty() and out.where("level = 3").count() == 1


def test_cube_tasks_follow_the_line_items(spark, monkeypatch):
    t = RoleTables(spark, SF_SMALL)
    lines = t.order_items().count()
    for most in (1000, 300):
        monkeypatch.setattr(cubes, "TASK_ROWS", most)
        plan = BUILDERS["revenue_cube"](t)._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"hashpartitioning\((\w+)#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)
        assert set(dealt) == {(key, str(-(-lines // most))) for key in ("order_id", "_word")}


def test_tasks_of_the_sql_follow_the_line_items(spark, monkeypatch):
    t = RoleTables(spark, SF_SMALL)
    lines, before = t.order_items().count(), spark.conf.getAll
    monkeypatch.setattr(cubes, "TASK_ROWS", 300)
    df = BUILDERS["sql_category_months"](t)
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(category#\d+, [^()]*, (\d+)\)", plan)
    assert dealt and set(dealt) == {str(-(-lines // 300))}
    monkeypatch.undo()
    assert spark.conf.getAll == before  # the caller's session is left alone
    assert df.collect() == BUILDERS["sql_category_months"](t).collect()


# --- stored report


def _daily(spark, path):
    return {(r.day, r.revenue, r.orders) for r in report_table.read(spark, path).collect()}


def _recomputed(orders):
    out: dict = {}
    for _, _, at, v in orders:
        day = at.date() if at else None
        total, n = out.get(day, (None, 0))
        out[day] = ((total or 0) + v if v is not None else total, n + 1)
    return {(d, v, n) for d, (v, n) in out.items()}


def test_changes_equal_recomputation_and_count_once(spark, tmp_path):
    rng = random.Random(6)

    def make(ids):
        return [(i, 1, None if i % 31 == 0 else datetime(2024, 1, 1) + timedelta(days=rng.randrange(120)), D(rng.randrange(500)))
                for i in ids]

    path = str(tmp_path / "daily")
    base, late = make(range(200)), make(range(200, 260))
    frame = lambda rows: spark.createDataFrame(rows, ORDERS)
    report_table.create(path, frame(base))
    report_table.apply_changes(spark, path, report_table.differences(None, frame(late)), 1)
    assert _daily(spark, path) == _recomputed(base + late)
    # an order moves to another day, another changes its amount, a whole day goes
    old = [base[0], base[1], *[r for r in base[2:] if r[2] and r[2].date() == date(2024, 2, 3)]]
    new = [(*base[0][:2], ts("2024-09-09 10:00:00"), base[0][3]), (*base[1][:3], D(9999))]
    change = report_table.differences(frame(old), frame(new))
    after = [r for r in base + late if r not in old] + new
    for _ in range(3):  # a batch that is sent again changes nothing
        report_table.apply_changes(spark, path, change, 2)
        assert _daily(spark, path) == _recomputed(after)
    report_table.apply_changes(spark, path, report_table.differences(frame(late[:0]), None), 3)
    assert _daily(spark, path) == _recomputed(after)


def test_only_changed_months_are_written_and_a_failed_run_leaves_the_table(spark, tmp_path):
    path = tmp_path / "daily"
    rows = [(i, 1, datetime(2024, 1 + i % 4, 5), D(10)) for i in range(40)]
    report_table.create(str(path), spark.createDataFrame(rows, ORDERS))
    files = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    change = report_table.differences(None, spark.createDataFrame([(99, 1, datetime(2024, 2, 7), D(5))], ORDERS))

    broken = change.withColumn("orders", F.when(F.col("day") > date(2000, 1, 1), F.raise_error(F.lit("lost"))).cast("long"))
    with pytest.raises(Exception, match="lost"):
        report_table.apply_changes(spark, str(path), broken, 1)
    assert _daily(spark, str(path)) == _recomputed(rows)

    report_table.apply_changes(spark, str(path), change, 1)
    kept = {f for f in path.rglob("*.parquet") if files.get(f) == f.stat().st_mtime_ns}
    assert {f.parent.name for f in files} - {f.parent.name for f in kept} == {"month=2024-02"}


def test_a_run_that_died_between_months_is_finished_by_repeating_it(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = [(i, 1, datetime(2024, 1 + i % 3, 5), D(10)) for i in range(30)]
    more = [(50, 1, datetime(2024, 1, 5), D(1)), (51, 1, datetime(2024, 2, 5), D(2))]
    report_table.create(path, spark.createDataFrame(rows, ORDERS))
    change = report_table.differences(None, spark.createDataFrame(more, ORDERS))
    report_table.apply_changes(spark, path, change.where("day < '2024-02-01'"), 1)  # as far as it came
    report_table.apply_changes(spark, path, change, 1)
    assert _daily(spark, path) == _recomputed(rows + more)


# --- reconciliation


def test_reconciled_orders(spark):
    orders = spark.createDataFrame([
        (1, 1, None, D(10)), (2, 1, None, D(10)), (3, 1, None, None), (4, 1, None, D(5)), (None, 1, None, D(7)),
        (6, 1, None, D(3)), (6, 1, None, D(4)), (0, 1, None, D(1))], ORDERS)
    items = spark.createDataFrame([(1, 2, D(5)), (2, 3, D(5)), (3, 1, D(1)), (5, 1, D(2)), (None, 7, D(1)), (6, 7, D(1))],
                                  "order_id long, qty int, unit_price_usd decimal(10,2)")
    got = {r.order_id: r.cause for r in reconcile.reconciled_orders(orders, items).collect()}
    assert got == {1: "equal", 2: "differs", 3: "no amount", 4: "no items", 5: "no header", None: "equal", 6: "equal", 0: "no items"}
    close = reconcile.reconciled_orders(orders, items, Decimal("5.00"))
    assert close.where("order_id = 2").first().cause == "equal"
    summary = {r.cause: r for r in reconcile.reconciliation_summary(reconcile.reconciled_orders(orders, items)).collect()}
    assert summary["differs"].gap_usd == D(5) and summary["equal"].orders == 3
    assert set(summary) <= set(reconcile.CAUSES)


def test_table_difference(spark):
    rng = random.Random(8)
    a, b = ([(rng.choice([1, 2, None]), rng.choice(["x", None])) for _ in range(n)] for n in (40, 55))
    kinds = "k long, s string"
    left, right = spark.createDataFrame(a, kinds), spark.createDataFrame(b, "other long, names string")
    got = {(r.k, r.s): (r.side, r.copies) for r in reconcile.table_difference(left, right).collect()}
    want = {}
    for row in set(a) | set(b):
        n = a.count(row) - b.count(row)
        if n:
            want[row] = ("left" if n > 0 else "right", abs(n))
    assert got == want and reconcile.table_difference(left, left).isEmpty()


# --- JSON columns


def test_schema_and_columns_of_json(spark):
    rows = [(1, '{"k": 1, "name": "a", "x": 1}'), (2, '{"k": 2.5, "x": "b", "a b": true}'), (3, "no json"), (4, None),
            (5, '{"k": null, "in": {"p": [1, 2]}}'), (6, "[1]"), (7, "{}")]
    df = spark.createDataFrame([r for r in rows if r[0] != 6], "id long, props string")
    schema = props.json_schema(df, "props")
    assert set(schema) == {"k", "name", "x", "a b", "in"} and schema["x"] == "VARIANT"
    out = {r.id: r for r in props.shredded(df, "props", {k: t for k, t in schema.items() if t != "VARIANT"}, "p_").collect()}
    assert out[1].p_k == 1 and float(out[2].p_k) == 2.5 and out[2]["p_a b"] is True and out[3].p_k is None
    assert out[5]["p_in"].p == [1, 2] and out[4].p_name is None and out[7].p_k is None
    assert props.json_schema(df.where("id IN (3, 4)"), "props") == {}
    with pytest.raises(ValueError):
        props.shredded(df, "props", {"id": "BIGINT"})
    with pytest.raises(ValueError):
        props.json_schema(df, "props", max_keys=2)


def test_key_statistics(spark):
    rows = [("a", '{"k": 1, "s": "x"}'), ("a", '{"k": 1}'), ("b", '{"k": "z"}'), ("b", None), ("a", '{"k": 2.5}'), ("a", "{}")]
    got = props.key_statistics(spark.createDataFrame(rows, "kind string, props string"), "props", ["kind"])
    assert {(r.kind, r.key): (r.rows, r.distinct_values, r.numbers, r.total and float(r.total)) for r in got.collect()} == {
        ("a", "k"): (3, 2, 3, 4.5), ("a", "s"): (1, 1, 0, None), ("b", "k"): (1, 1, 0, None)}


# --- resampling


def test_weights_are_poisson_and_repeat_under_any_partitioning(spark):
    draws = spark.range(20_000).select(resampling.poisson_weight(F.col("id"), F.lit(3)).alias("w"))
    n = dict(draws.groupBy("w").count().collect())
    assert abs(n[0] / 20_000 - 0.3679) < 0.012 and abs(n[1] / 20_000 - 0.3679) < 0.012 and abs(n[2] / 20_000 - 0.1839) < 0.01
    users = spark.range(500).selectExpr("id AS user_id", "IF(id % 2 = 0, 'A', 'B') AS arm", "CAST(id % 7 AS decimal(12,2)) AS revenue")
    one, many = (sorted(map(tuple, resampling.bootstrap_means(users.repartition(p), 20).collect())) for p in (1, 13))
    assert one == many
    assert "partial_sum" in _plan(resampling.bootstrap_means(users, 20))


def test_bootstrap_error_is_near_the_formula(spark):
    rng = random.Random(3)
    rows = [(i, "AB"[i % 2], Decimal(int(rng.gauss(100, 20) * 100)) / 100) for i in range(2000)]
    out = {r.arm: r for r in resampling.bootstrap_summary(spark.createDataFrame(rows, "user_id long, arm string, revenue decimal(12,2)")).collect()}
    assert abs(out["A"].std_error - 20 / 1000 ** 0.5) < 0.15 and out["A"].low < out["A"].mean < out["A"].high
    assert abs(out["B - A"].std_error - 20 * (2 / 1000) ** 0.5) < 0.2
    one = spark.createDataFrame(rows[:1], "user_id long, arm string, revenue decimal(12,2)")
    assert [r.arm for r in resampling.bootstrap_summary(one).collect()] == ["A"]


def test_replicates_are_drawn_once(spark):
    users = spark.range(50).selectExpr("id AS user_id", "IF(id % 2 = 0, 'A', 'B') AS arm", "CAST(id AS decimal(12,2)) AS revenue")
    plan = resampling.bootstrap_means(users, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan.split("Generate")[0].split("Aggregate")[-1]  # no second hash for a filter
    assert "md5" not in _plan(resampling.bootstrap_summary(users, 5))


def test_revenue_per_user_starts_with_the_exposure(spark):
    arms = spark.createDataFrame([(1, 1, "A", ts("2024-01-02 00:00:00")), (2, 2, "B", None), (3, None, "A", ts("2024-01-02 00:00:00"))],
                                 "exp_id long, user_id long, group string, exposed_ts timestamp_ntz")
    orders = spark.createDataFrame([(1, 1, ts("2024-01-01 00:00:00"), D(5)), (2, 1, ts("2024-01-02 00:00:00"), D(7)),
                                    (3, 1, ts("2024-01-03 00:00:00"), D(1)), (4, 2, ts("2024-01-03 00:00:00"), D(9))], ORDERS)
    assert {tuple(r) for r in resampling.revenue_per_user(arms, orders).collect()} == {(1, "A", D(8)), (2, "B", D(0))}


# --- the stream


def test_stream_equals_batch_with_late_and_repeated_files(spark, tmp_path):
    rng = random.Random(9)

    def day(n, ids):
        return [(i, i % 5, datetime(2024, 1, n) + timedelta(minutes=rng.randrange(1440)), D(rng.randrange(100))) for i in ids]

    batches = [day(1, range(0, 30)) + day(2, range(30, 50)), day(3, range(50, 80)), day(4, range(80, 99)),
               day(8, range(99, 120)), day(20, range(120, 125))]
    late = [(200, 1, datetime(2024, 1, 2, 12), D(40)), (None, 1, None, D(1))]  # less than two days late
    batches[1] += late
    batches[2] += batches[1][:10]  # an order again, in a later file
    arriving, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    orders = lambda rows: spark.createDataFrame(rows, ORDERS)
    seen: list = []
    for rows in [*batches, batches[0][:5]]:  # the last file comes far too late, and again
        orders(rows).coalesce(1).write.mode("append").parquet(arriving)
        source = spark.readStream.schema(ORDERS).option("maxFilesPerTrigger", 1).parquet(arriving)
        stream.write_windows(source, out, state).awaitTermination()
        seen.append({tuple(r) for r in stream.read_windows(spark, out).collect()})
    for a, b in zip(seen, seen[1:], strict=False):
        assert a <= b  # what is written stays
    batch = stream.windowed_revenue(orders([r for b in batches for r in b]).dropDuplicates(["order_id", "order_ts"]))
    closed = {tuple(r) for r in batch.where("window_start < '2024-01-17'").collect()}
    assert seen[-1] == closed and len(closed) == 5
    # the same checkpoint again: nothing twice
    stream.write_windows(source, out, state).awaitTermination()
    assert stream.read_windows(spark, out).count() == 5
