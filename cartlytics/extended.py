"""Registered queries beyond the reports: joins in time, ordered funnels,
sketches, cubes, trailing totals, sessions, streams, stored reports and checks.

Each takes ``(spark, sf_dir)``, reads the whole test tables through the roles and
is finished as ``registry.finish`` does; ``extended_sql`` has the DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import month_of
from .operators import cohorts, cubes, ordered_funnel, props, reconcile, resampling, revenue, sessions, sketches, temporal, trailing
from .plans.materialize import materialize, new_path
from .session import many_tasks
from .sources import report_table, tables
from .sources.roles import RoleTables, read_table
from .streaming import revenue as revenue_stream

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
#: From here on orders are changes to the stored report, and this source's orders are cancelled later.
CHANGES_FROM, CANCELLED = datetime(2001, 1, 1), "4-NOT SPECIFIED"


def purchase_last_visit(t: RoleTables) -> DataFrame:
    """Every purchase with the customer's last visit in the 12 hours before it."""
    events = t.events()
    visits = events.where("event_type = 'visit'").select(
        "customer_id", F.col("event_id").alias("visit_id"), F.col("event_ts").alias("visit_ts"))
    bought = events.where("event_type = 'purchase'").select("event_id", "customer_id", "event_ts")
    return temporal.asof_join(bought, visits, ["customer_id"], "event_ts", "visit_ts", 12 * HOUR,
                              ["visit_id", "visit_ts"], tiebreak=["visit_id"])


def order_last_finished(t: RoleTables) -> DataFrame:
    """Every order with the customer's last finished order of the 90 days up to
    and with its day; orders have whole days, so many tie."""
    finished = t.order_events().where("event_type = 'visit'").select(
        "customer_id", F.col("event_id").alias("finished_id"), F.col("event_ts").alias("finished_ts"))
    orders = t.orders().select("order_id", "customer_id", "order_ts")
    return temporal.asof_join(orders, finished, ["customer_id"], "order_ts", "finished_ts", 90 * DAY,
                              ["finished_id", "finished_ts"], tiebreak=["finished_id"], splits=3)


def purchase_touches(t: RoleTables) -> DataFrame:
    """For every purchase with any, the customer's clicks and errors from 6 hours before to 1 hour after."""
    events = t.events()
    near = events.select("customer_id", F.col("event_ts").alias("touch_ts"), F.col("event_type").alias("touch"))
    near = near.where("touch IN ('click', 'error')")
    bought = events.where("event_type = 'purchase'").select("event_id", "customer_id", "event_ts")
    pairs = temporal.interval_join(bought, near, ["customer_id"], "event_ts", "touch_ts", 6 * HOUR, HOUR, ["touch"])
    return pairs.groupBy("event_id").agg(F.count(F.when(F.col("touch") == "click", 1)).alias("clicks"),
                                         F.count(F.when(F.col("touch") == "error", 1)).alias("errors"))


def ordered_funnel_levels(t: RoleTables) -> DataFrame:
    return ordered_funnel.ordered_funnel(t.events(), within=12 * HOUR, chunk=DAY)


def ordered_order_funnel(t: RoleTables) -> DataFrame:
    """Steps from the order's status, in order within 180 days; times tie."""
    levels = ordered_funnel.ordered_funnel(t.order_events(), within=180 * DAY, chunk=365 * DAY)
    return ordered_funnel.ordered_funnel_steps(levels)


def sketch_months(t: RoleTables) -> DataFrame:
    """Exact customers of each month, and whether the merged daily sketches keep their bounds."""
    stored = materialize(sketches.daily_sketches(t.orders()))
    merged = sketches.merged_sketches(stored, [month_of("day").alias("period")])
    return sketches.sketch_check(t.orders(), merged, month_of("order_ts")).withColumnRenamed("period", "month")


def sketch_range(t: RoleTables) -> DataFrame:
    """The same for the years 1997 and 1998 as one range, from the same kind of stored rows."""
    stored = materialize(sketches.daily_sketches(t.orders()))
    span = F.lit("1997-1998")
    merged = sketches.merged_sketches(stored, [span.alias("period")], date(1997, 1, 1), date(1998, 12, 31))
    orders = t.orders().where(F.year("order_ts").between(1997, 1998))
    return sketches.sketch_check(orders, merged, span)


def revenue_cube(t: RoleTables) -> DataFrame:
    return cubes.revenue_cube(t.order_items(), t.orders(), t.products(), t.customers())


def revenue_rollup(t: RoleTables) -> DataFrame:
    """The chain of totals country, month; groups of 10 customers and more."""
    tasks = cubes.tasks_for(t.order_items())
    rows = cubes.cell_rows(t.order_items(), t.orders(), t.products(), t.customers(), tasks)
    dimensions = ("country", "month")
    return cubes.distinct_cube(rows, dimensions, "customer_id", ("revenue",), cubes.rollup_sets(dimensions),
                               "customers", F.col("customers") >= 10, tasks)


def trailing_revenue(t: RoleTables) -> DataFrame:
    """Header revenue of each order time and of the 7 days up to it, over all orders."""
    return trailing.trailing_range(t.orders(), "order_ts", "revenue_usd", 7 * DAY)


def trailing_event_count(t: RoleTables) -> DataFrame:
    """Events of each customer in the 24 hours up to each event time."""
    one = t.events().select("customer_id", "event_ts", F.lit(1).alias("n"))
    return trailing.trailing_range(one, "event_ts", "n", DAY, ["customer_id"])


def customer_trailing_orders(t: RoleTables) -> DataFrame:
    """Each order with its customer's orders, and largest one, of the 90 days up to it."""
    return trailing.trailing_window(
        t.orders().select("order_id", "customer_id", "order_ts", "revenue_usd"), "order_ts", 90 * DAY, ["customer_id"],
        lambda w: [F.count(F.lit(1)).over(w).alias("orders_90d"), F.sum("revenue_usd").over(w).alias("revenue_90d"),
                   F.max("revenue_usd").over(w).alias("largest_90d")])


def customer_sessions(t: RoleTables) -> DataFrame:
    return sessions.sessions(t.events(), gap=6 * HOUR)


def time_to_next_purchase(t: RoleTables) -> DataFrame:
    return sessions.time_to_next(t.events(), F.col("event_type") == "purchase").select(
        "event_id", "customer_id", "next_ts", "seconds_to_next")


def streamed_daily_revenue(t: RoleTables) -> DataFrame:
    """Daily revenue from a file stream of orders, closed windows only."""
    schema = read_table(t.spark, t.sf_dir, "orders").schema
    # a pattern, since a stream's plain path must be a folder and the table may be one file
    stream = t.spark.readStream.schema(schema).parquet(f"{t.sf_dir.rstrip('/')}/orders.parque[t]")
    orders = stream.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_ts"),
                           F.col("o_totalprice").cast("decimal(12,2)").alias("revenue_usd"))
    path = new_path(t.spark)
    revenue_stream.write_windows(orders, f"{path}/windows", f"{path}/checkpoint").awaitTermination()
    return revenue_stream.read_windows(t.spark, f"{path}/windows").select(
        F.to_date("window_start").alias("day"), "orders", "revenue")


def merged_daily_revenue(t: RoleTables) -> DataFrame:
    """Daily revenue stored from the earlier orders, then brought up to date by
    two batches: later orders, and the cancellation of one source's (sent twice)."""
    orders = t.orders()
    path = f"{new_path(t.spark)}/daily"
    later = F.coalesce(F.col("order_ts") >= F.lit(CHANGES_FROM), F.lit(False))
    report_table.create(path, orders.where(~later))
    report_table.apply_changes(t.spark, path, report_table.differences(None, orders.where(later)), batch=1)
    for _ in range(2):
        report_table.apply_changes(t.spark, path, report_table.differences(orders.where(F.col("source") == CANCELLED), None), batch=2)
    return report_table.read(t.spark, path)


def reconciliation(t: RoleTables) -> DataFrame:
    return reconcile.reconciliation_summary(reconcile.reconciled_orders(t.orders(), t.order_items()))


def customers_difference(t: RoleTables) -> DataFrame:
    """Customers without orders, and how often customers ordered beyond once."""
    return reconcile.table_difference(t.base_customers(), t.orders().select("customer_id"))


def event_props(t: RoleTables) -> DataFrame:
    """Events with the columns found in their JSON properties."""
    events = read_table(t.spark, t.sf_dir, "events").select("event_id", "event_type", "props")
    return props.shredded(events, "props", props.json_schema(events, "props"), prefix="p_")


def event_props_keys(t: RoleTables) -> DataFrame:
    return props.key_statistics(read_table(t.spark, t.sf_dir, "events"), "props", ["event_type"])


def ab_bootstrap(t: RoleTables) -> DataFrame:
    users = materialize(resampling.revenue_per_user(t.marketing_experiments(), t.orders()))
    return resampling.bootstrap_summary(users, replicates=100)


def retention_matrix(t: RoleTables) -> DataFrame:
    return cohorts.retention_matrix(cohorts.purchase_cohorts(t.orders(), ordered=False))


def sql_category_months(t: RoleTables) -> DataFrame:
    """SQL over the role tables as views, with ordinals; its tasks follow the line items."""
    own = RoleTables(many_tasks(t.spark, cubes.tasks_for(t.order_items())), t.sf_dir)
    tables.register_tables({name: getattr(own, name)() for name in ("orders", "order_items", "products")})
    return own.spark.sql("""
SELECT p.category, CAST(date_trunc('YEAR', o.order_ts) AS DATE) AS year, SUM(i.qty * i.unit_price_usd) AS revenue_usd,
       COUNT(DISTINCT i.order_id) AS orders
FROM order_items i JOIN orders o ON o.order_id = i.order_id JOIN products p ON p.product_id = i.product_id
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""")


def table_list(t: RoleTables) -> DataFrame:
    return tables.list_tables(t.all())


def preview_daily_revenue(t: RoleTables) -> DataFrame:
    """The first rows of a report, as of a table."""
    return tables.table_preview(revenue.daily_revenue(t.orders(), t.order_items()), "order_date", 10)


BUILDERS: dict[str, Callable[[RoleTables], DataFrame]] = {f.__name__: f for f in (
    purchase_last_visit, order_last_finished, purchase_touches, ordered_funnel_levels, ordered_order_funnel,
    sketch_months, sketch_range, revenue_cube, revenue_rollup, trailing_revenue, trailing_event_count,
    customer_trailing_orders, customer_sessions, time_to_next_purchase, streamed_daily_revenue, merged_daily_revenue,
    reconciliation, customers_difference, event_props, event_props_keys, ab_bootstrap,
    retention_matrix, sql_category_months, table_list, preview_daily_revenue)}
