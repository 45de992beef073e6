"""Named queries over the driver's test tables: one per report.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Results are
finished for engine-independent comparison: money (exact DECIMAL sums) is
cast to DOUBLE and rounded to cents, other doubles are rounded to 6 places.
``cartlytics.oracle`` holds the equivalent DuckDB SQL for each name.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .extended import BUILDERS
from .operators.cohorts import month_range
from .reports import REPORTS, Inputs
from .sources.roles import RoleTables

Query = Callable[[SparkSession, str], DataFrame]

#: The months that the test tables' orders lie in; an order outside fails the
#: matrix queries.
CALENDAR = month_range(date(1995, 1, 1), date(2001, 12, 1))

#: Queries that read the order-status events, where customers drop off.
ORDER_EVENTS = {"customer_funnel", "monthly_funnel", "monthly_funnel_rates", "order_funnel_steps"}
#: Queries that need of the customers only their own columns (no join to nations).
BASE_CUSTOMERS = {"check_primary_keys", "check_foreign_keys", "table_row_counts"}
#: Places that doubles are rounded to, where not 6.
DIGITS = {"recency_weight": 12, "ltv_summary": {"std": 4}}


def finish(df: DataFrame, digits: int | dict = 6) -> DataFrame:
    """Money (DECIMAL) → DOUBLE rounded to cents; other DOUBLEs rounded."""
    per_column = digits if isinstance(digits, dict) else {}
    places = 6 if isinstance(digits, dict) else digits
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.round(c.cast("double"), 2).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(c, per_column.get(f.name, places)).alias(f.name))
        else:
            cols.append(c)
    return df.select(cols)


def _query(name: str, report: str | None = None) -> Query:
    build = REPORTS[report or name][1]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        roles = RoleTables(spark, sf_dir)
        tables = roles.all()
        if name in ORDER_EVENTS:
            tables["events"] = roles.order_events()
        if name in BASE_CUSTOMERS:
            tables["customers"] = roles.base_customers()
        return finish(build(Inputs(tables, keep=False, months=CALENDAR)), DIGITS.get(name, 6))

    run.__name__ = f"q_{name}"
    return run


QUERIES: dict[str, Query] = {name: _query(name) for name in REPORTS}
QUERIES["order_funnel_steps"] = _query("order_funnel_steps", "funnel_steps")


def _extended(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(BUILDERS[name](RoleTables(spark, sf_dir)))

    run.__name__ = f"q_{name}"
    return run


QUERIES.update({name: _extended(name) for name in BUILDERS})
