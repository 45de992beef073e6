"""Revenue by category, country and month, and every total of them, in one pass.

Distinct customers cannot be added up from cell to total, so the cube does not
work on counts: customers are packed as bits, 64 ids to a word.  Line items are
read once and reduced to one row per cell and word; grouping sets expand those
rows, words of equal number are merged by OR, and only then are bits counted.
Every set multiplies a task's rows, so they are dealt to a number of tasks that
follows the line items.
Sums, ORs and counts all combine before the shuffle, so neither a hot cell nor
the grand total is one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import line_revenue, month_of

DIMENSIONS = ("category", "country", "month")
BITS = 64
TASK_ROWS = 500_000     # line items that make a task


def tasks_for(order_items: DataFrame) -> int:
    """Tasks of ``TASK_ROWS`` line items; the count is read from file footers."""
    return max(1, math.ceil(order_items.count() / TASK_ROWS))


def cell_rows(order_items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame,
              tasks: int) -> DataFrame:
    """(category, country, month, order_id's customer, revenue, lines) per order
    and category: inner joins on intact keys, line items read once."""
    lines = order_items.join(products.select("product_id", "category"), "product_id")
    # dealt by order once: for the sums of its categories and for the join below
    lines = lines.repartition(tasks, "order_id").groupBy("order_id", "category").agg(F.sum(line_revenue()).alias("revenue"),
                                                      F.count(F.lit(1)).alias("lines"))
    placed = lines.join(orders.select("order_id", "customer_id", month_of("order_ts").alias("month")), "order_id")
    return placed.join(customers.select("customer_id", "country"), "customer_id")


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dimensions), -1, -1) for s in combinations(dimensions, n)]


def distinct_cube(rows: DataFrame, dimensions: Sequence[str], distinct: str, sums: Sequence[str],
                  sets: Sequence[Sequence[str]], count_as: str, having: Column | None = None,
                  tasks: int | None = None) -> DataFrame:
    """(dimensions, sums, ``count_as``, level): one row for each group of each of ``sets``.

    ``distinct`` is a whole-number id; NULL ids are not counted.  ``level`` has
    the bit of every dimension that is totalled, the first dimension's highest,
    and so tells a total from the group of a NULL value.  ``having`` filters
    groups by the output's columns.  The rows of a word are dealt to one of
    ``tasks`` (if given), which bounds what the sets of one task hold.
    """
    word = F.shiftright(F.col(distinct), 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(distinct), F.lit(BITS)).cast("int"))
    dealt = rows.select(*dimensions, *sums, word.alias("_word"), bit.alias("_bit"))
    if tasks is not None:
        dealt = dealt.repartition(tasks, "_word")
    cells = dealt.groupBy(*dimensions, "_word").agg(
        *[F.sum(s).alias(s) for s in sums], F.bit_or("_bit").alias("_bits"))
    grouped = cells.groupingSets([[F.col(d) for d in [*s, "_word"]] for s in sets], *dimensions, "_word").agg(
        F.grouping_id().alias("_id"), *[F.sum(s).alias(s) for s in sums], F.bit_or("_bits").alias("_bits"))
    # the word stands last in every set, so its bit of the id is 0
    out = grouped.groupBy(*dimensions, F.shiftright("_id", 1).alias("level")).agg(
        *[F.sum(s).alias(s) for s in sums], F.coalesce(F.sum(F.bit_count("_bits").cast("long")), F.lit(0)).alias(count_as))
    out = out.select(*dimensions, *sums, count_as, F.col("level").cast("int").alias("level"))
    return out if having is None else out.where(having)


def revenue_cube(order_items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame,
                 sets: Sequence[Sequence[str]] | None = None, having: Column | None = None) -> DataFrame:
    """(category, country, month, revenue, lines, customers, level) for all
    combinations of the three, or the given grouping sets."""
    tasks = tasks_for(order_items)
    rows = cell_rows(order_items, orders, products, customers, tasks)
    return distinct_cube(rows, DIMENSIONS, "customer_id", ("revenue", "lines"), sets or cube_sets(DIMENSIONS),
                         "customers", having, tasks)
