"""Revenue KPIs: daily, by category, top products, lifetime value and its
distribution, and order revenue roll-up.

Scale notes.  Line items are the largest table.  Every operator first sums
line revenue per join key (``order_id`` or ``product_id``): Spark's partial
aggregation combines a hot key inside each map task before the shuffle, and
the join that follows sees one row per key.  Sums stay exact DECIMALs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.columns import day_of, line_revenue
from ..plans.materialize import materialize


def _sum_line_revenue(order_items: DataFrame, key: str) -> DataFrame:
    """key, line_revenue (Σ qty × unit price, exact), item_lines.

    The DECIMAL product is summed whatever the types and session settings are:
    its precision grows with the operands, so no valid line can overflow.
    """
    return (order_items.groupBy(key)
            .agg(F.sum(line_revenue()).alias("line_revenue"),
                 F.count(F.lit(1)).alias("item_lines")))


def revenue_per_order(order_items: DataFrame) -> DataFrame:
    """order_id, line_revenue (Σ qty × unit price), item_lines."""
    return _sum_line_revenue(order_items, "order_id")


def revenue_per_product(order_items: DataFrame) -> DataFrame:
    return _sum_line_revenue(order_items, "product_id")


def sorted_if(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    """The reference's ORDER BY; composing callers pass ``ordered=False`` so
    no global sort runs under a later join, window or aggregate."""
    return df.orderBy(*keys) if ordered else df


def daily_revenue(orders: DataFrame, order_items: DataFrame, ordered: bool = True) -> DataFrame:
    """orders ⋈ items (inner), Σ qty × unit price per order date."""
    per_order = revenue_per_order(order_items).select("order_id", "line_revenue")
    dated = orders.select("order_id", day_of("order_ts").alias("order_date"))
    out = (dated.join(per_order, "order_id")
           .groupBy("order_date")
           .agg(F.sum("line_revenue").alias("daily_revenue_usd")))
    return sorted_if(out, ordered, F.asc_nulls_last("order_date"))


def category_performance(order_items: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """Σ revenue and distinct products sold per category.

    The product dimension carries no broadcast hint: Spark's size estimate
    broadcasts a small catalogue, and a large one is sort-merge joined to the
    per-product sums (already hash-partitioned on product_id).
    """
    per_product = revenue_per_product(order_items).select("product_id", "line_revenue")
    dim = products.select("product_id", "category")
    out = (per_product.join(dim, "product_id")
           .groupBy("category")
           .agg(F.sum("line_revenue").alias("revenue_usd"),
                F.countDistinct("product_id").alias("products_sold")))
    return sorted_if(out, ordered, F.desc_nulls_last("revenue_usd"), F.asc_nulls_last("category"))


def top_products(order_items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` (product_name, category) by revenue, with item-line counts.

    Grouped by name and category as the reference does (equal names merge);
    ties are broken by name, then category, so the cut is deterministic.
    """
    per_product = revenue_per_product(order_items)
    dim = products.select("product_id", "product_name", "category")
    grouped = (per_product.join(dim, "product_id")
               .groupBy("product_name", "category")
               .agg(F.sum("line_revenue").alias("revenue_usd"),
                    F.sum("item_lines").alias("item_lines")))
    return (grouped
            .orderBy(F.desc_nulls_last("revenue_usd"), F.asc_nulls_last("product_name"),
                     F.asc_nulls_last("category"))
            .limit(n))


def customer_ltv(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                 ordered: bool = True) -> DataFrame:
    """customers ⋈ orders ⋈ items: distinct orders and Σ revenue per customer.

    Items are summed per order, orders per customer (partial aggregation
    absorbs a hot customer), and only then joined to the customer dimension.
    The result is grouped by its three descriptive columns, so a customer that
    the dimension lists twice gives one row with doubled revenue, as a join
    before the aggregation would.
    """
    per_order = revenue_per_order(order_items).select("order_id", "line_revenue")
    per_customer = (orders.select("order_id", "customer_id")
                    .join(per_order, "order_id")
                    .groupBy("customer_id")
                    .agg(F.countDistinct("order_id").alias("orders"),
                         F.sum("line_revenue").alias("revenue_usd")))
    out = (customers.select("customer_id", "country", "channel")
           .join(per_customer, "customer_id")
           .groupBy("customer_id", "country", "channel")
           .agg(F.max("orders").alias("orders"), F.sum("revenue_usd").alias("revenue_usd")))
    return by_revenue(out) if ordered else out


def by_revenue(ltv: DataFrame) -> DataFrame:
    return ltv.orderBy(F.desc_nulls_last("revenue_usd"), F.asc_nulls_last("customer_id"))


def _pname(p: float) -> str:
    return f"p{round(p * 100):d}"


def _mean(exact: bool) -> F.Column:
    """Σ as exact DECIMAL where the values are, divided once as DOUBLE."""
    total = F.sum("x").cast("double") if exact else F.sum("v")
    return F.try_divide(total, F.count("v").cast("double"))


def narrowed(vals: DataFrame, span: tuple[float, float], bracket: tuple[float, float], need: tuple[int, int],
             counts: tuple[int, int], n: int, accuracy: int) -> tuple[tuple[float, float], int]:
    """A bracket of the values ``v`` that holds the positions ``need`` (1-based),
    and how many rows lie below it.

    ``bracket`` missed them: ``counts`` rows lie below it and up to its end.
    Each pass takes the side where they lie, asks for approximate quantiles of
    that side's rows alone and counts again; a side has fewer distinct values
    than the one before, so this ends, at worst with the side itself.
    """
    lo, hi = span
    before, last = 0, n  # rows below lo, and up to hi
    while True:
        (a, b), (below, upto) = bracket, counts
        if below < need[0] and need[1] <= upto:
            return bracket, vals.where(F.col("v") < bracket[0]).count()
        side = (lo, hi)
        if need[1] <= below:  # all below the bracket
            lo, hi, last = lo, a, below
            rows = vals.where((F.col("v") >= lo) & (F.col("v") < hi))
        elif need[0] > upto:  # all above
            lo, hi, before = b, hi, upto
            rows = vals.where((F.col("v") > lo) & (F.col("v") <= hi))
        elif need[0] <= below:  # one on either side of the bracket's start
            bracket, counts = (lo, b), (before, upto)
            continue
        else:  # one on either side of its end
            bracket, counts = (a, hi), (below, last)
            continue
        size = max(1, last - before)
        slack = 2.0 / accuracy
        shares = [min(1.0, max(0.0, (at - before) / size + off)) for at, off in zip(need, (-slack, slack), strict=True)]
        q = rows.agg(F.percentile_approx("v", shares, accuracy).alias("q")).first()["q"]
        bracket = (q[0], q[1])
        if (lo, hi) == side and bracket == (a, b):  # nothing narrower: the side itself
            return (lo, hi), vals.where(F.col("v") < lo).count()
        found = vals.agg(F.count_if(F.col("v") < q[0]).alias("below"), F.count_if(F.col("v") <= q[1]).alias("upto")).first()
        counts = (found["below"], found["upto"])


def distribution_summary(df: DataFrame, value: str, probs: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95),
                         approximate: bool = False, accuracy: int = 10_000) -> DataFrame:
    """count, mean, std (sample), min, linear-interpolated percentiles, max.

    The percentiles are exact without sorting all values.  One aggregate gives
    the moments and, per percentile, a bracket of two approximate quantiles; a
    second counts the rows below and in each bracket (and takes the deviation
    around the median, so that large values do not cancel); only the distinct
    values inside the brackets are then counted and ordered.  Should a bracket
    miss its position, a new one is sought on the side where it lies.  With ``approximate=True`` the percentiles come from
    ``percentile_approx`` alone.
    """
    exact = isinstance(df.schema[value].dataType, T.DecimalType)
    vals = materialize(df.select(F.col(value).alias("x"), F.col(value).cast("double").alias("v"))
                       .where(F.col("x").isNotNull()))
    spark, slack = df.sparkSession, 2.0 / accuracy
    lows, highs = [max(0.0, p - slack) for p in probs], [min(1.0, p + slack) for p in probs]
    wanted = [*lows, *highs, *probs, 0.5]
    first = vals.agg(F.count("v").alias("count"), _mean(exact).alias("mean"), F.min("v").alias("min"),
                     F.max("v").alias("max"), F.percentile_approx("v", wanted, accuracy).alias("q"),
                     F.percentile_approx("x", 0.5, accuracy).alias("middle")).first()
    n, k, q = first["count"], len(probs), first["q"] or [None] * len(wanted)
    schema = ", ".join(["count long", "mean double", "std double", "min double",
                        *[f"{_pname(p)} double" for p in probs], "max double"])
    if n == 0:
        return spark.createDataFrame([(0, *[None] * (4 + k))], schema)
    brackets = [(first["min"] if lows[i] <= 0 else q[i], first["max"] if highs[i] >= 1 else q[k + i]) for i in range(k)]
    deviation = (F.col("x") - F.lit(first["middle"])).cast("double")
    second = vals.agg(F.stddev_samp(deviation).alias("std"),
                      *[F.count_if(F.col("v") < lo).alias(f"below_{i}") for i, (lo, _) in enumerate(brackets)],
                      *[F.count_if(F.col("v") <= hi).alias(f"upto_{i}") for i, (_, hi) in enumerate(brackets)]).first()

    def result(found):
        return spark.createDataFrame(
            [(n, first["mean"], second["std"], first["min"], *found, first["max"])], schema)

    if approximate:
        return result(q[2 * k:3 * k])
    place = [(n - 1) * p for p in probs]
    need = [(int(h) + 1, min(int(h) + 2, n)) for h in place]
    below = []
    for i in range(k):
        below.append(second[f"below_{i}"])
        if not (below[i] < need[i][0] and need[i][1] <= second[f"upto_{i}"]):
            brackets[i], below[i] = narrowed(vals, (first["min"], first["max"]), brackets[i], need[i],
                                             (below[i], second[f"upto_{i}"]), n, accuracy)
    inside = F.array_compact(F.array(*[
        F.when(F.col("v").between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(brackets)]))
    counted = (vals.where(F.size(inside) > 0).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
               .select("v", "c", F.explode(inside).alias("i")))
    before = F.sum("c").over(Window.partitionBy("i").orderBy("v"))
    upto = before + F.element_at(F.array(*[F.lit(b).cast("long") for b in below]), F.col("i") + 1)
    ranked = counted.select("v", "i", upto.alias("upto"), (upto - F.col("c")).alias("before"))
    picks = ranked.agg(*[
        F.max(F.when((F.col("i") == i) & (F.col("before") < at) & (at <= F.col("upto")), F.col("v"))).alias(f"{side}_{i}")
        for i, pair in enumerate(need) for side, at in zip(("lo", "hi"), pair, strict=True)]).first()
    return result([picks[f"lo_{i}"] + (picks[f"hi_{i}"] - picks[f"lo_{i}"]) * (place[i] - int(place[i])) for i in range(k)])


def ltv_summary(ltv: DataFrame, probs: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95),
                approximate: bool = False) -> DataFrame:
    return distribution_summary(ltv, "revenue_usd", probs, approximate)


def equal_width_histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram from min to max; the last bin is closed.

    The values are materialised once; min and max (one partial aggregate,
    two numbers) become literals of the bucketing plan.  When min equals max
    the range is widened by 0.5 on each side, as numpy does.  Every bin
    appears, empty ones with 0.
    """
    v = F.col(value).cast("double")
    vals = materialize(df.select(v.alias("v")).where(F.col("v").isNotNull()))
    lo_v, hi_v = vals.agg(F.min("v"), F.max("v")).first()
    if lo_v is None:
        return df.sparkSession.createDataFrame(
            [], "bucket int, bin_low double, bin_high double, customers bigint")
    if lo_v == hi_v:
        lo_v, hi_v = lo_v - 0.5, hi_v + 0.5
    lo, hi = F.lit(lo_v), F.lit(hi_v)
    bucket = F.least(F.floor((F.col("v") - lo) * F.lit(float(bins)) / (hi - lo)) + 1, F.lit(bins)).cast("int")
    counts = vals.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("customers"))
    edges = (df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bucket"))
             .select("bucket",
                     (lo + (F.col("bucket") - 1) * (hi - lo) / F.lit(float(bins))).alias("bin_low"),
                     (lo + F.col("bucket") * (hi - lo) / F.lit(float(bins))).alias("bin_high")))
    return (edges
            .join(F.broadcast(counts), "bucket", "left")
            .select("bucket", "bin_low", "bin_high",
                    F.coalesce(F.col("customers"), F.lit(0)).alias("customers"))
            .orderBy("bucket"))


def ltv_histogram(ltv: DataFrame, bins: int = 30) -> DataFrame:
    return equal_width_histogram(ltv, "revenue_usd", bins)


def order_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every order with Σ qty × unit price of its items (NULL if it has none)."""
    per_order = revenue_per_order(order_items).select("order_id", F.col("line_revenue").alias("revenue_usd"))
    return (orders.select("order_id", "customer_id")
            .join(per_order, "order_id", "left")
            .select("order_id", "customer_id", "revenue_usd"))
