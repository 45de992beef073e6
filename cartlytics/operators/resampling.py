"""Poisson bootstrap of revenue per user in an experiment.

Every user gets a weight for every replicate, Poisson with mean 1, by the inverse
distribution of a hash of user and replicate.  Weights depend on nothing else, so
results repeat under any partitioning, order or number of executors.  Replicates
are laid out inside the tasks and added up there: what is shuffled is one row for
each arm, replicate and task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize

REPLICATES = 200
_BITS = 32


def poisson_thresholds(bits: int = _BITS) -> list[int]:
    """Bounds of the hash: the weight is the number of bounds that the hash
    reaches, P(weight <= k) * 2**bits rounded down, up to where they end."""
    total, term, out = 0.0, math.exp(-1), []
    for k in range(1, 13):
        total += term
        out.append(math.floor(total * 2 ** bits))
        term /= k
    return sorted({t for t in out if t < 2 ** bits})


def poisson_weight(user: Column, replicate: Column) -> Column:
    """How often a user is drawn in a replicate."""
    digest = F.substring(F.md5(F.concat_ws(":", user.cast("string"), replicate.cast("string"))), 1, _BITS // 4)
    # hex digits of equal length are ordered as their numbers
    return sum((F.when(digest >= f"{t:0{_BITS // 4}x}", 1).otherwise(0) for t in poisson_thresholds()), F.lit(0))


def revenue_per_user(experiments: DataFrame, orders: DataFrame) -> DataFrame:
    """(user_id, arm, revenue): header revenue from the exposure on, 0 without any.

    Orders are summed per user after a join on the user; a user's rows combine
    before the shuffle of the sum, and one row a user is what is resampled."""
    users = experiments.select("user_id", F.col("group").alias("arm"), "exposed_ts").where("user_id IS NOT NULL")
    spent = users.select("user_id", "exposed_ts").join(
        orders.select(F.col("customer_id").alias("user_id"), "order_ts", "revenue_usd"), "user_id")
    spent = spent.where(F.col("order_ts") >= F.col("exposed_ts")).groupBy("user_id").agg(F.sum("revenue_usd").alias("revenue"))
    zero = F.lit(0).cast(spent.schema["revenue"].dataType)
    return users.join(spent, "user_id", "left").select("user_id", "arm", F.coalesce("revenue", zero).alias("revenue"))


def bootstrap_means(users: DataFrame, replicates: int = REPLICATES) -> DataFrame:
    """(arm, replicate, mean): the weighted mean revenue of each replicate."""
    drawn = users.select("arm", "revenue", "user_id", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
    weight = poisson_weight(F.col("user_id"), F.col("replicate"))
    # equal weights are added up first: a row takes one hash and one addition
    alike = drawn.groupBy("arm", "replicate", weight.alias("w")).agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n"))
    sums = alike.groupBy("arm", "replicate").agg(
        F.sum(F.col("w") * F.col("revenue")).alias("total"), F.sum(F.col("w") * F.col("n")).alias("users")).where("users > 0")
    return sums.select("arm", "replicate", (F.col("total").cast("double") / F.col("users")).alias("mean"))


def bootstrap_summary(users: DataFrame, replicates: int = REPLICATES, level: float = 0.95) -> DataFrame:
    """(arm, users, mean, std_error, low, high) of each arm, and of the lift of
    the second arm over the first (arm ``B - A``), from ``replicates`` rows an arm."""
    means = materialize(bootstrap_means(users, replicates))  # both arms and the lift need them
    point = users.groupBy("arm").agg(F.count(F.lit(1)).alias("users"),
                                     (F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("mean"))

    def spread(rows: DataFrame) -> DataFrame:
        return rows.groupBy("arm").agg(
            F.stddev("mean").alias("std_error"), F.percentile("mean", F.lit((1 - level) / 2)).alias("low"),
            F.percentile("mean", F.lit((1 + level) / 2)).alias("high"))

    arms = point.join(spread(means), "arm", "left")

    def side(rows: DataFrame, arm: str) -> DataFrame:
        return rows.where(F.col("arm") == arm)

    pairs = side(means, "A").select("replicate", F.col("mean").alias("a")).join(
        side(means, "B").select("replicate", F.col("mean").alias("b")), "replicate")
    lifts = pairs.select(F.lit("B - A").alias("arm"), (F.col("b") - F.col("a")).alias("mean"))
    both = side(point, "A").select(F.col("users").alias("n"), F.col("mean").alias("a"), F.lit(0).alias("k")).join(
        side(point, "B").select(F.col("users").alias("m"), F.col("mean").alias("b"), F.lit(0).alias("k")), "k")
    lift = both.select(F.lit("B - A").alias("arm"), (F.col("n") + F.col("m")).alias("users"), (F.col("b") - F.col("a")).alias("mean"))
    return arms.unionByName(lift.join(spread(lifts), "arm", "left"))
