"""A/B test statistics as table operators.

Each works on many experiments or segments at once: ``keys`` name the
grouping columns (none = the whole table is one experiment).  Raw
participant rows are reduced by partial aggregation to one row per key and
arm; the statistics are Column arithmetic on those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..functions.stats import normal_critical_value, two_sided_pvalue

ARM_COLUMN = "group"


def ab_conversion(experiments: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Users, converters and conversion rate per arm (and key)."""
    return (experiments
            .groupBy(*keys, F.col(ARM_COLUMN).alias("grp"))
            .agg(F.count(F.lit(1)).alias("users"),
                 F.sum(F.when(F.col("converted"), 1).otherwise(0)).cast("bigint").alias("converters"))
            .withColumn("rate", ratio("converters", "users")))


def _arm_totals(experiments: DataFrame, a: str, b: str, keys: Sequence[str]) -> DataFrame:
    arm = F.col(ARM_COLUMN)
    conv = F.col("converted")
    return (experiments
            .where(arm.isin(a, b))
            .groupBy(*keys)
            .agg(F.count_if(arm == a).alias("n_a"),
                 F.count_if((arm == a) & conv).alias("c_a"),
                 F.count_if(arm == b).alias("n_b"),
                 F.count_if((arm == b) & conv).alias("c_b")))


def ab_ztest(experiments: DataFrame, a: str = "A", b: str = "B",
             keys: Sequence[str] = ()) -> DataFrame:
    """Two-sided two-proportion z statistic, arm ``a`` minus arm ``b``,
    pooled variance.  Zero variance or an empty arm gives NULL.
    """
    t = _arm_totals(experiments, a, b, keys)
    p_a = ratio("c_a", "n_a")
    p_b = ratio("c_b", "n_b")
    pooled = ratio(F.col("c_a") + F.col("c_b"), F.col("n_a") + F.col("n_b"))
    var = pooled * (F.lit(1.0) - pooled) * (ratio(F.lit(1.0), "n_a") + ratio(F.lit(1.0), "n_b"))
    z = F.try_divide(p_a - p_b, F.sqrt(var))
    return t.select(*keys, z.alias("z_stat"))


def ab_pvalue(experiments: DataFrame, a: str = "A", b: str = "B",
              keys: Sequence[str] = ()) -> DataFrame:
    """z statistic with its two-sided normal p-value."""
    z = ab_ztest(experiments, a, b, keys)
    return z.withColumn("p_value", two_sided_pvalue(F.col("z_stat")))


def ab_confidence(conversion: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Normal-approximation interval of each arm's rate, clipped to [0, 1],
    and the distances from the rate to both ends (error-bar lengths)."""
    z = normal_critical_value(alpha)
    rate = F.col("rate")
    half = F.lit(z) * F.sqrt(rate * (F.lit(1.0) - rate) / F.col("users").cast("double"))
    low = F.greatest(F.lit(0.0), rate - half)
    upp = F.least(F.lit(1.0), rate + half)
    keys = [c for c in conversion.columns if c not in ("grp", "users", "converters", "rate")]
    return conversion.select(*keys, "grp", "rate", low.alias("ci_low"), upp.alias("ci_upp"),
                             (rate - low).alias("err_low"), (upp - rate).alias("err_upp"))
