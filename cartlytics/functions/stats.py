"""Normal-distribution helpers for the experiment statistics, as built-in
column expressions (Spark SQL has no ``erf``)."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two-sided 95% normal critical value as scipy's
# norm.isf(0.025) returns it (the statistics library the reference calls).
FIXED_CRITICAL_VALUES = {0.05: 1.959963984540054}


def normal_critical_value(alpha: float) -> float:
    """z with P(|Z| > z) = alpha (1.959963984540054 for alpha = 0.05)."""
    if not 0.0 < alpha < 1.0:
        raise ValueError("alpha must be in (0, 1)")
    if alpha in FIXED_CRITICAL_VALUES:
        return FIXED_CRITICAL_VALUES[alpha]
    return NormalDist().inv_cdf(1.0 - alpha / 2.0)


def two_sided_pvalue(z: Column) -> Column:
    """2·P(Z > |z|) = erfc(|z|/√2); NULL stays NULL.

    Up to |z| = 3 the alternating Taylor series of erf is summed by Horner's
    rule; beyond that the continued fraction of erfc, evaluated from its far
    end.  Both are accurate to about 1e-13.
    """
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    square = x * x
    # Horner's rule and the fraction as folds over a short array: one small expression each
    terms = F.array(*[F.lit((-1) ** n / (math.factorial(n) * (2 * n + 1))) for n in range(44, -1, -1)])
    series = F.aggregate(terms, F.lit(0.0), lambda done, term: term + square * done)
    near = F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * x * series
    halves = F.array(*[F.lit(n / 2.0) for n in range(60, 0, -1)])
    fraction = F.aggregate(halves, x, lambda done, half: x + half / done)
    far = F.exp(-square) / (F.lit(math.sqrt(math.pi)) * fraction)
    return F.when(F.abs(z) <= 3.0, near).otherwise(far)
