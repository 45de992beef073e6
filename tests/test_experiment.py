from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlytics.functions.stats import normal_critical_value, two_sided_pvalue
from cartlytics.operators import experiment as X


def _arm(spark, seg, grp, users, converters) -> DataFrame:
    return spark.range(users).select(
        F.lit(seg).alias("seg"), F.lit(grp).alias("group"),
        (F.col("id") < converters).alias("converted"))


def _experiments(spark):
    parts = [_arm(spark, "s1", "A", 248, 27), _arm(spark, "s1", "B", 252, 25),   # sample counts
             _arm(spark, "s2", "B", 40, 4),                                        # one arm empty
             _arm(spark, "s3", "A", 30, 0), _arm(spark, "s3", "B", 30, 0),         # zero conversions
             _arm(spark, "s4", "A", 10, 10), _arm(spark, "s4", "B", 12, 12)]       # all converted
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_ztest_and_pvalue_per_segment(spark):
    rows = {r["seg"]: (r["z_stat"], r["p_value"])
            for r in X.ab_pvalue(_experiments(spark), keys=["seg"]).collect()}
    z, p = rows["s1"]
    assert math.isclose(z, 0.3539607863, abs_tol=1e-9)
    assert math.isclose(p, 0.7233682712, abs_tol=1e-9)
    assert rows["s2"] == (None, None)          # arm A empty
    assert rows["s3"] == (None, None)          # zero variance
    assert rows["s4"] == (None, None)


def test_conversion_and_confidence(spark):
    exp = _experiments(spark).where(F.col("seg") == "s1")
    conv = X.ab_conversion(exp)
    got = {r["grp"]: (r["users"], r["converters"]) for r in conv.collect()}
    assert got == {"A": (248, 27), "B": (252, 25)}
    ci = {r["grp"]: (r["ci_low"], r["ci_upp"], r["err_low"], r["err_upp"], r["rate"])
          for r in X.ab_confidence(conv).collect()}
    lo, up, el, eu, rate = ci["A"]
    assert math.isclose(lo, 0.0701051822, abs_tol=1e-9) and math.isclose(up, 0.1476367533, abs_tol=1e-9)
    assert math.isclose(el, rate - lo) and math.isclose(eu, up - rate)
    lo, up, *_ = ci["B"]
    assert math.isclose(lo, 0.0622975248, abs_tol=1e-9) and math.isclose(up, 0.1361151736, abs_tol=1e-9)


def test_confidence_clipped(spark):
    exp = _experiments(spark).where(F.col("seg").isin("s3", "s4"))
    rows = X.ab_confidence(X.ab_conversion(exp, keys=["seg"])).collect()
    assert all(0.0 <= r["ci_low"] <= r["ci_upp"] <= 1.0 for r in rows)


def test_stats_helpers(spark):
    assert normal_critical_value(0.05) == 1.959963984540054
    assert math.isclose(normal_critical_value(0.1), 1.6448536269514722)
    zs = [0.0, 1.959963984540054, -0.3, 2.9999, 3.0001, -8.0, 30.0, 0.3539607863]
    df = spark.createDataFrame([(z,) for z in zs] + [(None,)], "z double").select("z", two_sided_pvalue(F.col("z")).alias("p"))
    got = {r["z"]: r["p"] for r in df.collect()}
    assert got.pop(None) is None
    for z, p in got.items():
        assert math.isclose(p, math.erfc(abs(z) / math.sqrt(2)), rel_tol=1e-9), z
