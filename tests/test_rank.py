"""Distributed global rank equals the plain single-partition window."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlytics.plans.global_rank import TARGET_ROWS, add_row_number, range_count


def _cases():
    rng = random.Random(7)
    uniform = [(i, rng.randint(0, 1000)) for i in range(400)]
    hot = [(i, 5 if i % 3 == 0 else rng.randint(0, 50)) for i in range(600)]
    nulls = [(i, None if i % 3 else rng.randint(0, 20)) for i in range(300)]
    same = [(i, 1) for i in range(200)]
    return {"uniform": uniform, "hot_third": hot, "null_third": nulls, "all_equal": same,
            "single": [(1, 3)]}


@pytest.mark.parametrize("name", list(_cases()))
@pytest.mark.parametrize("desc", [True, False])
def test_matches_plain_window(spark, name, desc):
    rows = _cases()[name]
    df = spark.createDataFrame(rows, "id long, v long")
    out, n = add_row_number(df, "v", descending=desc, tiebreak=["id"], rn_col="rn",
                            rank_col="rnk", buckets=6)
    assert n == len(rows)
    vo = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
    w = Window.orderBy(vo, F.col("id"))
    expected = df.select("id", F.row_number().over(w).alias("rn"),
                         F.rank().over(Window.orderBy(vo)).alias("rnk"))
    got = {r["id"]: (r["rn"], r["rnk"]) for r in out.collect()}
    exp = {r["id"]: (r["rn"], r["rnk"]) for r in expected.collect()}
    assert got == exp
    assert sorted(v[0] for v in got.values()) == list(range(1, len(rows) + 1))


def test_decimal_and_empty(spark):
    df = spark.createDataFrame([(i, Decimal(i % 4)) for i in range(50)], "id long, v decimal(10,2)")
    out, _ = add_row_number(df, "v", descending=True, tiebreak=["id"], rank_col="rnk", buckets=4)
    ranks = sorted({(r["v"], r["rnk"]) for r in out.collect()}, reverse=True)
    # values 3 and 2 occur 12 times each, 1 and 0 thirteen times
    assert [r for _, r in ranks] == [1, 13, 25, 38]
    empty = spark.createDataFrame([], "id long, v long")
    out, n = add_row_number(empty, "v", tiebreak=["id"], buckets=4)
    assert n == 0 and out.count() == 0


def test_hot_group_is_split_across_buckets(spark):
    rows = [(i, 1 if i < 300 else i) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v long")
    out, _ = add_row_number(df, "v", tiebreak=["id"], rn_col="rn", buckets=8)
    hot = out.where("v = 1").select("rn").collect()
    assert sorted(r[0] for r in hot) == list(range(1, 301))


def test_ranges_grow_with_the_rows():
    assert [range_count(n) for n in (0, 1, TARGET_ROWS, TARGET_ROWS + 1, 5000 * TARGET_ROWS)] == [1, 1, 1, 2, 5000]


def test_text_tiebreak_splits_a_hot_value(spark, tmp_path):
    rows = [(f"id{i:04d}", 1 if i < 600 else i) for i in range(900)]
    df = spark.createDataFrame(rows, "id string, v long").repartition(5)
    out, _ = add_row_number(df, "v", tiebreak=["id"], rn_col="rn", rank_col="rnk", buckets=9)
    got = {r["id"]: (r["rn"], r["rnk"]) for r in out.collect()}
    assert got == {f"id{i:04d}": (i + 1, 1 if i < 600 else i + 1) for i in range(900)}
    placed = [len(p) for p in df.repartitionByRange(9, "v", "id").rdd.glom().collect()]
    assert max(placed) < 300  # no range holds the hot value alone


def test_text_values_rank_too(spark):
    df = spark.createDataFrame([(i, f"v{i % 7}") for i in range(100)], "id long, v string")
    out, _ = add_row_number(df, "v", descending=True, tiebreak=["id"], rank_col="rnk", buckets=4)
    w = Window.orderBy(F.desc("v"))
    want = {r["id"]: r["k"] for r in df.select("id", F.rank().over(w).alias("k")).collect()}
    assert {r["id"]: r["rnk"] for r in out.collect()} == want
