from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlytics.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, is_query, k=10, scale=1024):
    usable = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if is_query(i)}):
        own = min(v for i, v in usable if i == q)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in usable if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def result(spark, rows, is_query, **how):
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    out = topk.top_k(df, is_query, **how)
    return sorted(map(tuple, out.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("seed,levels", [(1, None), (2, 3)])
def test_equals_brute_force_over_several_blocks(spark, seed, levels):
    rng = random.Random(seed)  # few levels give many ties
    value = (lambda: rng.gauss(0, 1)) if levels is None else (lambda: rng.randrange(-levels, levels) / 4)
    rows = [(i, [value() for _ in range(8)]) for i in range(500)]
    got = result(spark, rows, F.col("vec_id") % 25 == 0, k=7, query_block=6, candidate_block=90)
    assert got == brute_force(rows, lambda i: i % 25 == 0, k=7)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (None, [9.0, 9.0]), (6, []), (7, [3.0]), (8, [-1.0, -1.0, 5.0]), (100, [0.0, 0.0]), (100, [0.0, 0.0]), (200, None)]
    assert result(spark, rows, F.col("vec_id") % 100 == 0) == brute_force(rows, lambda i: i % 100 == 0)
    assert result(spark, [], F.col("vec_id") % 100 == 0) == []
    assert result(spark, [(0, [1.0])], F.col("vec_id") % 100 == 0) == []


def test_huge_components_stay_exact_and_saturate(spark):
    rows = [(0, [1e6, 3.0]), (1, [1e6, 1.0]), (2, [1e6, 2.0]), (3, [3e30, 0.0])]
    got = result(spark, rows, F.col("vec_id") == 0)
    assert got[0] == (0, 1, 3, (1 << 63) - 1)
    want = brute_force(rows, lambda i: i == 0)
    assert [r[2] for r in got] == [r[2] for r in want] and got[1:] == want[1:]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [float(i)], 1, 2, 3) for i in range(5)],
                               "vec_id long, embedding array<float>, score int, qb int, vector int")
    assert topk.top_k(df, F.col("vec_id") == 0, k=2).count() == 2


def test_search_stops_before_reading_everything():
    rng = np.random.default_rng(0)
    values = np.floor(rng.pareto(1.2, (4000, 3)) * 50)
    read = []

    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                read.append(len(key))
            return super().__getitem__(key)

    found = topk.threshold_search(np.arange(4000), values.view(Seen), np.array([-1]), np.array([[1.0, 1.0, 1.0]]), 5)
    want = sorted(range(4000), key=lambda i: (-values[i].sum(), i))[:5]
    assert found[0][0].tolist() == want
    assert sum(read) < 4000
