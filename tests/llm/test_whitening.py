from __future__ import annotations

import math
import random

import numpy as np
import pytest

from cartlytics.llm import whitening
from cartlytics.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=16):
    """{vec_id: (n, deviation, whitened or None)} and the shares, by numpy's solver and exact integers."""
    usable = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
              if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-9 * e.sum()).sum()))
    out = {}
    for i, x in usable:
        d = [n * c - s for c, s in zip(x, sums, strict=True)]
        z = np.array([c / n for c in d]) @ u[:, :k] / np.sqrt(e[:k])
        out.setdefault(i, []).append((n, sum(c * c for c in d), z))
    return out, e[:k] / e.sum()


def check(spark, rows, **how):
    got: dict = {}
    out = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), **how)
    for r in out.collect():
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    want, share = brute(rows)
    assert set(got) == set(want)
    sign = {}
    for i, many in want.items():
        assert sorted(got[i]) == list(range(1, len(share) + 1))
        for j, same in got[i].items():
            assert len(same) == len(many)
            for r in same:
                n, deviation, z = many[0]
                assert (r.n, r.deviation) == (n, deviation)
                assert abs(r.explained - share[j - 1]) < 1e-12 and r.identity_error < 1e-9
                if abs(z[j - 1]) > 0.1:
                    sign.setdefault(j, math.copysign(1, z[j - 1] * r.whitened))
                assert abs(r.whitened * sign.get(j, 1) - z[j - 1]) < 1e-6 or j not in sign
    return len(share)


@pytest.mark.parametrize("dimension,n", [(24, 300), (5, 60)])
def test_equals_numpy(spark, dimension, n):
    rng = np.random.default_rng(dimension)
    rows = [(i, [float(c) for c in v]) for i, v in
            enumerate(rng.standard_normal((n, dimension)) * np.linspace(0.2, 1, dimension) + 3)]
    rows += [(5000, rows[0][1]), (5001, rows[1][1]), (rows[2][0], rows[2][1])]  # equal vectors and a repeated row
    rows += [(6000, None), (6001, [None] * dimension), (6002, [float("nan")] * dimension), (6003, [float("inf")] * dimension)]
    assert check(spark, rows) == min(16, dimension)


def test_fewer_vectors_than_dimensions_and_constant_ones(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(7)] + [2.5]) for i in range(5)]
    assert check(spark, rows) == 4


def test_large_entries_stay_exact(spark):
    rng = random.Random(2)
    assert check(spark, [(i, [rng.gauss(0, 1e3), 1e7 + rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(9)]) == 3


def test_odd_inputs(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1), (None, None, None), (3, [], 1)], SCHEMA)
    assert whitening.whiten(one).count() == 0
    ragged = [(1, [1.0, 2.0], 0), (2, [0.0, 5.0], 1), (None, [4.0, 4.0], 1), (3, [1.0], 1)]
    df = spark.createDataFrame(ragged, SCHEMA).withColumnRenamed("label", "vector")
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "embedding", "vector", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    assert sorted((r.vec_id is None, r.vec_id, r.component) for r in out.collect() if r.vec_id) == [
        (False, 1, 1), (False, 1, 2), (False, 2, 1), (False, 2, 2)] and out.count() == 6
    huge = spark.createDataFrame([(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [1.0, 1.0], 0)], SCHEMA)
    assert {r.deviation for r in whitening.whiten(huge).collect()} >= {None}


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(2)
    for t in range(200):
        n = rng.integers(1, 12)
        a = rng.standard_normal((n, n))
        a = np.round(a + a.T) if t % 3 == 0 else a + a.T
        if t % 7 == 0:
            np.fill_diagonal(a, 0)  # no diagonal pivot to begin with
        s = rng.standard_normal()
        assert whitening.negative_pivots(a - s * np.eye(n)) == (np.linalg.eigvalsh(a) < s).sum()


@pytest.mark.parametrize("kind", ["spread", "equal", "four equal", "ten positive", "halving", "nearly equal"])
def test_spectrum(kind):
    rng = np.random.default_rng(9)
    e = np.sort(rng.random(40))[::-1] * 50
    if kind == "equal":
        e[:] = 3
    elif kind == "four equal":
        e[2:6] = e[2]
    elif kind == "ten positive":
        e[10:] = 0
    elif kind == "halving":
        e = 2.0 ** -np.arange(40)
    elif kind == "nearly equal":
        e[3] = e[4] * (1 + 1e-12)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    v = (q * e) @ q.T
    values, vectors = whitening.Spectrum((v + v.T) / 2).leading(16)
    assert len(values) == min(16, int((e > 0).sum()))
    assert np.abs(values - e[:len(values)]).max() < 1e-12 * e.sum()
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-12 * e.sum()


def test_query_on_the_smallest_table(spark):
    small = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want, share = brute(rows)
    got = QUERIES["op12_whitening"](spark, small).collect()
    assert len(got) == 16 * len(rows)
    assert all((r.n, r.deviation) == want[r.vec_id][0][:2] for r in got)
    assert max(abs(abs(r.whitened) - abs(want[r.vec_id][0][2][r.component - 1])) for r in got) < 1e-8
    assert max(abs(r.explained - share[r.component - 1]) for r in got) < 1e-12
