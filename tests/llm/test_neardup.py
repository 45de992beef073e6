from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cartlytics.llm import neardup
from cartlytics.llm.components import connected_components

from .conftest import ODD_ROWS, documents, prose


def brute_force(rows, size=2, percent=80):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        k = min(size, len(w))
        sets.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b:
                for x in sets[a]:
                    for y in sets[b]:
                        if x and y and 100 * len(x & y) >= percent * len(x | y):
                            p, q = find(a), find(b)
                            root[max(p, q)] = min(p, q)
    return {i: ({len(x) for x in sets[i]}, find(i)) for i in ids}


def check(spark, rows, **how):
    want = brute_force([r for r in rows if r[0] is not None], how.get("shingle_words", 2), how.get("percent", 80))
    got = neardup.groups(documents(spark, rows), **{"shingle_words": 2, **how}).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
            continue
        sizes, component = want[r["doc_id"]]
        assert r["n_shingles"] in sizes
        assert r["component_id"] == component, r
        assert r["kept"] == (r["doc_id"] == component)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_chains_and_borders_equal_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for family in range(25):
        text = prose(rng, rng.choice([2, 3, 5, 8, 20, 60, 150]))
        for _ in range(rng.randrange(1, 7)):
            rows.append((len(rows), text))
            if rng.random() < 0.7:  # drifts away step by step
                text = edited(rng, text, rng.randrange(0, 1 + len(text.split()) // 12))
    rng.shuffle(rows)
    check(spark, rows)
    check(spark, rows, shingle_words=5)


def test_a_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 4)
    rng = random.Random(7)
    base = prose(rng, 100, 5000)
    rows = [(i, edited(rng, base, rng.randrange(0, 14))) for i in range(120)]
    rows += [(200 + i, edited(rng, rows[5][1], rng.randrange(0, 9))) for i in range(40)]
    check(spark, rows)


def test_odd_rows_and_empty_tables(spark):
    rows = ODD_ROWS + [(30, "ONE"), (31, "one\x0btwo"), (32, "One Two"), (33, "one two")]
    check(spark, rows)
    assert neardup.groups(documents(spark, [])).count() == 0
    docs = documents(spark, rows).withColumn("component_id", F.lit("x")).withColumn("rep", F.lit(1))
    kept = neardup.filter_duplicates(docs, 2)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(ids) == {None, 1, 2, 3, 4, 6, 7, 8, -9, 31}
    assert ids.count(None) == 2


def test_estimate_is_close_to_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.8, 0.95):
        errors = []
        for _ in range(30):
            union = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
            both = int(300 * share)
            a, b = np.concatenate([union[:both], union[both::2]]), np.concatenate([union[:both], union[both + 1::2]])
            r = neardup.sketch([np.unique(a), np.unique(b)])
            errors.append(float(neardup.estimate(r[0], r[1])) - share)
        assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < neardup.MARGIN


def test_bands_find_nearly_all_pairs_at_the_border():
    rng = np.random.default_rng(2)
    missed = 0
    for n in (5, 10, 50, 200):
        for _ in range(50):
            union = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            keys = neardup.band_keys(neardup.sketch([np.sort(union), np.sort(union[: -(n // 5)])]))
            missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 40)] + [(39, 3), (5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 3 for i in range(7, 40)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_round_of_components_frees_what_it_held(spark, monkeypatch):
    from cartlytics.llm import components

    freed = []
    monkeypatch.setattr(components, "free_shuffles", freed.append, raising=False)
    chain = spark.createDataFrame([(k, k + 1) for k in range(12)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.connected_components(chain).collect()}
    assert found == dict.fromkeys(range(1, 13), 0) and len(freed) >= 2
