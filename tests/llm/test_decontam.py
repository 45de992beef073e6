from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cartlytics.llm import decontam

from .conftest import ODD_ROWS, documents, prose


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_force(docs, bench, similarity=0.8):
    """{(doc_id, item_id)}: some item-sized window reaches the weighted similarity."""
    def weighted(w, width):
        return {tuple(w[k:k + width]): sum(map(len, w[k:k + width])) for k in range(len(w) - width + 1)}

    out = set()
    for i, t in bench:
        item = (t or "").encode().lower().split()
        if not item:
            continue
        width = min(decontam.SHINGLE, len(item))
        own = weighted(item, width)
        for d, text in docs:
            w = (text or "").encode().lower().split()
            for a in range(max(1, len(w) - len(item) + 1)):
                window = weighted(w[a:a + len(item)], width)
                both = sum(n for s, n in window.items() if s in own)
                if both and both / (sum(window.values()) + sum(own.values()) - both) >= similarity:
                    out.add((d, i))
                    break
    return out


def found(spark, docs, bench, **how):
    return {(r["doc_id"], r["item_id"]) for r in decontam.matches(documents(spark, docs), items(spark, bench), **how).collect()}


def test_equals_brute_force_on_exact_and_edited_passages(spark):
    rng = random.Random(11)
    bench = [(i, prose(rng, rng.choice([1, 3, 4, 5, 6, 15, 40, 60]), 3000)) for i in range(40)]
    docs = []
    for d in range(150):
        w = prose(rng, rng.randrange(0, 200), 3000).split()
        for _ in range(rng.randrange(0, 3)):
            passage = rng.choice(bench)[1].upper().split()
            for _ in range(rng.randrange(0, 3)):
                k = rng.randrange(len(passage))
                passage[k:k + rng.randrange(0, 2)] = [f"x{rng.randrange(999)}"] * rng.randrange(0, 2)
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(w)))
    want = brute_force(docs, bench)
    assert len(want) > 60
    assert found(spark, docs, bench) == want


def test_fingerprints_within_the_radius_are_all_found():
    rng = np.random.default_rng(4)
    own = decontam.Items(6, [(i, [b"a%d" % rng.integers(10 ** 6) for _ in range(6)]) for i in range(20)])
    prints = []
    for i in range(20):
        for flips in range(decontam.RADIUS + 1):
            bits = rng.choice(64, flips, replace=False)
            prints.append(own.prints[i] ^ np.bitwise_xor.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0)))
    window, item, distance = own.near(np.array(prints, np.uint64))
    pairs = set(zip(window.tolist(), item.tolist(), strict=True))
    assert all((20 * 0 + k, k // (decontam.RADIUS + 1)) in pairs for k in range(len(prints)))
    assert distance.max() <= decontam.RADIUS


def test_chunks_of_the_benchmark_change_nothing(spark, monkeypatch):
    rng = random.Random(12)
    bench = [(i, prose(rng, 20, 3000)) for i in range(12)]
    docs = [(d, prose(rng, 10) + " " + bench[d % 12][1]) for d in range(24)]
    whole = found(spark, docs, bench)
    monkeypatch.setattr(decontam, "MAX_CHUNK_BYTES", 600)
    assert found(spark, docs, bench) == whole == {(d, d % 12) for d in range(24)}


def test_odd_rows_and_empty_tables(spark):
    bench = [(1, "one"), (1, "one"), (2, None), (None, "a null id"), (3, ""), (4, "long text " * 30), (5, "z" * 70_000)]
    got = found(spark, ODD_ROWS, bench)
    assert got == {(4, 1), (5, 1), (None, None), (8, 4), (7, 5)}
    docs = documents(spark, ODD_ROWS).withColumn("item_id", F.lit(1)).withColumn("distance", F.lit("d"))
    clean = decontam.filter_contaminated(docs, items(spark, bench).withColumn("doc_id", F.lit(9)))
    assert clean.schema == docs.schema
    assert sorted(r["doc_id"] for r in clean.collect() if r["doc_id"] is not None) == [-9, 1, 2, 3, 6]
    assert decontam.matches(documents(spark, []), items(spark, bench)).count() == 0
    assert decontam.matches(docs, items(spark, [])).count() == 0
    assert decontam.filter_contaminated(docs, items(spark, [(1, None)])).count() == len(ODD_ROWS)
