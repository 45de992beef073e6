from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cartlytics.llm import quality

from .conftest import ODD_ROWS, documents, prose


def corpus(spark, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        kind = i % 6
        text = prose(rng, rng.randrange(20, 150)) + "."
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            text = " ".join([rng.choice(text.split())] * 60)
        rows.append((i, text))
        labels.append((i, int(kind > 1)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_separates_held_out_documents(spark):
    docs, labels = corpus(spark)
    model = quality.train(docs, labels, F.col("doc_id") % 7 != 0)
    held = quality.score(docs, model).join(labels, "doc_id").where("doc_id % 7 = 0").collect()
    assert all((r["score"] >= 0.7) == bool(r["quality"]) for r in held)


def test_compiled_rules_equal_the_fitted_ones(spark):
    docs, labels = corpus(spark, 300)
    model = quality.train(docs, labels)
    assert model.rules
    rows = quality.score(docs, model).toPandas()
    columns = {c: rows[c].to_numpy(float) for c in quality.STATISTICS}
    z = model.intercept + sum(w * rule.holds(columns) for rule, w in model.rules)
    assert np.allclose(rows["score"], 1 / (1 + np.exp(-np.clip(z, -30, 30))))


def test_lasso_drops_rules():
    rng = np.random.default_rng(1)
    x = rng.random((800, len(quality.STATISTICS)))
    y = (x[:, 2] > 0.6).astype(float)
    few, many = quality.fit(x, y, l1=0.02), quality.fit(x, y, l1=1e-5)
    assert 0 < len(few.rules) < len(many.rules)


def test_statistics_by_hand(spark):
    docs = documents(spark, [(1, "AB cd cd 12|\nx$!.")])
    r = quality.statistics(docs.select("doc_id", "text")).first()
    assert r["n_words"] == 5 and r["distinct_words"] == 4 / 5 and r["line_words"] == 2.5
    assert np.isclose(r["upper"], 2 / 17) and np.isclose(r["digits"], 2 / 17)
    assert r["bars"] == r["exclaims"] == r["stops"] == 1 / 5
    assert np.isclose(r["symbols"], 2 / 17)


def test_odd_rows_and_empty_tables(spark):
    docs, labels = corpus(spark, 120)
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (1, None), (4, 0), (4, 1)], labels.schema))
    model = quality.train(docs.unionByName(documents(spark, ODD_ROWS)), labels)
    odd = documents(spark, ODD_ROWS).withColumn("score", F.lit("x")).withColumn("upper", F.lit(None))
    out = quality.score(odd, model).collect()
    assert len(out) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2)}) == 1
    none = documents(spark, [])
    untrained = quality.train(none, labels.limit(0))
    assert [r["score"] for r in quality.score(odd, untrained).collect()] == [0.5] * len(ODD_ROWS)
    assert quality.score(none, model).count() == 0
