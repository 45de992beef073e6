from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartlytics.llm import common, linededup, packing, toxicity
from cartlytics.llm.common import save

from .conftest import ODD_ROWS, documents, prose
from .test_decontam import brute_force as leaks
from .test_linededup import brute_force as line_runs
from .test_neardup import brute_force as near

RARE = ["grumbo", "zzkrat", "flonk"]


def build(spark, folder, rows, labels, bench):
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    passage = "\n".join(prose(rng, 22, 5000) for _ in range(3))
    bench = [(i, prose(rng, 30, 5000)) for i in range(5)]
    rows, labels = [], []
    for i in range(160):
        lines = [prose(rng, rng.randrange(5, 15), 5000) for _ in range(rng.randrange(2, 8))]
        if i % 20 == 3:
            lines.insert(1, passage)
        if i % 23 == 4:
            lines.append(f"{prose(rng, 4)} {bench[i % 5][1]} {prose(rng, 4)}")
        toxic = i % 4 == 0
        if toxic:
            lines[0] += " " + " ".join(rng.choice(RARE) for _ in range(2))
        text = "\n".join(lines)
        rows.append((i, text))
        if i % 9 == 5:  # a near copy under another id
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + i, " ".join(words).replace("\n", " ")))
            labels.append((1000 + i, 1, int(toxic)))
        labels.append((i, 1, int(toxic)))
    return build(spark, tmp_path_factory.mktemp("corpus"), rows, labels, bench), bench


def test_every_stage_equals_brute_force_on_its_own_input(spark, corpus):
    folder, bench = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = save(stage(spark, docs, folder), name)
        seen[name] = before
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = sorted(before.items())
        if name == "toxicity":
            assert after == {i: t for i, t in rows if not any(w in t for w in RARE)}
        elif name == "line_dedup":
            assert after == line_runs(rows, linededup.MIN_WORDS) != before
        elif name == "near_duplicates":
            assert after == {i: t for i, t in rows if near(rows, 5)[i][1] == i}
            assert len(after) < len(before)
        else:
            dirty = {d for d, _ in leaks(rows, bench)}
            assert dirty and after == {i: t for i, t in rows if i not in dirty}
    pieces = docs.toPandas()
    assert set(pieces["doc_id"]) == set(before)
    assert (pieces.groupby("doc_id")["length"].sum() == pieces.groupby("doc_id")["doc_tokens"].first()).all()
    assert pieces.groupby("sequence_id")["length"].sum().max() <= packing.WINDOW
    again = corpus_pipeline.run(spark, folder).toPandas()
    assert sorted(again["ids_crc32"]) == sorted(pieces["ids_crc32"])


def test_odd_rows_without_labels_or_items(spark, tmp_path):
    folder = build(spark, tmp_path, ODD_ROWS, [(None, None, None), (4, 1, None)], [(None, None)])
    out = corpus_pipeline.run(spark, folder).toPandas()
    assert set(out["doc_id"].dropna()) == {-9, 1, 2, 3, 4, 6, 7, 8}


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, build(spark, tmp_path, [], [], [])).count() == 0


def test_stages_keep_clashing_columns(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(30)
    for name in ("score", "rep", "kept", "registers", "line", "length", "label", "toxic"):
        docs = docs.withColumn(name, F.lit(name))
    docs = save(docs, "wide")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert out.where("rep <> 'rep' or line <> 'line'").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 30
    assert toxicity.score(docs, toxicity.Model()).count() == 30


def test_a_saved_table_frees_a_full_driver(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(common, "free_shuffles", freed.append)
    for share, times in ((0.4, 0), (0.6, 1)):
        monkeypatch.setattr(common, "heap_share", lambda _, share=share: share, raising=False)
        assert common.save(spark.range(3), "numbers").count() == 3 and len(freed) == times
    monkeypatch.undo()
    assert 0 < common.heap_share(spark) <= 1
