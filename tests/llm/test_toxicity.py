from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cartlytics.llm import toxicity

from .conftest import ODD_ROWS, documents, prose


def corpus(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = prose(rng, rng.randrange(20, 120))
        if toxic:
            at = text.split()
            for _ in range(rng.randrange(1, 4)):
                at.insert(rng.randrange(len(at)), rng.choice(["grumbo", "zzkrat", "vlem" + rng.choice("abcdefgh") + "x"]))
            text = " ".join(at)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_separates_held_out_documents(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels, F.col("doc_id") % 5 != 0)
    held = toxicity.score(docs, model).join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    assert len(held) == 120
    assert all((r["score"] >= 0.5) == bool(r["toxic"]) for r in held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_unseen_words_with_a_known_beginning_count(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    new = documents(spark, [(1, prose(random.Random(1), 40) + " vlemqqq"), (2, prose(random.Random(1), 40) + " qqqvlem")])
    score = {r["doc_id"]: r["score"] for r in toxicity.score(new, model).collect()}
    assert score[1] > 0.5 > score[2]


def test_words_unknown_to_both_classes_cancel(spark):
    docs, labels = corpus(spark, 200)
    model = toxicity.train(docs, labels)
    assert abs(model.spelled_ratios([b"\xff\xfe\xfd"])[0]) < 1e-9


def test_filter_keeps_rows_and_columns(spark):
    docs, labels = corpus(spark, 300)
    docs = docs.withColumn("score", F.lit("mine")).withColumn("toxic", F.lit(7)).withColumn("words", F.array("text"))
    model = toxicity.train(docs, labels)
    kept = toxicity.filter_toxic(docs, model)
    assert kept.schema == docs.schema
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {i for i in range(300) if i % 4}


def test_odd_rows_and_empty_tables(spark):
    docs, labels = corpus(spark, 120)
    model = toxicity.train(docs.unionByName(documents(spark, ODD_ROWS)),
                           labels.unionByName(spark.createDataFrame([(None, 1), (1, 0), (1, 1), (2, None), (4, 1)], labels.schema)))
    out = toxicity.score(documents(spark, ODD_ROWS), model).collect()
    assert len(out) == len(ODD_ROWS)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2, 3)}) == 1
    none = documents(spark, [])
    assert toxicity.score(none, model).count() == 0
    untrained = toxicity.train(none, labels.limit(0))
    assert all(r["score"] < 0.5 for r in toxicity.score(documents(spark, ODD_ROWS), untrained).collect())
    assert toxicity.filter_toxic(docs, untrained).count() == 120


def test_every_class_counts_up_to_its_own_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "build_models", lambda nodes, build=toxicity.build_models: seen.append(nodes.toPandas()) or build(nodes))
    rows = [(i, "grr" if i < 10 else "hello") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i < 10)) for i, _ in rows], "doc_id long, toxic int")
    toxicity.train(documents(spark, rows), labels)
    assert seen[0]["n_ordinary"].max() > 150 > 10 >= seen[0]["n_toxic"].max()
    toxicity.train(documents(spark, rows), labels, max_per_class=20)
    assert seen[1]["n_ordinary"].max() == 20


def told_apart(spark, toxic, ordinary, n=300):
    """Whether held-out texts around the two expressions get their labels."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        at = [f"w{rng.randrange(60)}" for _ in range(20)]
        at.insert(rng.randrange(20), (toxic if i % 2 else ordinary)(rng))
        rows.append((i, " ".join(at)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    out = toxicity.score(docs, toxicity.train(docs, labels, F.col("doc_id") % 5 != 0)).where("doc_id % 5 = 0").collect()
    return len(out) == n // 5 and all((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in out)


def test_words_are_read_to_their_end(spark):
    assert told_apart(spark, lambda rng: "abcdefghijklmTOXIC", lambda rng: "abcdefghijklmclean")
    assert told_apart(spark, lambda rng: "commonbeginning", lambda rng: "commonbe")


def test_scripts_without_spaces_are_read_whole(spark):
    def run(rng, middle):
        return "".join(rng.choice("天地玄黄宇宙洪荒") for _ in range(30)) + middle + "日月盈昃"

    assert toxicity.batch_words(["中文字 ไทย abc日".encode()]).lengths[0] == 8
    assert told_apart(spark, lambda rng: run(rng, "坏人"), lambda rng: run(rng, "人坏"))


def test_word_order_and_repeats_count(spark):
    assert told_apart(spark, lambda rng: "alpha beta", lambda rng: "beta alpha")
    assert toxicity.batch_words([b"one two one"]).lengths[0] == 3


def test_discounts_come_from_the_counts_of_counts():
    share = 100 / 160
    want = [1 - 2 * share * 0.3, 2 - 3 * share * 0.4, 3 - 4 * share * 0.5]
    assert np.allclose(toxicity.discounts([100, 30, 12, 6]), want)
    assert toxicity.discounts([100, 30, 0, 6]) == [0.5, 1.0, 1.5]


def test_few_sights_are_evidence(spark):
    rows = [(i, f"the usual text {'grr' if i < 6 else 'here'}") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 6)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels)
    assert model.spelled_ratios([b"grr"])[0] > 1


def brute_ratios(texts, times):
    """{(context, symbol): log ratios}, {context: log ratios of any other symbol}, by
    plain dictionaries: a spelled context is (bytes before in the word, at most 8), a
    word's is ("after", word)."""
    count: dict = {}
    for words, toxic in texts:
        for w in words:
            for i, c in enumerate([*w, 0x20]):
                count.setdefault((w[max(0, i - 8):i], c), [0, 0])[toxic] += 1
        for a, b in zip(["<", *words], [*words, ">"], strict=True):
            count.setdefault((("after", a), b), [0, 0])[toxic] += 1

    def tail(context, symbol):
        return symbol if isinstance(context, tuple) else (*(b"\0\0" + context)[-2:], symbol)

    kinds = {k: [x for x in count if isinstance(x[0], tuple) == k] for k in (False, True)}

    def shared(context, symbol):
        if isinstance(context, tuple):
            return sum(s == symbol for _, s in kinds[True]) / (len(kinds[True]) + 1)
        own, tails = tail(context, symbol), [tail(*x) for x in kinds[False]]
        alone = (sum(t[2] == symbol for t in tails) + 1) / (len(tails) + 256)
        return (sum(t == own for t in tails) + alone) / (sum(t[:2] == own[:2] for t in tails) + 1)

    def of(n, which):
        return n[which] if which < 2 else sum(n)

    off = {(k, which): toxicity.discounts([sum(of(count[x], which) == m for x in rows) for m in range(1, 5)])
           for k, rows in kinds.items() for which in (0, 1, 2)}

    def taken(x, which, t):
        n = of(count[x], which)
        return min(t * off[isinstance(x[0], tuple), which][min(n, 3) - 1], n) if n else 0.0

    def left(context, which, t):
        rows = [x for x in count if x[0] == context]
        total = sum(of(count[x], which) for x in rows)
        return min(1.0, max(1e-4, sum(taken(x, which, t) for x in rows) / total)) if total else 1.0, max(total, 1)

    seen, other = {}, {}
    for x in count:
        share, total = left(x[0], 2, 1.0)
        both = (sum(count[x]) - taken(x, 2, 1.0)) / total + share * shared(*x)
        logs = []
        for t in times:
            p = []
            for which in (1, 0):
                share, total = left(x[0], which, t)
                p.append((count[x][which] - taken(x, which, t)) / total + share * both)
            logs.append(np.log(p[0] / p[1]))
        seen[x] = logs
        other[x[0]] = [np.log(left(x[0], 1, t)[0] / left(x[0], 0, t)[0]) for t in times]
    return seen, other


def test_models_equal_brute_force_kneser_ney(spark):
    rng = random.Random(12)
    texts = [([rng.choice([b"ab", b"abc", b"b", b"cabbage", b"cabbagesalad", b"bad", b"x"]) for _ in range(rng.randrange(1, 9))], i % 3 == 0)
             for i in range(40)]
    df = spark.createDataFrame([(b" ".join(w), int(t)) for w, t in texts], "text binary, toxic int").repartition(3)
    nodes = df.mapInArrow(toxicity._count_words, "context long, tail long, pair boolean, n_toxic long, n_ordinary long")
    nodes = nodes.groupBy("context", "tail", "pair").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))
    models = toxicity.build_models(nodes, (1.0, 4.0))
    seen, other = brute_ratios(texts, (1.0, 4.0))
    assert len(models[0].keys) == len(seen) + len(other) - 1  # nothing is kept for the empty context alone

    def key(context, symbol=None):
        if isinstance(context, tuple):
            level = toxicity.PAIR
            names = {"<": toxicity._START, ">": toxicity._END}
            packed, symbol = (names[w] if w in names else toxicity.word_hashes([w])[0] if w is not None else None
                              for w in (context[1], symbol))
        else:
            level = len(context)
            packed = np.uint64(sum(c << 8 * k for k, c in enumerate(reversed(context))))
        found = toxicity.context_keys(np.array([level]), np.array([packed], np.uint64))
        return found if symbol is None else toxicity.node_keys(found, np.array([symbol], np.uint64))

    for rows, at in ((seen, lambda x: key(*x)), (other, key)):
        for x, logs in rows.items():
            if x == b"":
                continue
            for model, want in zip(models, logs, strict=True):
                got, known = model.find(at(x))
                assert known[0] and abs(got[0] - want) < 2e-3 * max(1, abs(want)), x


def test_the_driver_gets_keys_in_pieces_and_orders_them(spark, monkeypatch):
    texts = [("alpha beta alpha gamma delta", 1), ("beta gamma epsilon alpha", 0)] * 3
    nodes = spark.createDataFrame([(bytearray(t, "utf-8"), c) for t, c in texts], "text binary, toxic int").mapInArrow(
        toxicity._count_words, "context long, tail long, pair boolean, n_toxic long, n_ordinary long").groupBy(
        "context", "tail", "pair").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary")).persist()
    monkeypatch.setattr(toxicity.DataFrame, "toArrow", None)  # all at once to the driver
    got = []
    for held in (1, 1_000_000):
        monkeypatch.setattr(toxicity, "HELD_KEYS", held)
        got.append(toxicity.build_models(nodes, (1.0, 4.0)))
    keys = got[0][0].keys
    assert len(keys) > 20 and (keys[1:] > keys[:-1]).all()
    for few, many in zip(*got, strict=True):
        assert (few.keys == many.keys).all() and (few.ratios == many.ratios).all()


def test_calibration_on_few_equal_or_separable_rows():
    for n in (1, 2, 4, 5):
        equal = np.tile(np.array([0.5, 2.0, 0.0, 1.0, 1e3, -3.0]), (n, 1))
        for labels in (np.zeros(n), np.ones(n), np.arange(n) % 2.0):
            w = toxicity.calibrate(equal, labels)
            assert np.isfinite(w).all() and (w[1:] == 0).all()
            share = 1 / (1 + np.exp(-np.clip(w[0], -30, 30)))
            assert abs(share - labels.mean()) < 1e-3
        apart = np.arange(n)[:, None] * np.ones((1, 6))
        w = toxicity.calibrate(apart, (np.arange(n) >= 1).astype(float))
        assert np.isfinite(w).all() and (w[1:] >= 0).all()


def test_few_labels_give_a_defined_score(spark):
    docs = documents(spark, [(i, "same text") for i in range(12)])
    for n in (1, 2, 5, 12):
        labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
        scores = {r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_words_met_before_are_spelled_once(spark, monkeypatch):
    docs, labels = corpus(spark, 200)
    model = toxicity.train(docs, labels)
    words = [b"w1", b"grumbo", b"vlemax", b"new"]
    want = model.spelled_ratios(words)
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 2)
    for _ in range(3):
        assert np.allclose(model.known_ratios(words), want) and len(model.met) == 4


def test_the_model_build_leaves_no_files(spark, monkeypatch):
    """Neither shuffle files nor tables wait for the driver's garbage collection."""
    from pathlib import Path
    from time import sleep

    from cartlytics.llm.common import scratch_dir

    monkeypatch.setattr(toxicity, "free_shuffles", lambda spark: None)
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f: int(f.name.split("_")[1]) for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    def files():  # of later shuffles than the last one before
        return {f for f, k in shuffles().items() if k > last} | set(
            Path(scratch_dir(spark).removeprefix("file:")).rglob("llm-*/*/part-*"))

    spark.range(9).repartition(2).count()
    last = max(shuffles().values())
    before = files()
    models = toxicity.build_models(spark.createDataFrame(
        [(k % 50, k, k % 2 == 0, k % 3, 1) for k in range(400)],
        "context long, tail long, pair boolean, n_toxic int, n_ordinary int").repartition(5, "context"))
    assert len(models[0].keys) > 400
    assert (np.diff(models[0].keys.astype(float)) >= 0).all()
    for _ in range(50):  # removal is not waited for
        left = sum(f.stat().st_size for f in files() - before if f.exists())
        if left < 3000:  # the few rows of counts that are collected
            break
        sleep(0.2)
    assert left < 3000, [(f.name, f.stat().st_size) for f in sorted(files() - before)]
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "false"
