from __future__ import annotations

import collections
import math
import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from cartlytics.llm import common, lm, mixing

from .conftest import ODD_ROWS, documents, prose


def brute_force(rows, held):
    seen = collections.Counter()
    for i, t in rows:
        if i is not None and not held(i):
            seen.update((t or "").encode().lower().split() + [b"\n"])
    total, distinct = sum(seen.values()), len(seen)
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split() + [b"\n"]
        out.append((i, i is not None and held(i), len(w), sum(x in seen for x in w), total,
                    round(sum(math.log10((seen[x] + 1) / (total + distinct + 1)) for x in w), 6)))
    return sorted(out, key=str)


def scored(spark, docs, held):
    return lm.score(docs, held).collect()


def test_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_DOCS", 7)
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(0, 80), 300)) for i in range(60)] + [(100, "again " * 700), (100, "again " * 700)]
    rows += ODD_ROWS
    got = scored(spark, documents(spark, rows), F.col("doc_id") % 3 == 0)
    assert sorted([(*r[:5], round(r[5], 6)) for r in got], key=str) == brute_force(rows, lambda i: i % 3 == 0)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_scores_beat_the_base_on_held_out_text(spark):
    rng = random.Random(2)
    tongues = [["ka", "lo", "mi", "ter", "on", "sha"], ["ré", "lé", "oui", "mé", "nu", "dé"]]

    def text(i):
        return " ".join("".join(rng.choice(tongues[i % 2]) for _ in range(rng.randrange(1, 4))) for _ in range(60))

    rows = [(i, text(i)) for i in range(200)]
    got = [r for r in scored(spark, documents(spark, rows), F.col("doc_id") % 4 == 0) if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    gibberish = [(i, t) for i, t in rows] + [(400, "qzxv wvvq xxqz " * 20)]
    bits = {r["doc_id"]: r["bits_per_byte"] for r in scored(spark, documents(spark, gibberish), F.col("doc_id") % 4 == 0)}
    assert bits[400] > 1.5 * max(v for k, v in bits.items() if k != 400)


def test_the_next_byte_is_a_distribution():
    table = np.zeros((2, mixing.ORDERS * mixing.SLOTS), np.int64)
    some = [b"lorem", b"ipsum", b"dolor", b"loren", b"ipse"] * 3
    mixing.count(mixing.spell(some), table)
    mixer = mixing.train_online(mixing.start(table), table, mixing.spell(some))
    # tokens of one byte, and the bytes that open longer ones: 256 continuations
    x = bytes(range(256))
    data = b"".join(bytes([0x6C, b]) for b in x)
    at, contexts = mixing.byte_contexts(b"l" + b"o")
    total = 0.0
    for b in x:
        slots, bits, nodes = mixing.slots(np.array([b], np.uint8), contexts[1:2])
        gates = np.arange(8) * 6 + mixer.seen[slots[:, :, 4]]
        p = mixer._refined(mixer._mix(mixer.votes[slots], gates), nodes)
        total += float(np.prod(np.where(bits == 1, p, 1 - p)))
    assert len(data) == 512 and abs(total - 1) < 1e-9


def test_parts_and_chunks_do_not_change_scores(spark, monkeypatch):
    rng = random.Random(5)
    docs = documents(spark, [(i, prose(rng, 30, 100)) for i in range(40)])
    whole = {r["doc_id"]: r for r in scored(spark, docs, F.col("doc_id") % 5 == 0)}
    monkeypatch.setattr(lm, "CHUNK_DOCS", 3)
    cut = {r["doc_id"]: r for r in scored(spark, docs.repartition(7), F.col("doc_id") % 5 == 0)}
    for i, r in whole.items():
        assert math.isclose(r["base_score"], cut[i]["base_score"], rel_tol=1e-12)
        assert math.isclose(r["score"], cut[i]["score"], rel_tol=1e-2)


def test_empty_and_untrained(spark):
    docs = documents(spark, []).withColumn("score", F.lit(1)).withColumn("chunk", F.lit("c"))
    assert scored(spark, docs, F.col("doc_id") == 1) == []
    rows = [(1, "never seen"), (2, None)]
    got = {r["doc_id"]: r for r in scored(spark, documents(spark, rows), F.col("doc_id") > 0)}
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["base_score"] == 0
    assert got[2]["n_tokens"] == 1 and got[1]["score"] < got[2]["score"] < 0


def test_the_online_pass_meets_every_token(monkeypatch):
    met = []
    monkeypatch.setattr(mixing, "train_online", lambda mixer, table, data: met.append(data) or mixer)
    monkeypatch.setattr(lm, "SLICE", 1000)
    tokens = [b"t%d" % i for i in range(12_345)]
    lm._trained(None, None, tokens)
    assert b"".join(met).split() == tokens and max(len(m.split()) for m in met) == 1000


def test_session_partitions_do_not_change_scores(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_BYTES", 2000)
    rng = random.Random(6)
    docs = documents(spark, [(i, prose(rng, 30, 200)) for i in range(60)])
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("2", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append({r["doc_id"]: r["score"] for r in scored(spark, docs, F.col("doc_id") % 5 == 0)})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(math.isclose(got[0][i], got[1][i], rel_tol=1e-9) for i in got[0])


def test_bits_are_counted_as_often_as_tokens_occur():
    whole, weighed = (np.zeros((2, mixing.ORDERS * mixing.SLOTS), np.int64) for _ in range(2))
    mixing.count(mixing.spell([b"lorem", b"ipsum", b"lorem", b"lorem"]), whole)
    mixing.count(mixing.spell([b"lorem", b"ipsum"]), weighed, np.array([3, 1]))
    assert (whole == weighed).all() and whole.sum() == (3 * 6 + 6) * 8 * mixing.ORDERS


def test_the_order_of_words_changes_scores(spark):
    rng = random.Random(7)
    chain = [b"w%d" % i for i in range(40)]

    def text(shuffled):
        at = rng.randrange(40)
        said = [chain[(at + k) % 40].decode() for k in range(30)]
        if shuffled:
            rng.shuffle(said)
        return " ".join(said)

    rows = [(i, text(False)) for i in range(200)]
    probe = text(False).split()
    rows += [(1000, " ".join(probe)), (1001, " ".join(rng.sample(probe, len(probe))))]
    got = {r["doc_id"]: r for r in scored(spark, documents(spark, rows), F.col("doc_id") >= 1000)}
    assert abs(got[1000]["base_score"] - got[1001]["base_score"]) < 1e-9
    assert got[1000]["score"] > got[1001]["score"] + 5
    # at least two bits a word under what the shares alone give
    assert got[1000]["score"] > got[1000]["base_score"] + 30 * 2 * math.log10(2)


def test_contexts_are_hashed_without_copies_of_all():
    data = mixing.spell([b"w%d" % i for i in range(40_000)])
    words = np.arange(len(data), dtype=np.uint32)
    for most, run in ((2.2, lambda: mixing.byte_contexts(data)[1]),
                      (3.2, lambda: mixing.word_contexts(words, np.array([len(words)]), np.zeros(1, np.int64)))):
        tracemalloc.start()
        made = run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * made.nbytes


def test_chunks_pass_their_part_as_rows_of_their_own(spark, monkeypatch):
    saved = []
    monkeypatch.setattr(lm, "save", lambda df, *a, **b: saved.append(common.save(df, *a, **b)) or saved[-1])
    monkeypatch.setattr(lm, "CHUNK_DOCS", 10)
    rng = random.Random(8)
    lm.score(documents(spark, [(i, prose(rng, 20)) for i in range(60)]).coalesce(1), F.col("doc_id") % 5 == 0)
    rows = saved[0].collect()
    assert sum(r["tokens"] is not None for r in rows) == 1
    assert [len(r["info"]["doc_id"]) for r in rows if r["tokens"] is None] == [10] * 6


def test_codes_are_a_distribution():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 4, (2, 256, lm.GATES)).astype(np.int64)
    counts[1] = np.minimum(counts[0], 1)
    by_gate = np.stack([counts[0].sum(axis=0), counts[1].sum(axis=0), np.full(lm.GATES, 5)])
    model = lm.Model(None, int((counts[0].sum(axis=1) > 0).sum()), 3, by_gate, counts)
    assert np.allclose((10 ** model.code_price).sum(axis=0), 1)


def test_mixing_holds_one_order_at_a_time():
    rng = np.random.default_rng(5)
    data = mixing.spell([b"w%d" % k for k in rng.integers(0, 5000, 3 * mixing.SLICE // 6)])
    table = np.zeros((2, mixing.ORDERS * mixing.SLOTS), np.int64)
    mixing.count(data, table)
    mixer = mixing.start(table)
    x, contexts = mixing.byte_contexts(data)
    table = table.astype(np.int32)
    most = {}
    for name, run in (("price", lambda: mixer.log10_bytes(x, contexts)), ("train", lambda: mixing.train_bytes(mixer, table, x, contexts))):
        tracemalloc.start()
        run()
        most[name] = tracemalloc.get_traced_memory()[1] / (mixing.SLICE * 64)  # in numbers of eight bytes a bit
        tracemalloc.stop()
    assert most["price"] < 20 and most["train"] < 42, most


def test_parts_are_rows_of_bounded_pieces(spark, monkeypatch):
    saved, got = [], []
    monkeypatch.setattr(lm, "save", lambda df, *a, **b: saved.append(common.save(df, *a, **b)) or saved[-1])
    monkeypatch.setattr(lm, "CHUNK_DOCS", 10)
    rng = random.Random(9)
    docs = documents(spark, [(i, prose(rng, 60, 400)) for i in range(60)] + ODD_ROWS).coalesce(1)
    for size in (4 << 20, 1000):
        monkeypatch.setattr(lm, "PIECE_BYTES", size, raising=False)
        monkeypatch.setattr(lm, "HELD_BYTES", size, raising=False)
        got.append(sorted(scored(spark, docs, F.col("doc_id") % 5 == 0), key=lambda r: (str(r["doc_id"]), r["score"])))
    whole, cut = ([r for r in rows.collect() if r["tokens"] is not None] for rows in saved)
    assert len(whole) == 1 and len(cut) > 10 and sum(r["met"] is not None for r in cut) == 1
    assert b" ".join(r["tokens"] for r in cut) == whole[0]["tokens"]
    longest = max(len(t) for t in whole[0]["tokens"].split(b" "))
    for r in cut:
        assert len(r["tokens"]) + len(r["counts"]) + sum(len(x["docs"]) + len(x["times"]) + len(x["index"]) for x in r["refs"]) < 3000 + longest
    for a, b in zip(*got, strict=True):
        assert a[:5] == b[:5] and math.isclose(a["base_score"], b["base_score"], rel_tol=1e-12) and math.isclose(a["score"], b["score"], rel_tol=1e-9)
