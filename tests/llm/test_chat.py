from __future__ import annotations

import random

from pyspark.sql import functions as F

from cartlytics.llm import chat

EVENTS = "conv_id long, seq long, kind string, target long, role string, text string"


def formatted(spark, events):
    df = chat.render(chat.reconstruct(spark.createDataFrame(events, EVENTS)))
    return df.select("conv_id", "formatted", "turns", chat.read_back(F.col("formatted")).alias("parsed"),
                     chat.loss_text(F.col("turns")).alias("loss")).collect()


def test_folds_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", "a"), (1, 3, "delta", 2, "assistant", "b"),
        (1, 4, "regenerate", 2, "assistant", None), (1, 5, "delta", 2, "assistant", "x"), (1, 6, "delta", 2, "assistant", "y"),
        (1, 7, "edit", 1, "user", "hello"), (1, 8, "delta", 1, "user", "!"), (1, 9, "delta", 3, "tool", "late"),
    ]
    random.Random(1).shuffle(events)
    row = formatted(spark, events)[0]
    assert row["formatted"] == "### User: hello!</turn>\n### Assistant: xy</turn>\n### \\rtool: late</turn>\n"
    assert [tuple(t) for t in row["parsed"]] == [("user", "hello!"), ("assistant", "xy"), ("tool", "late")]
    assert row["loss"] == "xy"


def test_any_text_and_role_reads_back(spark):
    rng = random.Random(8)
    bits = ["\\", "#", "##", "###", "### Assistant: ", "</turn>", "</turn>\n", "<", "\\b", "\\l", "\\h", "\\c", "\\r", ":", "\n",
            "é", "\U0001f600", " ", "ok", "\x00"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
    roles = ["user", "assistant", "system", "User", "", "\\rtool", "a:b", "###", "</turn>", None]
    events = [(c, t, "message", t, rng.choice(roles), text()) for c in range(60) for t in range(rng.randrange(1, 8))]
    want = {}
    for c, _, _, _, role, said in events:
        want.setdefault(c, []).append((role or "", said))
    for row in formatted(spark, events):
        assert [tuple(t) for t in row["parsed"]] == want[row["conv_id"]]
        assert row["loss"] == "".join(s for r, s in want[row["conv_id"]] if r == "assistant")
        for t in row["turns"]:
            assert row["formatted"][t["start"]:t["start"] + len(t["chunk"])] == t["chunk"]
            body = row["formatted"][t["from"]:t["to"]]
            assert "</turn>" not in body and "###" not in body


def test_odd_rows_and_empty_log(spark):
    events = [(None, None, "message", None, None, None), (1, 1, "message", 1, "user", "x" * 100_000),
              (1, 1, "message", 2, "user", "tie"), (1, 1, "message", 2, "user", "tie"), (2, 5, "message", 1, "assistant", "")]
    rows = {r["conv_id"]: r for r in formatted(spark, events)}
    assert [tuple(t) for t in rows[None]["parsed"]] == [("", "")]
    assert [t["text"] for t in rows[1]["parsed"]] == ["x" * 100_000, "tie"]
    assert rows[2]["loss"] == "" and len(rows[2]["parsed"]) == 1
    assert formatted(spark, []) == []
    extra = spark.createDataFrame([(1, 1, "message", 1, "user", "a", 5, 6)], EVENTS + ", log int, turn int")
    assert chat.render(chat.reconstruct(extra)).count() == 1


def test_main_path_is_native(spark):
    df = chat.render(chat.reconstruct(spark.createDataFrame([(1, 1, "message", 1, "user", "a")], EVENTS)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
