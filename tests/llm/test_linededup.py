from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlytics.llm import linededup

from .conftest import ODD_ROWS, documents


def brute_force(rows, min_words):
    """Remaining text per (doc_id, text), from the definition; ids are distinct."""
    docs = [(i, (t or "").split("\n")) for i, t in sorted(rows, key=lambda r: r[0])]
    out = {}
    for k, (i, lines) in enumerate(docs):
        gone = set()
        for a in range(len(lines)):
            best = 0
            for k2 in range(k + 1):
                other = docs[k2][1]
                for a2 in range(len(other) if k2 < k else a):
                    n = 0
                    while a + n < len(lines) and a2 + n < len(other) and lines[a + n] == other[a2 + n]:
                        n += 1
                    best = max(best, n)
            if best and sum(len(x.split()) for x in lines[a:a + best]) >= min_words:
                gone.update(range(a, a + best))
        out[i] = "\n".join(x for j, x in enumerate(lines) if j not in gone)
    return out


def result(spark, rows, min_words):
    return {r["doc_id"]: r["text"] for r in linededup.filter_lines(documents(spark, rows), min_words).collect()}


@pytest.mark.parametrize("seed,alphabet,min_words", [(1, 3, 4), (2, 12, 5), (3, 30, 6), (4, 2, 9)])
def test_equals_brute_force(spark, seed, alphabet, min_words):
    rng = random.Random(seed)
    line = [" ".join(["w"] * rng.randrange(0, 4) + [f"l{i}"]) for i in range(alphabet)]
    rows = []
    for i in range(30):
        lines = [rng.choice(line) for _ in range(rng.randrange(1, 25))]
        if i > 5 and rng.random() < 0.6:  # a copied run, or a whole copy
            source = rng.choice(rows)[1].split("\n")
            a = rng.randrange(len(source))
            lines[rng.randrange(len(lines)):1] = source[a:a + rng.randrange(1, 15)]
        rows.append((i, "\n".join(lines)))
    rng.shuffle(rows)
    assert result(spark, rows, min_words) == brute_force(rows, min_words)


def test_prefixes_with_earlier_places():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 12)
        places = np.array(rng.sample(range(50), n))
        common = np.array([0] + [rng.randrange(0, 5) for _ in range(n - 1)])
        want = [max([min(common[min(i, j) + 1:max(i, j) + 1]) for j in range(n) if places[j] < places[i]], default=0)
                for i in range(n)]
        assert linededup.earlier_prefixes(places, common).tolist() == want


def test_later_copies_go_and_short_repeats_stay(spark):
    passage = "\n".join(f"line {k} " + "word " * 20 for k in range(3))
    rows = [(5, f"own five\n{passage}\nend five"), (2, f"own two\n{passage}"), (9, f"{passage}\nBy the way.\nrest nine"),
            (7, "By the way.\nown seven")]
    got = result(spark, rows, linededup.MIN_WORDS)
    assert got == {2: rows[1][1], 5: "own five\nend five", 9: "By the way.\nrest nine", 7: rows[3][1]}


def test_odd_rows_and_empty_tables(spark):
    long = "a b c d e f"
    rows = ODD_ROWS + [(40, long), (41, long), (41, long), (None, long), (42, "\n".join([long] * 5)), (43, "\n\n\n")]
    docs = documents(spark, rows).withColumn("kept", F.lit(3)).withColumn("gone", F.lit("x")).withColumn("doc", F.lit(1))
    out = linededup.filter_lines(docs, 6)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
        assert r["kept"] == 3 and r["gone"] == "x"
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    assert got[40] == [long] and got[41] == ["", ""] and got[42] == [""] and got[43] == ["\n\n\n"]
    assert sorted(map(str, got[None])) == ["", "None", "a null id"]
    assert got[1] == [None] and got[2] == [""] and got[5] == ["one", "one"] and got[7] == ["z" * 70_000]
    assert linededup.filter_lines(documents(spark, [])).count() == 0


def test_every_round_frees_what_it_held(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(linededup, "free_shuffles", freed.append, raising=False)
    rows = [(k, "\n".join(f"{'word ' * 9}{j}" for j in range(40))) for k in range(2)]
    rows.append((2, rows[0][1] + "\nown\n" + rows[0][1][:900]))
    linededup.filter_lines(documents(spark, rows)).count()
    assert len(freed) >= 3  # one before, one a round
