from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

from cartlytics.llm import spelling

from .conftest import DOCS, ODD_ROWS, documents


def edited(word: str, letters: str) -> set[str]:
    """All words exactly one edit away."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i + 1:] for i in range(len(word))}
        out |= {word[:i] + c + word[i:] for i in range(len(word) + 1)}
    return out - {word}


def brute(counts: dict[str, int], factor=10):
    letters = "".join(sorted(set("".join(counts))))
    near = {w: [x for x in edited(w, letters) if x in counts] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= factor * counts[w]:
            form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def result(spark, counts, **how):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r) for r in spelling.variants(words, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abcdé", 2), ("aaaaaaÿb", 3)])
def test_equals_brute_force(spark, letters, seed):
    """Few letters: many equal bigrams in a word, many ties, many near words."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 11))) for _ in range(250)}
    words |= {rng.choice(sorted(edited(w, letters))) for w in sorted(words)}
    counts = {w: rng.choice([1, 2, 3, 30, 400, 9000]) for w in words if len(w) >= 4}
    assert result(spark, counts) == brute(counts)


def test_chains_ties_and_the_factor(spark):
    counts = {"spelling": 1000, "speling": 100, "spelin": 10, "speln": 1, "spellings": 1000, "spelng": 101}
    got = {w: (form, root) for w, form, root, *_ in result(spark, counts)}
    assert got["speling"] == ("spelling", "spelling") and got["spelin"] == ("speling", "spelling")
    assert result(spark, counts) == brute(counts)
    assert result(spark, {"abcdefg": 10, "abcdefx": 100, "abcdefy": 100, "abcdefz": 99}) == brute(
        {"abcdefg": 10, "abcdefx": 100, "abcdefy": 100, "abcdefz": 99})


def test_pivots_are_disjoint_rare_and_in_the_prefix():
    rng = random.Random(6)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(4, 14)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)}, key=lambda g: (rng.random(), g))
        sizes = sorted(rng.randint(1, 9) for _ in grams)
        order = {g: (k, n) for k, (g, n) in enumerate(zip(grams, sizes, strict=True))}
        prefix, pivots = spelling.prefix_and_pivots(word, order)
        size = dict(order.values())
        assert len(prefix) >= 3 and set(pivots) <= set(prefix) and abs(pivots[0][1] - pivots[1][1]) >= 2
        assert sum(size[g] for g, _ in pivots) == min(
            size[a] + size[b] for a, i in prefix for b, j in prefix if abs(i - j) >= 2)


def counted(rows, error_every=31):
    total: Counter[str] = Counter()
    for doc, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in lower).split():
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % error_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


@pytest.mark.parametrize("every", [31, 2])
def test_counts_with_planted_errors(spark, every):
    rng = random.Random(every)
    base = ["Straßenbahn", "ÉCOLES", "exámples", "wonderful", "abcdefg", "shorter"]
    rows = [(i, " ".join(rng.choice(base) + rng.choice(["", ".", "-x", "5"]) for _ in range(60))) for i in range(120)]
    got = spelling.word_counts(documents(spark, rows).repartition(4), error_every=every)
    assert {r.word: r.n for r in got.collect()} == counted(rows, every)


def test_odd_rows(spark):
    rows = [*ODD_ROWS, *[(k, "wonderfull wonderful " * 3) for k in range(20)], (3, None)]
    df = documents(spark, rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    words = spelling.word_counts(df)
    counts = {r.word: r.n for r in words.collect()}
    assert counts == counted(rows) and "wonderful" in counts
    assert {tuple(r) for r in spelling.variants(words).collect()} == brute(counts)
    assert spelling.variants(spelling.word_counts(spark.createDataFrame([], DOCS))).count() == 0


def test_a_hot_word_is_one_row_before_the_join(spark):
    df = documents(spark, [(k, "commonest " * 500) for k in range(200)])
    counts = {r.word: r.n for r in spelling.word_counts(df).collect()}
    assert counts == counted([(k, "commonest " * 500) for k in range(200)])
