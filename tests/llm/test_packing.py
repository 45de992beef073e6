from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlytics.llm import packing
from cartlytics.llm.queries import default_vocabulary

from .conftest import ODD_ROWS, documents, prose


@pytest.fixture(scope="module")
def vocabulary():
    return default_vocabulary()


def whole_ids(path, text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, packing.END_ID], np.uint32)


def check(spark, rows, path, window=packing.WINDOW, groups=1):
    docs = documents(spark, rows)
    cut = packing.pieces(docs, path, window, with_ids=True)
    got = packing.pack(cut, groups * packing.GROUP_ITEMS, window).toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= window if len(got) else True
    for _, rows_ in got.groupby("sequence_id"):  # gapless from 0
        at = rows_.sort_values("offset")
        assert (at["offset"] == at["length"].cumsum() - at["length"]).all()
    want = sorted((i is not None, i or 0, whole_ids(path, t).tobytes()) for i, t in rows)
    pieces = {}
    for r in got.itertuples():
        ids = np.asarray(r.ids, np.uint32)
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        pieces.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(int(r.start), []).append(ids)
    docs_back = []
    for (i, total), parts in pieces.items():
        copies = len(parts[0])
        for c in range(copies):
            ids = np.concatenate([parts[s][c % len(parts[s])] for s in sorted(parts)])
            assert len(ids) == total
            docs_back.append((i == i and i is not None, int(i) if i == i and i is not None else 0, ids.tobytes()))
    assert sorted(docs_back) == want
    return got


def test_round_trip_and_little_padding(spark, vocabulary):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 400)) + rng.choice([".", ", and 's it's", " É'LL <|endoftext|>", "!?\x01 x"]))
            for i in range(300)]
    got = check(spark, rows, vocabulary)
    used = got.groupby("sequence_id")["length"].sum()
    assert used.sum() / (len(used) * packing.WINDOW) > 0.97


def test_words_one_by_one_equal_whole_texts(vocabulary):
    rng = random.Random(4)
    bits = ["the", "Word", "word,", "word.", "a.b,", ",", ".", "'s", "don't", "é,", "J̌", "İ", "123", "4.5,", "\x01", " ", "\n",
            " ", " ", "\x1c", "\U0001f600", "<|endoftext|>", "ﬁ", "x" * 100, "İ.", "ab\x01,", "<|", "ÀÉß", "naïve", "x÷y", "×", "!!", "$$$", "a_b", "_", "don't!", "'S,", "éÉ.,", "ÿ", "ŸŁ"]
    words = packing.tokenizer(vocabulary)
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", "  "]) for _ in range(rng.randrange(30))) for _ in range(400)]
    for text, ids in zip(texts, words.batch([t.encode() for t in texts]), strict=True):
        assert ids == whole_ids(vocabulary, text)[:-1].tobytes(), repr(text)


def test_best_fit_decreasing_equals_a_plain_one():
    rng = random.Random(5)
    for _ in range(30):
        window = rng.choice([1, 7, 64, 100])
        lengths = [rng.randrange(1, window + 1) for _ in range(rng.randrange(0, 80))]
        where, offset = packing.best_fit_decreasing(lengths, window)
        open_ = []  # remaining capacities
        for n in sorted(lengths, reverse=True):
            fits = [c for c in open_ if c >= n]
            if fits:
                open_.remove(min(fits))
                open_.append(min(fits) - n)
            else:
                open_.append(window - n)
        used = {}
        for w, o, n in sorted(zip(where, offset, lengths, strict=True), key=lambda x: x[:2]):
            assert o == used.get(w, 0)
            used[w] = o + n
        assert sorted(window - v for v in used.values()) == sorted(open_)


def test_odd_rows_several_groups_and_empty_tables(spark, vocabulary):
    check(spark, ODD_ROWS, vocabulary, window=1024, groups=3)
    docs = documents(spark, ODD_ROWS).withColumn("length", F.lit("x")).withColumn("_group", F.lit(1))
    assert packing.pack(packing.pieces(docs, vocabulary), 10).select("doc_id").distinct().count() == 10
    assert packing.pack(packing.pieces(documents(spark, []), vocabulary), 0).count() == 0
