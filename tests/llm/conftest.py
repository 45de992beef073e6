from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Intermediate tables of local tests go to a folder of this session."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def documents(spark, rows):
    """rows: (doc_id, text); the other columns are filled or null."""
    return spark.createDataFrame(
        [(i, t, "en" if k % 2 else None, None, len(t) if t is not None else None) for k, (i, t) in enumerate(rows)], DOCS)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


#: Rows that every operator on documents must take: nulls, empty and blank
#: texts, repeated rows, ties, odd characters, one very long word and text.
ODD_ROWS = [
    (None, None), (None, "a null id"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"),
    (6, "É ß \U0001f600 x\x00y \\ | # <"), (7, "z" * 70_000), (8, "long text " * 20_000), (-9, "negative id here"),
]
