"""The registered queries over the smallest test tables."""

from __future__ import annotations

import duckdb
import pytest

from cartlytics.llm.queries import QUERIES, SQL

SF_SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_oracle(spark, con, name):
    res = con.execute(SQL[name])
    columns = [d[0] for d in res.description]
    got = sorted(map(repr, map(tuple, QUERIES[name](spark, SF_SMALL).select(*columns).collect())))
    assert got == sorted(map(repr, res.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs_with_one_row_per_document_or_more(spark, name):
    out = QUERIES[name](spark, SF_SMALL)
    n = out.count()
    assert n >= 200 or name == "op7_decontamination" and n > 0


def test_held_out_rows_are_classified(spark):
    """In these tables some toxic words are ordinary ones with a certain beginning,
    which ordinary documents also hold by chance, and few documents are labelled."""
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/labels.parquet")
    for name, label, least in (("op1_toxicity", "toxic", 0.95), ("op3_quality", "quality", 0.99)):
        rows = QUERIES[name](spark, SF_SMALL.replace("0.001", "0.1")).where("held_out").join(labels, "doc_id")
        right, n = rows.selectExpr(f"sum(int(predicted = {label}))", "count(*)").first()
        assert right / n > least, name
