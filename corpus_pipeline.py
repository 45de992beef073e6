"""A training-corpus pipeline: five stages over the documents table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

1. toxicity          drops documents that the Kneser-Ney models reject
2. line_dedup        deletes later copies of repeated line runs (25 words or more)
3. near_duplicates   keeps the smallest doc_id of every group of near copies
                     (five-word shingles, similarity 0.8)
4. decontamination   drops documents that contain a benchmark item
5. packing           cuts the rest into pieces and packs them into windows of
                     2048 tokens

Nulls, empty tables, repeated rows and extra columns are handled as the
operators' docstrings say.  A table without usable labels loses no document to
the first stage: the score is then the share of toxic labels, at most 0.5
unless every label is 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlytics.llm import decontam, linededup, neardup, packing, toxicity
from cartlytics.llm.common import fold, save, table
from cartlytics.llm.queries import default_vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return toxicity.filter_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.filter_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.filter_duplicates(docs, shingle_words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.filter_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, default_vocabulary()), docs.count())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The models of the first stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
