"""A cleaned, tokenized corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on what the stage before it kept.
All but the last return the columns of ``documents``. A stage takes null and empty
texts, repeated rows, empty tables and extra columns as its operator does: texts
without words are scored like others, all copies of a text but one go in the
near-duplicate stage, and a text without words contains no benchmark item.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, pieces, quality, simhash, toxicity
from millrace.llm.queries import GOOD_FROM, PIECES, TOXIC_FROM, table
from millrace.llm.shared import written


def _where(docs: DataFrame, score: Column, keeps: Callable[[Column], Column]) -> DataFrame:
    """The rows whose score is kept, with their own columns, whatever their names."""
    rows = docs.select(F.struct("*").alias("row"), score.alias("score"))
    kept = rows.where(keeps(F.col("score")))
    return kept.select(*(F.col("row").getField(name).alias(name) for name in docs.columns))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, model.score(F.col("text")), lambda score: score >= GOOD_FROM)


def harmless_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, model.score(F.col("text")), lambda score: score < TOXIC_FROM)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return simhash.first_of_groups(docs, words=4, distance=4)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the whole text, their number, and whether they decode to it."""
    return pieces.encode_documents(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("quality", good_documents),
    ("toxicity", harmless_documents),
    ("near_duplicates", different_documents),
    ("decontamination", uncontaminated_documents),
    ("encoding", encoded_documents),
]
#: Scores of trained models and SimHash links can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
