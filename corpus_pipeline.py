"""A pipeline of corpus operators over the documents: quality rules, line dedup, near-dedup, personal data, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next stage's docs. All
but the last return the columns of the documents. The operators state what they do with nulls, empty texts and repeated rows.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import common, line_templates, packing, pii, quality_rules, simhash


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.select(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs (the first document keeps them)."""
    return line_templates.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 ids."""
    return packing.pack(docs)


STAGES = [("quality rules", rules), ("line dedup", lines), ("near-dedup", near_copies), ("personal data", personal_data), ("packing", packed)]
ORACLE_SQL = None  # packing and near-dedup can't be said in SQL; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages. What a stage stages for itself is deleted as soon as its result is written."""
    docs = common.read_documents(spark, sf_dir)
    folder = f"{common.shared_dir(spark)}/pipeline-{uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with common.scope(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
