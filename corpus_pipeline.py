"""A corpus pipeline: quality, near-duplicates, benchmark leaks, secrets, then packed training sequences.

Each stage is one operator and takes (spark, docs, sf_dir); its result is written as Parquet in the shared folder and
read again as the next one's docs. All but the last return the columns of documents; the last returns packed pieces.
Every stage gives no rows for an empty table and keeps extra columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.common import documents, remove, scratch
from stratiform.llm.decontamination import drop_leaks
from stratiform.llm.near_dedup import keep_one
from stratiform.llm.packing import pack_documents
from stratiform.llm.quality_classifier import keep_good
from stratiform.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects.

    Null and empty texts are judged as a passage without words; rows of equal text go or stay together; a null doc_id is
    judged like any other; without labels of both kinds the share of label 1 decides for all.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class, that of the least doc_id.

    Texts without words (null, empty, white space) are linked with nothing and stay; of rows of one doc_id one stays, of
    whichever text; rows with a null doc_id stay.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item.

    Null and empty texts and items match nothing; repeated rows and null doc_ids are judged by their texts.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; all rows stay.

    Null and empty texts stay as they are; repeated rows and null doc_ids are treated like any others.
    """
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens.

    A null or empty text is its end id alone; repeated rows are packed each; a null doc_id stays null.
    """
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]
#: SQL can express neither the classifier nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's table goes when the next one's is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
