"""From raw documents to packed training sequences, one operator a stage.

``run`` applies the stages in order; each is written as Parquet to the shared folder and read again, so a lost
executor never repeats an earlier stage. Every stage works on all rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenweave.llm import exact_dedup, fertility, jaccard_join, packing, pii
from evenweave.llm.common import prepare
from evenweave.llm.registry import query
from evenweave.session import materialize, new_run_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or fall out of the fertility bands go."""
    prepare(spark)
    return fertility.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    prepare(spark)
    return exact_dedup.unique_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, connected by links, the document of the smallest id stays."""
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; n_chars follows the new text."""
    return pii.redacted_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece of a document."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("pii", private),
    ("packing", packed),
]
ORACLE_SQL = None  # SQL cannot express the tokenisers; tests hold each stage against brute force


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_run_dir(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"{folder}/{i}")
    return docs
