"""The documents of a corpus made ready for training, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import exact_dedup, jaccard_join, mixing, packing, quality
from tierlake.llm.common import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, learned from the labels of these documents, don't reject."""
    rules = quality.train(quality.measured(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, rules)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the largest identifier."""
    return exact_dedup.keep_one(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least identifier."""
    return jaccard_join.keep_one(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", unlike_documents),
    ("mixing sources to target weights", mixed_documents),
    ("best-fit packing", packed_documents),
]

#: SQL can't express the learned rules, the Newton iterations or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"pipeline-{number}")
    return docs
