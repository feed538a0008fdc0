"""Corpus pipeline: quality filter, near-dedup, decontamination, mixing, sharding over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of documents.  Mixing repeats a document once per epoch in which it is drawn; sharding adds ``shard``.

Edge cases follow the operators': NULL and empty texts are documents without words, and all fingerprints of zero are one
group; of rows of one id and text one stays; a NULL id sorts last among a group's rows; an empty table gives an empty result.
Further columns pass through unread with their own values, whatever their names; only a column ``shard`` is replaced by the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import mixing, quality, sharding, simhash, templates
from tallyloom.llm.common import stage, unstage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (operator 10)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link within two bits (operator 3)."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item (operator 2)."""
    return templates.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn for the target weights of domains, languages and sources (operator 6)."""
    return mixing.drawn_documents(docs)


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (operator 4)."""
    return sharding.shard_documents(docs, 16)


STAGES = [
    ("quality", good_documents), ("near_dedup", distinct_documents), ("decontamination", clean_documents),
    ("mixing", mixed_documents), ("sharding", sharded_documents),
]

#: the classifier's scores cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            unstage(before)  # the next stage reads only the table just written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
