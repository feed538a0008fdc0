"""Labelled rows for the classifiers: held-out rows and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text (NULL as ''), modulo ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_texts(docs: DataFrame, labels: DataFrame, target: str, folds: int, left_out: int, most: int) -> DataFrame:
    """(key, label, text) of at most about ``most`` labelled documents outside fold ``left_out``.

    The sample is the labelled ids of smallest hash; being of bounded size it is broadcast to the texts.
    Contradicting labels of one id count as 1.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(target).cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)").filter(fold("id", folds) != left_out)
    drawn = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text"))
    joined = texts.join(F.broadcast(drawn), "id")
    return joined.select(F.xxhash64("id", "text").alias("key"), "label", "text")
