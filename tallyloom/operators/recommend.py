"""Recommendation features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import ordered
from ..sources.staging import stage


def interaction_matrix(df: DataFrame, user: str, item: str, rating: str | None = None) -> DataFrame:
    """One row per (user, item): interactions and mean rating (1 without a rating column)."""
    mean = F.avg(F.col(rating).cast("double")) if rating else F.lit(1.0)
    return df.groupBy(user, item).agg(F.count(F.lit(1)).alias("interaction_count"), mean.alias("avg_rating"))


def recommendation_features(df: DataFrame, user: str, item: str, rating: str | None = None) -> DataFrame:
    """Interaction matrix with item popularity and the rank of each item for its user."""
    matrix = stage(interaction_matrix(df, user, item, rating), "matrix")
    popularity = matrix.groupBy(item).agg(
        F.count(user).alias("user_count"),  # one row per user and item
        F.avg("avg_rating").alias("avg_product_rating"),
        F.sum("interaction_count").alias("total_interactions"),
    )
    # by item before by user: the ranking shuffle is the last one
    joined = matrix.join(popularity, item)
    return ordered.value_ranks(
        joined, [user], "avg_rating", descending=True, rank="user_product_rank", source=matrix, at_most=matrix.count(),
    )
