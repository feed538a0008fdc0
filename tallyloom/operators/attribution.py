"""Touchpoint attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import safe_divide


def _edge_touch(df, touch: str, conversion: str, order: Sequence[str], pick) -> DataFrame:
    # an aggregate with map-side combining instead of ranking every touch of a conversion
    return df.groupBy(conversion).agg(pick(F.struct(touch), F.struct(*order)).alias("__t")).select(
        F.col(f"__t.{touch}").alias(touch), conversion, F.lit(1).cast("bigint").alias("touch_rank"),
    )


def first_touch(df: DataFrame, touch: str, conversion: str, order: Sequence[str]) -> DataFrame:
    """The earliest touch of each conversion (``order``: time, then tie-breakers)."""
    return _edge_touch(df, touch, conversion, order, F.min_by)


def last_touch(df: DataFrame, touch: str, conversion: str, order: Sequence[str]) -> DataFrame:
    return _edge_touch(df, touch, conversion, order, F.max_by)


def linear_touch(df: DataFrame, touch: str, conversion: str) -> DataFrame:
    """Every touch with an equal share of its conversion."""
    from .ordered import null_safe_join

    totals = df.groupBy(conversion).agg(F.count(F.lit(1)).alias("total_touches"))
    return null_safe_join(df.select(touch, conversion), totals, [conversion]).withColumn(
        "attribution_weight", safe_divide(F.lit(1.0), "total_touches")
    )


def attribution(
    df: DataFrame, touch: str, conversion: str, order: Sequence[str], model: str = "first_touch",
) -> DataFrame:
    if model == "first_touch":
        return first_touch(df, touch, conversion, order)
    if model == "last_touch":
        return last_touch(df, touch, conversion, order)
    if model == "linear":
        return linear_touch(df, touch, conversion)
    raise ValueError(f"unknown attribution model {model!r}")
