"""Declarative checks.  Each returns the failing rows: no rows means the check passes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..params import Params


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their number of rows."""
    counts = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(~F.col("value_field").isin(*values))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value has no parent row."""
    keys = parent.select(F.col(parent_column).alias("__parent"))
    return child.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__parent"), "left_anti")


def completeness_below(df: DataFrame, column: str, threshold: float = 0.95) -> DataFrame:
    """Filled share of a text column; a row only when it is below the threshold."""
    filled = F.col(column).isNotNull() & (F.col(column) != "")
    out = df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(filled).alias("valid_records"))
    score = F.coalesce(F.try_divide(F.col("valid_records").cast("double"), F.col("total_records").cast("double")), F.lit(0.0))
    return out.withColumn("data_quality_score", score).filter(F.col("data_quality_score") < threshold)


def reconcile_totals(
    left: DataFrame, left_value: str, right: DataFrame, right_value: str, tolerance: float = V.RECONCILE_TOLERANCE,
) -> DataFrame:
    """Both totals, if they differ by more than the tolerance (a tagged union, no cross join)."""
    rows = left.select(F.lit("l").alias("side"), F.col(left_value).cast("double").alias("v")).unionByName(
        right.select(F.lit("r").alias("side"), F.col(right_value).cast("double").alias("v"))
    )
    both = rows.agg(
        F.sum(F.when(F.col("side") == "l", F.col("v"))).alias("left_total"),
        F.sum(F.when(F.col("side") == "r", F.col("v"))).alias("right_total"),
    )
    return both.filter(F.abs(F.col("left_total") - F.col("right_total")) > tolerance)


def stale_rows(tables: dict[str, tuple[DataFrame, str]], now: datetime, p: Params) -> DataFrame:
    """Rows of several tables last updated before the freshness limit."""
    limit = F.lit(now - timedelta(hours=p.freshness_hours))
    parts = [
        df.filter(F.col(column) < limit).select(F.lit(name).alias("model_name"), F.col(column).alias("last_update"))
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def contradictions(dashboard: DataFrame) -> DataFrame:
    """Dashboard rows whose score, revenue and advice contradict each other."""
    return dashboard.filter(V.CONTRADICTION).select(
        "partner_channel", "customer_segment", "revenue_30d", "overall_health_score"
    )
