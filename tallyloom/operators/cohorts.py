"""Cohort operators on any (user, date, revenue) table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import month_diff, safe_divide


def _user_months(df: DataFrame, user: str, date: str, revenue: str | None) -> DataFrame:
    """One row per user and active month: at most one row per calendar month for a user."""
    amount = F.col(revenue) if revenue else F.lit(1)
    return df.groupBy(user, F.trunc(date, "month").alias("month")).agg(F.sum(amount).alias("revenue"))


def cohort_retention(df: DataFrame, user: str, date: str, revenue: str) -> DataFrame:
    """Users, revenue and retention per cohort (month of first order) and months since.

    After the monthly reduction the first month is a small window per user, each row is a
    distinct user, and the cohort size is the count of period 0.
    """
    months = _user_months(df, user, date, revenue)
    # NULL users form one group in the reduction but never count as a user
    dated = months.withColumn("cohort_month", F.min("month").over(Window.partitionBy(user)))
    table = dated.withColumn("period_number", month_diff("cohort_month", "month")).groupBy(
        "cohort_month", "period_number"
    ).agg(F.count(user).alias("customers"), F.sum("revenue").alias("revenue"))
    size = F.max(F.when(F.col("period_number") == 0, F.col("customers"))).over(Window.partitionBy("cohort_month"))
    return table.withColumn("cohort_size", size).withColumns({
        "retention_rate": safe_divide("customers", "cohort_size"),
        "revenue_per_cohort_user": safe_divide("revenue", "cohort_size"),
    })


def monthly_activity(df: DataFrame, user: str, date: str, revenue: str | None = None) -> DataFrame:
    """Users and revenue per month of activity: cohort and period are the same month, so the
    offset is always 0 and the rate always 100."""
    table = _user_months(df, user, date, revenue).groupBy(F.col("month").alias("cohort_month")).agg(
        F.count(user).alias("users"), F.sum("revenue").alias("total_revenue")
    )
    return table.withColumns({
        "period_number": F.lit(0),
        "cohort_size": F.col("users"),
        "retention_rate": F.round(safe_divide("users", "users") * 100, 2),
        "revenue_per_user": F.round(safe_divide("total_revenue", "users"), 2),
    })
