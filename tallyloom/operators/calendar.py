"""Calendar operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import business_days, day_of_week0, year_month


def date_dimension(dates: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a table.

    Saturday and Sunday are the weekend.
    """
    span = dates.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date_day"))
    d = F.col("date_day")
    return days.select(
        "date_day",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week0(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        year_month(d).alias("year_month"),
        F.when(day_of_week0(d).isin(0, 6), "Weekend").otherwise("Weekday").alias("is_weekend"),
    )


def business_days_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Monday–Friday days from ``start`` up to, not including, ``end``."""
    return spark.range(1).select(business_days(F.lit(start), F.lit(end)).alias("business_days_count"))
