"""Time series and outlier operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import day_of_week0, mean_over, safe_divide
from ..params import Params
from . import ordered


def per_day(df: DataFrame, date: str, value: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Sum of the value per calendar day (and partition)."""
    day = F.to_date(date).alias(date)
    return df.groupBy(*partition_by, day).agg(F.sum(value).alias(value))


def time_series_features(
    df: DataFrame, date: str, value: str, windows: Sequence[int] = (7, 30, 90), partition_by: Sequence[str] = (),
) -> DataFrame:
    """Lags, rolling means, calendar parts and trend of a daily series.

    Rows are summed to one per day first, so the ordered window has one row per calendar
    day however many lines there are.
    """
    daily = per_day(df, date, value, partition_by)
    w = Window.partitionBy(*partition_by).orderBy(date)
    out = daily.withColumns({
        "row_num": F.row_number().over(w).cast("bigint"),
        **{f"lag_{n}": F.lag(value, n).over(w) for n in (1, 7, 30)},
        **{f"rolling_avg_{n}": mean_over(value, w.rowsBetween(1 - n, 0)) for n in windows},
        "day_of_week": day_of_week0(date),
        "day_of_month": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "month_of_year": F.month(date),
        "quarter_of_year": F.quarter(date),
    })
    return out.withColumns({"trend": F.col("row_num"), "trend_squared": F.col("row_num") * F.col("row_num")})


def moving_averages(df: DataFrame, date: str, value: str, windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Daily series with means that stay NULL until the window is full."""
    w = Window.orderBy(date)

    def full(n: int) -> Column:
        frame = w.rowsBetween(1 - n, 0)
        return F.when(F.count(value).over(frame) == n, mean_over(value, frame))

    return per_day(df, date, value).withColumns({f"ma_{n}": full(n) for n in windows})


def zscore_anomalies(df: DataFrame, value: str, p: Params) -> DataFrame:
    """Distance from the overall mean in standard deviations, flagged above ``p.z_threshold``.

    The two statistics are uncorrelated scalar subqueries: one pass, two numbers.
    """
    x = F.col(value).cast("double")
    stats = df.select(x.alias("x")).agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    z = F.abs(F.try_divide(x - stats.select("m").scalar(), stats.select("s").scalar()))
    return df.withColumn("z_score", z).withColumn(
        "is_anomaly", F.coalesce(F.col("z_score") > p.z_threshold, F.lit(False))
    )


def iqr_anomalies(df: DataFrame, value: str, p: Params) -> DataFrame:
    """Values outside the quartiles by more than ``p.iqr_factor`` interquartile ranges."""
    row = ordered.exact_percentiles(df, [], value, {"q1": 0.25, "q3": 0.75}).first()
    q1, q3 = (row["q1"], row["q3"]) if row else (None, None)
    x = F.col(value).cast("double")
    low, high = F.lit(q1).cast("double"), F.lit(q3).cast("double")
    iqr = high - low
    return df.withColumns({
        "iqr": iqr,
        "is_anomaly": F.coalesce((x < low - p.iqr_factor * iqr) | (x > high + p.iqr_factor * iqr), F.lit(False)),
    })


def seasonal_adjustment(df: DataFrame, date: str, value: str) -> DataFrame:
    """Value divided by its quarter's factor (mean of the quarter over the overall mean)."""
    lines = df.withColumn("quarter", F.quarter(date))
    sums = lines.groupBy("quarter").agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    everything = Window.partitionBy()
    factors = sums.withColumn(
        "overall", safe_divide(F.sum("s").over(everything), F.sum("n").over(everything))
    ).select("quarter", safe_divide(safe_divide("s", "n"), "overall").alias("seasonal_factor"))
    # at most five rows: four quarters and NULL
    return lines.join(F.broadcast(factors), "quarter", "left").withColumn(
        "seasonally_adjusted_value", safe_divide(value, "seasonal_factor")
    )
