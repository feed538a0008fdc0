"""Overall partner score and grade."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import mean, safe_divide, tier
from ..params import Params


def partner_performance_score(
    df: DataFrame, revenue: str, orders: str, p: Params, satisfaction: str | None = None,
) -> DataFrame:
    """One row: 40 points for revenue, 30 for orders, 20 for order value, 10 for satisfaction."""
    out = df.agg(
        F.sum(revenue).alias("total_revenue"),
        F.sum(orders).alias("total_orders"),
        mean(revenue).alias("avg_order_value"),
        (F.avg(satisfaction) if satisfaction else F.lit(5.0)).alias("avg_satisfaction"),
    )

    def points(col, full_at, most):
        return F.least(F.lit(float(most)), safe_divide(col, F.lit(full_at)) * most)

    out = out.withColumns({
        "revenue_score": points("total_revenue", p.revenue_target_monthly, 40),
        "volume_score": points("total_orders", 1000, 30),
        "aov_score": points("avg_order_value", p.high_value_order, 20),
        "satisfaction_score": F.col("avg_satisfaction") / 5.0 * 10,
    })
    total = F.col("revenue_score") + F.col("volume_score") + F.col("aov_score") + F.col("satisfaction_score")
    return out.withColumn("total_performance_score", total).withColumn(
        "performance_grade", tier("total_performance_score", V.PARTNER_GRADE)
    )
