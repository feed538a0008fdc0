"""Customer operators: lifetime values and RFM.

All of them first combine lines to one row per customer and day.  That makes the number of
purchase days a plain count, and a customer with very many lines is reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import decide, safe_divide, tier
from ..params import Params
from . import ordered


def _per_customer(df: DataFrame, customer: str, revenue: str, date: str) -> DataFrame:
    days = df.groupBy(customer, date).agg(
        F.sum(revenue).alias("__revenue"), F.count(revenue).alias("__lines")
    )
    return days.groupBy(customer).agg(
        F.count(date).alias("purchase_days"),
        F.sum("__revenue").alias("total_revenue"),
        safe_divide(F.sum("__revenue"), F.sum("__lines")).alias("avg_order_value"),
        F.min(date).alias("first_purchase"),
        F.max(date).alias("last_purchase"),
    ).withColumn("customer_lifespan_days", F.datediff("last_purchase", "first_purchase"))


def customer_ltv(
    df: DataFrame, customer: str, revenue: str, date: str, p: Params, prediction_months: int = 12,
) -> DataFrame:
    """Revenue per day of life projected over the months ahead, and a three-way segment."""
    years = F.lit(prediction_months / 12.0)
    span = F.col("customer_lifespan_days")
    out = _per_customer(df, customer, revenue, date).withColumnRenamed("purchase_days", "purchase_frequency")
    out = out.withColumn("predicted_ltv", F.when(
        span > 0, safe_divide("total_revenue", span) * 365 * years
    ).otherwise(F.col("avg_order_value") * F.col("purchase_frequency") * years))
    high, medium, low = V.LTV_LABELS
    return out.withColumn("ltv_segment", tier(
        "predicted_ltv", V.Bands(">", ((p.customer_ltv, high), (p.customer_ltv * 0.5, medium)), low)
    ))


def customer_lifetime_value(df: DataFrame, customer: str, revenue: str, date: str, periods: int = 12) -> DataFrame:
    """Order value times frequency per 30 days over ``periods``; NULL customers are dropped."""
    span = F.col("customer_lifespan_days")
    out = _per_customer(df.filter(F.col(customer).isNotNull()), customer, revenue, date)
    out = out.withColumnsRenamed({
        "purchase_days": "frequency", "first_purchase": "first_order_date", "last_purchase": "last_order_date",
    })
    volume = F.col("frequency") * F.col("avg_order_value") * periods
    return out.withColumn(
        "estimated_clv", F.when(span > 0, safe_divide(volume, span / 30.0)).otherwise(F.col("avg_order_value"))
    )


def rfm(df: DataFrame, customer: str, date: str, revenue: str, p: Params) -> DataFrame:
    """Recency, frequency and monetary quintiles over all customers, and the RFM segment."""
    out = _per_customer(df, customer, revenue, date).select(
        customer,
        F.col("last_purchase").alias("last_purchase_date"),
        F.col("purchase_days").alias("frequency"),
        F.col("total_revenue").alias("monetary_value"),
        F.datediff(F.lit(p.as_of), "last_purchase").alias("recency_days"),
    )
    out = ordered.ntile_scores(out, 5, {
        "recency_score": [ordered.By("recency_days", descending=True), ordered.By(customer)],
        "frequency_score": ordered.by("frequency", customer),
        "monetary_score": ordered.by("monetary_value", customer),
    })
    return out.withColumn("rfm_segment", decide(V.RFM_SEGMENT))
