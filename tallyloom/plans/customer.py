"""Customer analytics and customer segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import argmax_label, concat_skip_nulls, decide, mean, safe_divide, surrogate_key, tier
from ..operators import ordered
from ..params import Params


def customer_id():
    """Synthetic buyer id: finer for marketplace lines than for the other channel."""
    return F.when(
        F.col("sales_channel") == "AMAZON",
        F.md5(concat_skip_nulls("shipping_city", "shipping_state", "customer_segment", "sku")),
    ).otherwise(F.md5(concat_skip_nulls("sales_channel", "city_tier", "customer_segment")))


def customer_analytics(unified: DataFrame, p: Params) -> DataFrame:
    """RFM scores, lifecycle, value, engagement, season and simple predictions per buyer."""
    group = [
        "customer_id", "sales_channel", "customer_segment", "city_tier", "is_b2b",
        "shipping_city", "shipping_state", "shipping_country",
    ]
    lines = unified.filter("recognized_revenue > 0").withColumn("customer_id", customer_id())
    seasons = {
        f"{name.lower()}_orders": F.count_if(F.month("order_date").isin(*months))
        for name, months in V.SEASON_MONTHS.items()
    }
    money = F.col("recognized_revenue")
    df = lines.groupBy(*group).agg(
        F.count_distinct("order_date").alias("total_orders"),
        F.count_distinct("sku").alias("unique_products_purchased"),
        F.count_distinct("product_category").alias("unique_categories_purchased"),
        F.sum(money).alias("total_revenue"),
        mean(money).alias("avg_order_value"),
        F.min(money).alias("min_order_value"),
        F.max(money).alias("max_order_value"),
        F.stddev_samp(money.cast("double")).alias("order_value_stddev"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        *[c.alias(n) for n, c in seasons.items()],
    ).withColumns({
        "customer_lifespan_days": F.datediff("last_order_date", "first_order_date"),
        "days_since_last_order": F.datediff(F.lit(p.as_of), "last_order_date"),
        "favorite_category": F.lit(V.FAVOURITE_CATEGORY),
    })
    span = F.col("customer_lifespan_days")
    df = df.withColumn(
        "annual_order_frequency", F.when(span > 0, safe_divide("total_orders", span) * 365).otherwise(0.0)
    )
    ties = ordered.by(*group)
    df = ordered.ntile_scores(df, 5, {
        "recency_score": [ordered.By("days_since_last_order", descending=True), *ties],
        "frequency_score": [ordered.By("total_orders"), *ties],
        "monetary_score": [ordered.By("total_revenue"), *ties],
    })
    silent = F.col("days_since_last_order")
    churn = reduce(
        lambda c, step: c.when(silent > step[0], step[1]), V.CHURN_STEPS[1:],
        F.when(silent > V.CHURN_STEPS[0][0], V.CHURN_STEPS[0][1]),
    ).otherwise(V.CHURN_OTHER)
    df = df.withColumns({
        "recency": silent,
        "frequency": F.col("total_orders"),
        "monetary": F.col("total_revenue"),
        "rfm_score": concat_skip_nulls("recency_score", "frequency_score", "monetary_score"),
        "rfm_segment": decide(V.RFM_SEGMENT),
        "lifecycle_stage": decide(V.LIFECYCLE),
        "value_tier": tier("total_revenue", V.CUSTOMER_VALUE),
        "engagement_level": decide(V.ENGAGEMENT),
        "seasonal_preference": argmax_label(V.SEASON_SHOPPERS, "All Season"),
        "predicted_clv_2year": F.when(span > 0, safe_divide("total_revenue", span) * 365 * 2).otherwise(
            F.col("avg_order_value") * F.col("annual_order_frequency") * 2
        ),
        "churn_probability": churn,
        "predicted_days_to_next_order": F.when(
            F.col("annual_order_frequency") > 0,
            F.round(safe_divide(F.lit(365.0), "annual_order_frequency")),
        ).otherwise(365.0),
    })
    return df.withColumn("upsell_potential", decide(V.UPSELL))


def customer_segments(base: DataFrame, p: Params) -> DataFrame:
    """One row per segment and channel: value, loyalty, preferences, churn risk, scores, action.

    The few groups hold most of the rows; every aggregate combines on the map side and the
    distinct counts shuffle by value, so no task sees a whole group.
    """
    df = base.groupBy("customer_segment", "partner_channel").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_units_purchased"),
        F.count_distinct("product_sku").alias("unique_products_purchased"),
        F.count_distinct("order_date").alias("active_days"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        mean("revenue").alias("avg_order_value"),
        mean("quantity").alias("avg_units_per_order"),
        F.stddev_samp(F.col("revenue").cast("double")).alias("revenue_volatility"),
        F.count_if(F.col("order_value_tier") == "high_value").alias("high_value_orders"),
        F.count_if("is_b2b").alias("b2b_orders"),
        F.count_if("is_business_day").alias("business_day_orders"),
        *[F.count_if(F.col("quarter") == q).alias(f"q{q}_orders") for q in (1, 2, 3, 4)],
    )
    short = {"amazon": "amazon", "merchant_website": "merchant", "international": "international"}
    span = F.col("customer_lifespan_days")
    silent = F.datediff(F.lit(p.as_of), "last_order_date")
    df = df.withColumn("customer_lifespan_days", F.datediff("last_order_date", "first_order_date")).withColumns({
        # the channel is a grouping key: its active days are all days or none
        **{
            f"{name}_active_days": F.when(F.col("partner_channel") == ch, F.col("active_days")).otherwise(0)
            for ch, name in short.items()
        },
        "estimated_annual_value": F.when(span > 0, safe_divide("total_revenue", span) * 365).otherwise(
            F.col("total_revenue").cast("double")
        ),
        "orders_per_month": F.when(span > 0, safe_divide("total_orders", span / 30.0)).otherwise(
            F.col("total_orders").cast("double")
        ),
        "b2b_share": safe_divide("b2b_orders", "total_orders"),
    }).withColumns({
        "loyalty_tier": tier("total_orders", V.LOYALTY),
        "value_tier": tier("total_revenue", V.SEGMENT_VALUE),
        "engagement_level": tier("active_days", V.ACTIVE_DAYS),
        "channel_preference": decide(V.CHANNEL_PREFERENCE),
        "seasonal_pattern": argmax_label(V.QUARTER_SEASONAL, "no_seasonal_pattern"),
        "churn_risk_level": tier(silent, V.SILENT_DAYS_CHURN),
        "business_customer_type": decide(V.BUSINESS_SHARE),
        "spending_pattern": tier(safe_divide("revenue_volatility", "avg_order_value"), V.SPENDING),
        "high_value_propensity": tier(safe_divide("high_value_orders", "total_orders"), V.HIGH_VALUE_SHARE),
        "recency_score": tier(silent, V.SILENT_DAYS_SCORE),
        "frequency_score": tier("orders_per_month", V.ORDERS_PER_MONTH_SCORE),
        "monetary_score": tier("total_revenue", V.REVENUE_SCORE),
        "strategic_segment": decide(V.STRATEGIC_SEGMENT),
        "clv_tier": tier("estimated_annual_value", V.CLV_TIER),
    })
    return df.withColumn("marketing_persona", decide(V.PERSONA)).withColumns({
        "customer_segment_key": surrogate_key("customer_segment", "partner_channel"),
        "rfm_total_score": F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"),
        "recommended_action": decide(V.SEGMENT_ACTION),
        "investment_priority": decide(V.SEGMENT_PRIORITY),
        "segment_created_at": F.lit(p.as_of).cast("timestamp"),
    }).drop("b2b_share")
