"""Cohort mart: retention, revenue retention, lifetime value and classes per cohort and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as V
from ..functions import clamp, decide, map_values, mean, month_diff, months_back, safe_divide, surrogate_key, tier
from ..operators import ordered
from ..params import Params
from ..sources.staging import stage


def cohort_analysis(
    base: DataFrame, p: Params, entity: str = "order_id", tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """``entity`` is what returns: the order by default, a customer key where there is one.

    First dates and running sums come from one pass over the same keys.  The line history is
    staged narrow because three aggregations read it.  Distinct entity counts
    become plain counts after one pre-aggregation per entity and month.
    """
    who = [entity, "customer_segment", "partner_channel"]
    cohort = ["cohort_month", "customer_segment", "partner_channel"]
    cell = [*cohort, "period_number"]
    today = F.lit(p.as_of)

    used = [*who, "order_date", "revenue", "quantity", "product_category", "order_value_tier", *tie_break]
    lines = stage(base.select(*dict.fromkeys(used)), "cohort_lines")
    history = ordered.running_sums(
        lines, who, ordered.by("order_date", *tie_break),
        {"cumulative_revenue": F.col("revenue"), "order_sequence": F.lit(1).cast("bigint")},
        lowest={"first_order_date": "order_date"}, at_most=lines.count(),
    ).withColumn("cohort_month", F.trunc("first_order_date", "month"))
    history = history.filter(F.col("cohort_month") >= months_back(today, p.cohort_months))
    history = stage(history.select(
        *who, "cohort_month", month_diff("first_order_date", "order_date").alias("period_number"), "product_category",
        "order_value_tier", "revenue", "quantity", "cumulative_revenue", "order_sequence",
    ), "history")

    per_entity = history.groupBy(*cell, entity).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("quantity").alias("quantity"),
        F.sum("cumulative_revenue").alias("cumulative"),
        F.count(F.lit(1)).alias("lines"),
        F.max(F.col("order_value_tier") == "high_value").alias("is_high"),
        F.max(F.col("order_sequence") > 1).alias("is_repeat"),
    )
    metrics = per_entity.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("revenue").alias("period_revenue"),
        F.sum("quantity").alias("period_quantity"),
        safe_divide(F.sum("revenue"), F.sum("lines")).alias("avg_revenue_per_customer"),
        safe_divide(F.sum("cumulative"), F.sum("lines")).alias("avg_cumulative_revenue"),
        F.count_if("is_high").alias("high_value_customers"),
        F.count_if("is_repeat").alias("repeat_customers"),
    )
    categories = history.groupBy(*cell).agg(F.count_distinct("product_category").alias("unique_categories_purchased"))
    medians = ordered.exact_percentiles(history, cell, "revenue", {"median_revenue_per_customer": 0.5})
    # from here on the grain is a calendar cell: small
    df = metrics.join(categories, cell).join(medians, cell)

    whole = Window.partitionBy(*cohort)

    def initial(col):
        return F.max(F.when(F.col("period_number") == 0, F.col(col))).over(whole)

    by_period = whole.orderBy("period_number")
    df = df.withColumns({
        "cohort_size": initial("active_customers"),
        "cohort_initial_revenue": initial("period_revenue"),
        "cohort_initial_avg_revenue": initial("avg_revenue_per_customer"),
        "prev_period_customers": F.lag("active_customers", 1).over(by_period),
        "prev_period_revenue": F.lag("period_revenue", 1).over(by_period),
    }).withColumns({
        "retention_rate": safe_divide("active_customers", "cohort_size"),
        "revenue_retention_rate": safe_divide("period_revenue", "cohort_initial_revenue"),
        "revenue_per_customer_ratio": safe_divide("avg_revenue_per_customer", "cohort_initial_avg_revenue"),
        "high_value_customer_rate": safe_divide("high_value_customers", "active_customers"),
        "repeat_customer_rate": safe_divide("repeat_customers", "active_customers"),
        "ltv_at_period": F.col("avg_cumulative_revenue"),
        "lifecycle_stage": tier("period_number", V.COHORT_STAGE),
    })

    def month_1(at_zero, rate):
        return F.when(F.col("period_number") == 0, F.col(at_zero).cast("double")).when(
            F.col("period_number") == 1, F.col(rate)
        )

    def change(n, prev):
        return F.when(F.col(prev) > 0, safe_divide(n, prev)).otherwise(0.0)

    quality = sum(
        (F.col(c) * w for c, w in V.COHORT_WEIGHTS[1:]), F.col(V.COHORT_WEIGHTS[0][0]) * V.COHORT_WEIGHTS[0][1]
    )
    df = df.withColumns({
        "month_1_retention_rate": month_1("cohort_size", "retention_rate"),
        "month_1_revenue_retention_rate": month_1("cohort_initial_revenue", "revenue_retention_rate"),
        "churn_rate": change(F.col("prev_period_customers") - F.col("active_customers"), "prev_period_customers"),
        "revenue_growth_rate": change(F.col("period_revenue") - F.col("prev_period_revenue"), "prev_period_revenue"),
        "retention_classification": tier("retention_rate", V.RETENTION_CLASS),
        "revenue_classification": tier("revenue_retention_rate", V.REVENUE_CLASS),
        "predicted_ltv": F.col("ltv_at_period") * tier("period_number", V.LTV_MULTIPLIER),
        "cohort_quality_score": clamp(quality),
        "cohort_maturity": tier(month_diff("cohort_month", today), V.COHORT_AGE),
        "business_value_assessment": decide(V.COHORT_VALUE),
    }).withColumns({
        "optimization_recommendation": decide(V.COHORT_ADVICE),
        "strategic_classification": decide(V.COHORT_STRATEGY),
    })
    return df.withColumns({
        "cohort_analysis_key": surrogate_key(*cell),
        "investment_priority": decide(V.COHORT_INVESTMENT),
        "expected_outcome": map_values("optimization_recommendation", V.COHORT_OUTCOME, V.COHORT_OUTCOME_OTHER),
        "analysis_created_at": F.lit(p.as_of).cast("timestamp"),
    })
