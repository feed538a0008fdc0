"""Partner tables: daily metrics, dashboard, optimisation insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as V
from ..functions import clamp, decide, map_values, mean, mean_over, safe_divide, surrogate_key, tier
from ..operators import ordered
from ..params import Params
from ..sources.staging import spread, stage


_DAY = ("partner_channel", "order_date", "channel_group", "customer_segment", "quarter", "month", "day_of_week", "is_business_day")
_COUNTED = {"order_id": "daily_orders", "product_sku": "daily_unique_products"}
#: columns of the lines that daily metrics read; callers that stage lines for them stage these
LINE_COLUMNS = (
    *_DAY, *_COUNTED, "quantity", "revenue", "revenue_per_unit", "fulfilment_efficiency_score", "estimated_processing_days",
    "data_quality_flag", "order_value_tier",
)


def daily_partner_metrics(base: DataFrame, recent_only: Params | None = None, staged: bool = False) -> DataFrame:
    """One row per channel, day and segment, with rolling averages and trend.

    The windows run on this daily grain (at most one row per day and group), never on
    sales lines.  ``recent_only`` keeps the look-back days only; the dashboard needs all.
    Each distinct count reads its item and the day alone and meets in tasks of a bounded number of rows; both in one aggregation with
    the figures would copy every line into the session's partitions.  ``staged`` says that the lines are a staged table; of other
    lines these few columns are staged here, and the figures read the lines themselves.
    """
    day, counted = list(_DAY), _COUNTED
    items = base.select(*day, *counted)
    items = items if staged else stage(items, "day_items")
    rows = items.count()

    def different(item: str) -> DataFrame:
        both = [*day, item]
        return spread(items.select(*both), both, rows).distinct().groupBy(*day).agg(F.count(item).alias(counted[item]))

    def value_lines(label):
        return F.count_if(F.col("order_value_tier") == label)

    high, medium, low = V.LINE_VALUE_LABELS
    daily = base.groupBy(*day).agg(
        F.sum("quantity").alias("daily_units_sold"),
        F.sum("revenue").alias("daily_revenue"),
        mean("revenue").alias("daily_avg_order_value"),
        F.sum(F.col("revenue_per_unit") * F.col("quantity")).alias("daily_revenue_per_unit"),
        mean("fulfilment_efficiency_score").alias("avg_fulfilment_efficiency"),
        mean("estimated_processing_days").alias("avg_processing_days"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("data_quality_flag") == "valid").alias("valid_records"),
        value_lines(high).alias("high_value_orders"),
        value_lines(medium).alias("medium_value_orders"),
        value_lines(low).alias("low_value_orders"),
    )
    for item in counted:
        daily = ordered.null_safe_join(daily, different(item), day)
    first = ("daily_orders", "daily_units_sold", "daily_unique_products")
    daily = daily.select(*day, *first, *[c for c in daily.columns if c not in (*day, *first)])
    names = dict(enumerate(V.DAY_NAMES))
    multiplier = F.when(F.col("is_business_day"), V.WEEKDAY_MULTIPLIER).otherwise(V.WEEKEND_MULTIPLIER)
    by_day = Window.partitionBy("partner_channel", "customer_segment").orderBy("order_date")
    df = daily.withColumn("business_day_multiplier", multiplier).withColumns({
        "daily_metrics_key": surrogate_key("partner_channel", "order_date", "customer_segment"),
        "data_quality_score": safe_divide("valid_records", "total_records"),
        "business_day_adjusted_revenue": F.col("daily_revenue").cast("double") * F.col("business_day_multiplier"),
        "revenue_per_order": safe_divide("daily_revenue", "daily_orders"),
        "units_per_order": safe_divide("daily_units_sold", "daily_orders"),
        "volume_tier": tier("daily_orders", V.DAILY_VOLUME),
        "high_value_order_rate": safe_divide("high_value_orders", "daily_orders"),
        "day_name": map_values("day_of_week", names),
        "previous_day_revenue": F.lag("daily_revenue", 1).over(by_day),
        "rolling_7_day_avg_revenue": mean_over("daily_revenue", by_day.rowsBetween(-6, 0)),
        "rolling_30_day_avg_orders": mean_over("daily_orders", by_day.rowsBetween(-29, 0)),
    }).drop("is_business_day")
    prev, avg7 = F.col("previous_day_revenue"), F.col("rolling_7_day_avg_revenue")
    df = df.withColumns({
        "daily_revenue_growth_rate": F.when(prev > 0, safe_divide(F.col("daily_revenue") - prev, prev)),
        "performance_vs_7_day_avg": F.when(avg7 > 0, safe_divide("daily_revenue", avg7)).otherwise(1.0),
        "revenue_trend_indicator": decide(V.DAILY_TREND),
    })
    if recent_only:
        p = recent_only
        df = df.filter(F.col("order_date") >= F.date_sub(F.lit(p.as_of), p.partner_lookback_days))
    return df


def partner_dashboard(daily: DataFrame, financial: DataFrame, p: Params) -> DataFrame:
    """KPIs per channel and segment for the last 30 days, the 30 before, quarter and year to date."""
    today = F.lit(p.as_of)
    d = F.col("order_date")
    days = p.partner_lookback_days
    recent = d >= F.date_sub(today, days)
    windows = {
        "30d": recent,
        "30d_prev": d.between(F.date_sub(today, 2 * days), F.date_sub(today, days + 1)),
        "qtd": (F.year(d) == F.year(today)) & (F.quarter(d) == F.quarter(today)),
        "ytd": F.year(d) == F.year(today),
    }

    def total(col, when):
        return F.sum(F.when(when, F.col(col)).otherwise(0))

    def recent_avg(col):
        return F.avg(F.when(recent, F.col(col)))

    summary = daily.groupBy("partner_channel", "channel_group", "customer_segment").agg(
        *[total("daily_revenue", w).alias(f"revenue_{n}") for n, w in windows.items()],
        *[total("daily_orders", w).alias(f"orders_{n}") for n, w in windows.items()],
        total("daily_units_sold", recent).alias("units_30d"),
        recent_avg("daily_avg_order_value").alias("avg_order_value_30d"),
        recent_avg("avg_fulfilment_efficiency").alias("avg_fulfilment_efficiency_30d"),
        recent_avg("data_quality_score").alias("avg_data_quality_30d"),
        F.count_if(recent & (F.col("revenue_trend_indicator") == "above_trend")).alias("above_trend_days"),
        F.count_if(recent & (F.col("revenue_trend_indicator") == "below_trend")).alias("below_trend_days"),
        recent_avg("high_value_order_rate").alias("high_value_order_rate_30d"),
        recent_avg("avg_processing_days").alias("avg_processing_days_30d"),
    )
    # only recent days contribute here, so the filter can go below the aggregation
    fresh = financial.filter(recent)
    keys = ["partner_channel", "customer_segment"]
    # per tier first: a few rows per channel and segment give sums, means and the most frequent tier
    means = {
        "gross_margin_rate": "avg_gross_margin_30d", "gross_profit_per_unit": "avg_gross_profit_per_unit_30d",
        "performance_score": "avg_performance_score_30d",
    }
    tiers = fresh.groupBy(*keys, "profitability_tier").agg(
        F.sum("gross_profit").alias("gross_profit"), F.count(F.lit(1)).alias("n"),
        *[f(F.col(c).cast("double")).alias(f"{f.__name__}_{c}") for c in means for f in (F.sum, F.count)],
        F.count_if(F.col("margin_health_flag") == "red_flag").alias("red_flag_days"),
        F.count_if(F.col("channel_efficiency_flag") == "efficient").alias("efficient_days"),
    )
    known = F.when(F.col("profitability_tier").isNotNull(), F.struct(-F.col("n"), "profitability_tier"))
    profit = tiers.groupBy(*keys).agg(
        F.sum("gross_profit").alias("gross_profit_30d"),
        *[F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}")).alias(out) for c, out in means.items()],
        F.sum("red_flag_days").alias("red_flag_days"), F.sum("efficient_days").alias("efficient_days"),
        F.min_by("profitability_tier", known).alias("dominant_profitability_tier"),
    )
    df = summary.join(profit, keys, "left")
    zero_filled = (
        "gross_profit_30d", "avg_gross_margin_30d", "avg_gross_profit_per_unit_30d",
        "avg_performance_score_30d", "red_flag_days", "efficient_days",
    )
    target = p.revenue_target_monthly
    df = df.withColumns({
        **{c: F.coalesce(c, F.lit(0)) for c in zero_filled},
        "dominant_profitability_tier": F.coalesce("dominant_profitability_tier", F.lit("unknown")),
    }).withColumns({
        "revenue_growth_30d": F.when(
            F.col("revenue_30d_prev") > 0,
            safe_divide(F.col("revenue_30d") - F.col("revenue_30d_prev"), "revenue_30d_prev"),
        ),
        "order_growth_30d": F.when(
            F.col("orders_30d_prev") > 0,
            safe_divide(F.col("orders_30d") - F.col("orders_30d_prev"), "orders_30d_prev"),
        ),
        "overall_trend_direction": decide(V.TREND_DIRECTION),
        "monthly_target_status": tier(
            "revenue_30d", V.Bands(">=", ((target, "achieved"), (target * 0.8, "near_target")), "below_target")
        ),
        "efficiency_rating": tier("efficient_days", V.EFFICIENT_DAYS),
    })

    def positive(col):
        return F.greatest(F.coalesce(F.col(col).cast("double"), F.lit(0.0)), F.lit(0.0))

    health = (
        F.least(F.lit(25.0), positive("revenue_30d") / F.lit(float(target)) * 25)
        + positive("avg_gross_margin_30d") * 25
        + positive("avg_data_quality_30d") * 25
        + positive("avg_fulfilment_efficiency_30d") / 100 * 25
    )
    df = df.withColumn("overall_health_score", clamp(health)).withColumns({
        "dashboard_key": surrogate_key(*keys),
        "recommended_action": tier("overall_health_score", V.HEALTH_ACTION),
        "dashboard_updated_at": F.lit(p.as_of).cast("timestamp"),
    })
    # one row per channel and segment: a handful of rows, so a single-task rank is right
    by_health = Window.orderBy(
        F.col("overall_health_score").desc(), F.col("revenue_30d").desc(), "partner_channel", "customer_segment",
    )
    return df.withColumn("partner_priority_rank", F.row_number().over(by_health))


_CARRIED = (
    "partner_channel", "customer_segment", "revenue_30d", "orders_30d", "avg_order_value_30d", "gross_profit_30d",
    "avg_gross_margin_30d", "revenue_growth_30d", "order_growth_30d", "avg_fulfilment_efficiency_30d",
    "avg_data_quality_30d", "avg_processing_days_30d", "overall_trend_direction", "overall_health_score",
    "efficiency_rating", "monthly_target_status", "partner_priority_rank", "high_value_order_rate_30d",
    "red_flag_days", "efficient_days",
)


def partner_optimization(dashboard: DataFrame, p: Params) -> DataFrame:
    """Benchmarks within the segment, gaps and upsides, classes and recommendations."""
    measures = {
        "revenue": "revenue_30d", "orders": "orders_30d", "aov": "avg_order_value_30d",
        "margin": "avg_gross_margin_30d", "efficiency": "avg_fulfilment_efficiency_30d",
        "health": "overall_health_score",
    }
    names = {m: ("avg_health_score_benchmark" if m == "health" else f"avg_{m}_benchmark") for m in measures}
    ranked = ("revenue", "aov", "margin", "health")

    def x(m):
        return F.col(measures[m]).cast("double")

    base = dashboard.select(*_CARRIED)
    bench = base.groupBy("customer_segment").agg(
        *[F.avg(x(m)).alias(names[m]) for m in measures],
        # a segment has one row per channel, so an in-memory percentile is small
        *[F.percentile(x(m), F.lit(0.75)).alias(f"top_{m}_benchmark") for m in ranked],
        *[F.percentile(x(m), F.lit(0.25)).alias(f"low_{m}_threshold") for m in ranked if m != "aov"],
    )
    df = base.join(bench, "customer_segment", "left")

    def rank_of(m):
        w = Window.partitionBy("customer_segment").orderBy(F.col(measures[m]).asc_nulls_last())
        return F.percent_rank().over(w)

    def opportunity(m):
        labels = V.OPPORTUNITY_LABELS
        bounds = (f"low_{m}_threshold", names[m], f"top_{m}_benchmark")
        chain = F.lit(labels[3])
        for bound, label in reversed(list(zip(bounds, labels))):
            chain = F.when(x(m) < F.col(bound), label).otherwise(chain)
        return chain

    df = df.withColumns({
        **{f"{m}_gap_vs_avg": x(m) - F.col(names[m]) for m in ranked},
        **{f"{m}_upside_potential": F.col(f"top_{m}_benchmark") - x(m) for m in ranked},
        **{f"{m}_percentile": rank_of(m) for m in ranked},
        **{f"{m}_opportunity_level": opportunity(m) for m in ("revenue", "margin", "health")},
    })
    df = df.withColumns({
        "strategic_classification": decide(V.PARTNER_CLASS),
        "investment_priority": decide(V.PARTNER_INVESTMENT),
        "primary_optimization_focus": decide(V.OPTIMISATION_FOCUS),
        "expected_impact": tier("revenue_upside_potential", V.PARTNER_IMPACT),
    }).withColumns({
        "specific_recommendation": decide(V.PARTNER_RECOMMENDATION),
        "implementation_complexity": map_values("primary_optimization_focus", V.FOCUS_COMPLEXITY, V.FOCUS_COMPLEXITY_OTHER),
        "resource_requirements": map_values("investment_priority", V.INVESTMENT_RESOURCES, V.INVESTMENT_RESOURCES_OTHER),
        "success_metrics": map_values("primary_optimization_focus", V.FOCUS_SUCCESS, V.FOCUS_SUCCESS_OTHER),
        "risk_level": decide(V.PARTNER_RISK),
    })
    points = (
        map_values("expected_impact", *V.IMPACT_POINTS)
        + map_values("implementation_complexity", *V.COMPLEXITY_POINTS)
        + map_values("strategic_classification", *V.CLASS_POINTS)
        + map_values("risk_level", *V.RISK_POINTS)
    )
    return df.withColumns({
        "optimization_key": surrogate_key("partner_channel", "customer_segment"),
        "implementation_timeline": decide(V.PARTNER_TIMELINE),
        "optimization_priority_score": clamp(points, 0, 100),
        "executive_summary": decide(V.EXECUTIVE_TEXT),
        "business_insight": decide(V.INSIGHT_TEXT),
        "insights_generated_at": F.lit(p.as_of).cast("timestamp"),
    })
