"""Financial performance by SKU and day, and the daily financial summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import fixed_values as V
from ..functions import clamp, decide, mean, mean_over, safe_divide, surrogate_key, tier
from ..operators.ordered import null_safe_join
from ..params import Params
from ..sources.sinks import merge_rows
from ..sources.staging import spread, stage, unstage
from ..sources.versions import read_published, upsert_published


#: columns of the lines that financial performance reads, beside a cost column; callers that stage lines for it stage these
LINE_COLUMNS = (
    "partner_channel", "order_date", "product_category", "product_sku", "customer_segment", "order_id", "revenue", "quantity",
    "revenue_per_unit",
)


def financial_performance(base: DataFrame, cost: str | None = None, rows: int | None = None) -> DataFrame:
    """Revenue, profit and score per channel, day, category, SKU and segment.

    ``cost`` names an optional cost column of the lines; without one, gross profit equals
    revenue and the margin rate is 1.  ``rows`` is the number of lines, about, if known: a large table is dealt to more tasks.
    """
    keys = ["partner_channel", "order_date", "product_category", "product_sku", "customer_segment"]
    costs = F.sum(cost) if cost else F.lit(0)
    df = spread(base, keys, rows).groupBy(*keys).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(F.col("revenue_per_unit") * F.col("quantity")).alias("total_revenue_per_unit_calc"),
        F.avg("revenue_per_unit").alias("avg_revenue_per_unit"),
        costs.alias("total_cost"),
    )
    revenue = F.col("total_revenue").cast("double")
    df = df.withColumn("gross_profit", F.col("total_revenue") - F.col("total_cost")).withColumns({
        "gross_margin_rate": safe_divide("gross_profit", "total_revenue") if cost else F.lit(1.0),
        "gross_profit_per_unit": safe_divide("gross_profit", "total_units_sold"),
    })
    orders = F.col("total_orders")
    score = F.least(F.lit(20.0), revenue / 1000) + F.least(F.lit(10), orders)
    return df.drop("total_cost").withColumns({
        "financial_performance_key": surrogate_key(*keys),
        "profitability_tier": F.lit(V.PROFITABILITY_TIER),
        "revenue_size_tier": tier("total_revenue", V.REVENUE_SIZE),
        "performance_score": clamp(score),
        "margin_health_flag": F.lit(V.MARGIN_HEALTH),
        "channel_efficiency_flag": F.lit(V.CHANNEL_EFFICIENCY),
    })


GROUP = ["partner_channel", "product_category", "customer_segment"]
DAY_KEYS = ["order_date", *GROUP]
#: rows of a group that a summary row looks back over, at most
REACH = 365


def daily_finance(financial: DataFrame) -> DataFrame:
    """One row per day, channel, category and segment, without what depends on other days."""

    def count_of(col, label):
        return F.count_if(F.col(col) == label)

    df = financial.groupBy(*DAY_KEYS).agg(
        F.sum("total_revenue").alias("daily_revenue"),
        F.sum("total_units_sold").alias("daily_units_sold"),
        F.sum("total_orders").alias("daily_orders"),
        F.sum("gross_profit").alias("daily_gross_profit"),
        F.avg("performance_score").alias("daily_avg_performance_score"),
        count_of("profitability_tier", "highly_profitable").alias("highly_profitable_skus"),
        count_of("profitability_tier", "loss_making").alias("loss_making_skus"),
        count_of("margin_health_flag", "red_flag").alias("red_flag_skus"),
        count_of("channel_efficiency_flag", "efficient").alias("efficient_skus"),
        F.count(F.lit(1)).alias("total_skus"),
    )

    return df.withColumns({
        "daily_gross_margin_rate": _ratio("daily_gross_profit", "daily_revenue"),
        "daily_gross_profit_per_unit": _ratio("daily_gross_profit", "daily_units_sold"),
    })


def _ratio(n: str, d: str) -> Column:
    return F.when(F.col(d) > 0, safe_divide(n, d)).otherwise(0.0)


def financial_summary(financial: DataFrame, p: Params) -> DataFrame:
    """Daily summary per channel, category and segment with averages, growth, risk and priority."""
    return with_trends(daily_finance(financial), p)


def with_trends(daily: DataFrame, p: Params) -> DataFrame:
    """Daily rows with averages and growth over at most REACH earlier rows of their group, risk and priority."""
    # at most one row per calendar day in each group
    by_day = Window.partitionBy(*GROUP).orderBy("order_date")
    week = by_day.rowsBetween(-6, 0)
    df = daily.withColumns({
        "revenue_7_day_ma": mean_over("daily_revenue", week),
        "gross_margin_7_day_ma": mean_over("daily_gross_margin_rate", week),
        "prev_day_revenue": F.lag("daily_revenue", 1).over(by_day),
        "prev_day_gross_profit": F.lag("daily_gross_profit", 1).over(by_day),
        "revenue_30_days_ago": F.lag("daily_revenue", 30).over(by_day),
        "revenue_1_year_ago": F.lag("daily_revenue", REACH).over(by_day),
    })

    def growth(now, before):
        return F.when(F.col(before) > 0, safe_divide(F.col(now) - F.col(before), before))

    target = p.revenue_target_monthly / 30
    df = df.withColumns({
        "daily_revenue_growth_rate": growth("daily_revenue", "prev_day_revenue"),
        "daily_gross_profit_growth_rate": growth("daily_gross_profit", "prev_day_gross_profit"),
        "revenue_growth_30d": growth("daily_revenue", "revenue_30_days_ago"),
        "revenue_growth_yoy": growth("daily_revenue", "revenue_1_year_ago"),
        "revenue_trend_indicator": decide(V.REVENUE_TREND),
        "margin_trend_indicator": decide(V.MARGIN_TREND),
        "performance_classification": tier("daily_avg_performance_score", V.PERFORMANCE_CLASS),
        **{
            f"{n}_sku_rate": _ratio(f"{n}_skus", "total_skus")
            for n in ("highly_profitable", "loss_making", "red_flag", "efficient")
        },
        "daily_target_status": tier(
            "daily_revenue", V.Bands(">=", ((target, "on_target"), (target * 0.8, "near_target")), "below_target")
        ),
    }).withColumns({
        "financial_risk_level": tier("red_flag_sku_rate", V.RED_FLAG_RISK),
        "channel_efficiency_level": tier("efficient_sku_rate", V.EFFICIENCY_LEVEL),
    })
    growing = F.col("revenue_trend_indicator").isin("strong_growth", "moderate_growth")
    priority = (
        F.col("daily_revenue").cast("double") / F.lit(target) * 30
        + F.col("daily_gross_margin_rate") * 25
        + F.col("efficient_sku_rate") * 20
        + F.when(growing, 25).otherwise(0)
    )
    return df.withColumns({
        "financial_summary_key": surrogate_key(*DAY_KEYS),
        "executive_alert_level": decide(V.EXECUTIVE_ALERT),
        "recommended_action": decide(V.FINANCE_ACTION),
        "priority_score": clamp(priority),
        "summary_created_at": F.lit(p.as_of).cast("timestamp"),
    })


def save_financial_summary(spark: SparkSession, summary: DataFrame, path: str) -> None:
    """Upsert summary rows by key into the published table of order months; the latest created row of a key wins."""
    rows = summary.withColumn("order_month", _month())
    upsert_published(spark, path, rows, ["financial_summary_key"], "order_month", "summary_created_at")


def _month() -> Column:
    return F.date_format("order_date", "yyyy-MM")


def reached_months(stored: DataFrame, changed: DataFrame, reach: int) -> list[str]:
    """Order months with a row at most ``reach`` rows of its group before or after a changed row.

    Reads the group and month of stored rows only.  Rows that are new lie between the others, so counts of stored rows reach too far
    rather than too short.
    """
    held = stored.select(*GROUP, "order_month").groupBy(*GROUP, "order_month").agg(F.count(F.lit(1)).alias("n"))
    hit = changed.select(*GROUP, _month().alias("order_month")).distinct()
    months = held.withColumn("hit", F.lit(False)).unionByName(hit.withColumns({"n": F.lit(0).cast("bigint"), "hit": F.lit(True)}))
    months = months.groupBy(*GROUP, "order_month").agg(F.sum("n").alias("n"), F.max("hit").alias("hit"))
    in_order = Window.partitionBy(*GROUP).orderBy("order_month")
    upto = months.withColumn("upto", F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = upto.withColumns({
        "next": F.min(F.when(F.col("hit"), F.col("upto") - F.col("n"))).over(in_order.rowsBetween(0, Window.unboundedFollowing)),
        "last": F.max(F.when(F.col("hit"), F.col("upto"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    near = (F.col("next") - F.col("upto") < reach) | (F.col("upto") - F.col("n") - F.col("last") < reach)
    return sorted(r[0] for r in ends.filter(near).select("order_month").distinct().collect())


def refresh_financial_summary(
    spark: SparkSession, path: str, lines: DataFrame, changed: Sequence[date], p: Params, cost: str | None = None,
) -> list[str]:
    """Bring the published summary up to date after lines of the ``changed`` days arrived or were corrected.

    Only lines of those days are aggregated, and only months are read that the rolling windows of those days reach; of
    their rows those that look back on a changed row are computed again and upserted.  Returns the
    months read.  Lines are never deleted whole days at a time: a day without lines keeps its rows.
    """
    days = lines.filter(F.col("order_date").isin(list(changed)))
    fresh = stage(daily_finance(financial_performance(days, cost)), "fresh_days")
    stored = read_published(spark, path).withColumn("order_month", F.col("order_month").cast("string"))
    months = reached_months(stored, fresh, REACH)
    old = stored.filter(F.col("order_month").isin(months)).select(*fresh.columns)
    touched = fresh.select(*GROUP).distinct().withColumn("touched", F.lit(True))
    old = null_safe_join(old, touched, GROUP).drop("touched")
    rows = merge_rows(old.withColumn("changed", F.lit(0)), fresh.withColumn("changed", F.lit(1)), DAY_KEYS)
    back = Window.partitionBy(*GROUP).orderBy("order_date").rowsBetween(-REACH, 0)
    rows = rows.withColumn("affected", F.max("changed").over(back))
    save_financial_summary(spark, with_trends(rows, p).filter("affected = 1").drop("changed", "affected"), path)
    unstage(fresh)
    return months
