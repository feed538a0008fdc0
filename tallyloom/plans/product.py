"""Product intelligence: sales, cost and expense per SKU with classes and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import argmax_label, clamp, decide, map_values, mean, safe_divide, surrogate_key, tier
from ..operators.ordered import large_groups
from ..params import Params
from ..sources import staging
from ..sources.staging import spread, stage


_CHANNELS = {"amazon": "amazon", "merchant_website": "merchant", "international": "international"}


_TEXTS = ("product_category", "product_style", "product_asin")


def _figures() -> list[Column]:
    """Sums, means, extremes and line counts of a SKU."""
    channel, quarter = F.col("partner_channel"), F.col("quarter")

    def revenue_if(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("revenue")).otherwise(0))

    return [
        F.sum("quantity").alias("total_units_sold"),
        F.sum("revenue").alias("total_revenue"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"),
        *[revenue_if(channel == ch).alias(f"{name}_revenue") for ch, name in _CHANNELS.items()],
        *[F.count_if(F.col("order_value_tier") == t).alias(f"{t}_orders") for t in V.LINE_VALUE_LABELS],
        *[revenue_if(quarter == q).alias(f"q{q}_revenue") for q in (1, 2, 3, 4)],
        mean("revenue").alias("avg_order_value"),
        mean("quantity").alias("avg_units_per_order"),
        F.stddev_samp(F.col("revenue").cast("double")).alias("revenue_volatility"),
        mean("fulfilment_efficiency_score").alias("avg_fulfilment_score"),
        mean("estimated_processing_days").alias("avg_processing_days"),
    ]


def _met_by_sku(lines: DataFrame, rows: int) -> DataFrame:
    """One row per SKU of lines that meet in one exchange by SKU, with sets for the distinct counts."""
    segment, order = F.col("customer_segment"), F.col("order_id")
    marked = F.bool_or(segment.isNotNull() | order.isNull())

    def different(c: Column) -> Column:
        return F.size(F.collect_set(c)).cast("bigint")

    dealt = spread(lines.repartition("product_sku"), ["product_sku"], rows)
    return dealt.groupBy("product_sku").agg(
        *_figures(),
        different(order).alias("total_orders"),
        *[F.when(marked, different(F.when(segment == s, order))).alias(f"{s}_orders") for s in ("b2b", "b2c")],
        different(F.col("order_date")).alias("active_sales_days"),
        different(F.col("partner_channel")).alias("channel_presence"),
        *[F.max(c).alias(c) for c in _TEXTS],
    )


def _combined_by_sku(lines: DataFrame) -> DataFrame:
    """The same rows for SKUs of very many lines: four light aggregations that combine on the map side, so that no task
    gets all lines of a SKU."""
    figures = lines.groupBy("product_sku").agg(*_figures())
    # one row per SKU and order carries both segment marks; counting rows counts orders
    segment = F.col("customer_segment")
    orders = lines.groupBy("product_sku", "order_id").agg(
        F.max((segment == "b2b").cast("int")).alias("b2b"), F.max((segment == "b2c").cast("int")).alias("b2c"),
    ).groupBy("product_sku").agg(
        F.count("order_id").alias("total_orders"),
        F.sum(F.when(F.col("order_id").isNotNull(), F.col("b2b")).otherwise(0)).alias("b2b_orders"),
        F.sum(F.when(F.col("order_id").isNotNull(), F.col("b2c")).otherwise(0)).alias("b2c_orders"),
    )
    presence = lines.select("product_sku", "order_date", "partner_channel").distinct().groupBy("product_sku").agg(
        F.count_distinct("order_date").alias("active_sales_days"),
        F.count_distinct("partner_channel").alias("channel_presence"),
    )
    labels = lines.select("product_sku", *_TEXTS).distinct().groupBy("product_sku").agg(*[F.max(c).alias(c) for c in _TEXTS])
    return figures.join(orders, "product_sku").join(presence, "product_sku").join(labels, "product_sku")


def _sales_by_sku(base: DataFrame) -> DataFrame:
    """One row per SKU.

    The lines are staged narrow and meet in one exchange by SKU.  SKUs of more lines than a task should hold, found by a
    frequent-items sketch, are aggregated in parts instead; both ways give the same rows.
    """
    used = [
        "product_sku", "order_id", "order_date", "partner_channel", "customer_segment", *_TEXTS, "quantity", "revenue",
        "order_value_tier", "quarter", "fulfilment_efficiency_score", "estimated_processing_days",
    ]
    lines = stage(base.filter("product_sku is not null").select(*used), "sku_lines")
    rows = lines.count()
    large = large_groups(lines, ["product_sku"], rows, staging.TASK_ROWS)
    if large:
        many = F.xxhash64("product_sku").isin(large)
        found = _met_by_sku(lines.filter(~many), rows).unionByName(_combined_by_sku(lines.filter(many)))
    else:
        found = _met_by_sku(lines, rows)
    return found.withColumn("business_orders", F.col("b2b_orders"))  # the segment is the business flag


def _cost_by_sku(prices: DataFrame) -> DataFrame:
    df = prices.filter("cost_price_tp1 > 0").groupBy("product_sku").agg(
        mean("cost_price_tp1").alias("avg_cost_price"),
        mean("cost_price_tp2").alias("avg_cost_price_alt"),
        F.stddev_samp(F.col("cost_price_tp1").cast("double")).alias("cost_price_volatility"),
    )
    return df.withColumns({
        "cost_tier": tier("avg_cost_price", V.UNIT_COST),
        "cost_stability": tier(safe_divide("cost_price_volatility", "avg_cost_price"), V.COST_STABILITY),
    })


def _expense_by_sku(expenses: DataFrame) -> DataFrame:
    df = expenses.filter("expense_amount is not null").groupBy("product_sku").agg(
        F.sum("expense_amount").alias("total_allocated_expenses"),
        mean("expense_amount").alias("avg_expense_per_transaction"),
        F.count(F.lit(1)).alias("expense_transaction_count"),
    )
    return df.withColumn("expense_tier", tier("avg_expense_per_transaction", V.EXPENSE_TIER))


def product_intelligence(base: DataFrame, prices: DataFrame, expenses: DataFrame, p: Params) -> DataFrame:
    """All three inputs are reduced to one row per SKU before they meet, so the joins move
    only SKU rows and share one partitioning."""
    df = (
        _sales_by_sku(base)
        .join(_cost_by_sku(prices), "product_sku", "left")
        .join(_expense_by_sku(expenses), "product_sku", "left")
    )
    revenue = F.col("total_revenue").cast("double")
    units = F.col("total_units_sold").cast("double")
    df = df.withColumns({
        "product_lifespan_days": F.datediff("last_sale_date", "first_sale_date"),
        "silent_days": F.datediff(F.lit(p.as_of), "last_sale_date"),
        "unit_cost": F.coalesce("avg_cost_price", F.lit(0.0)),
        "unit_cost_alternative": F.coalesce("avg_cost_price_alt", "avg_cost_price", F.lit(0.0)),
        "cost_tier": F.coalesce("cost_tier", F.lit("unknown")),
        "cost_stability": F.coalesce("cost_stability", F.lit("unknown")),
        "total_allocated_expenses": F.coalesce(F.col("total_allocated_expenses").cast("double"), F.lit(0.0)),
        "avg_expense_per_transaction": F.coalesce("avg_expense_per_transaction", F.lit(0.0)),
        "expense_tier": F.coalesce("expense_tier", F.lit("unknown")),
    }).withColumn("gross_profit", revenue - F.col("unit_cost") * units).withColumn(
        "net_profit", F.col("gross_profit") - F.col("total_allocated_expenses")
    )

    def share(n: str | Column, d: str) -> Column:
        return F.when(F.col(d) > 0, safe_divide(n, d)).otherwise(0.0)

    quarters = [F.col(f"q{q}_revenue").cast("double") for q in (1, 2, 3, 4)]
    quarter_sum = F.col("q1_revenue") + F.col("q2_revenue") + F.col("q3_revenue") + F.col("q4_revenue")
    quarter_mean = quarter_sum.cast("double") / 4
    squares = sum((F.pow(q - quarter_mean, F.lit(2.0)) for q in quarters[1:]), F.pow(quarters[0] - quarter_mean, F.lit(2.0)))
    df = df.withColumns({
        "gross_margin_rate": share("gross_profit", "total_revenue"),
        "net_margin_rate": share("net_profit", "total_revenue"),
        "gross_profit_per_unit": share("gross_profit", "total_units_sold"),
        "daily_revenue_rate": share("total_revenue", "product_lifespan_days"),
        "daily_sales_velocity": share("total_units_sold", "product_lifespan_days"),
        "amazon_revenue_share": share("amazon_revenue", "total_revenue"),
        "merchant_revenue_share": share("merchant_revenue", "total_revenue"),
        "international_revenue_share": share("international_revenue", "total_revenue"),
        "b2b_order_rate": share("b2b_orders", "total_orders"),
        "business_order_rate": share("business_orders", "total_orders"),
        "seasonal_peak": argmax_label(V.QUARTER_PEAK, "no_clear_seasonality"),
        "seasonal_variability": F.when(quarter_sum > 0, F.try_divide(F.sqrt(squares), quarter_mean)).otherwise(0.0),
    }).withColumns({
        "margin_category": tier("gross_margin_rate", V.MARGIN_CATEGORY),
        "velocity_category": tier("daily_sales_velocity", V.VELOCITY),
        "revenue_tier": tier("total_revenue", V.PRODUCT_REVENUE),
        "channel_strategy": decide(V.CHANNEL_STRATEGY),
        "customer_focus": tier("b2b_order_rate", V.CUSTOMER_FOCUS),
        "seasonality_level": tier("seasonal_variability", V.SEASONALITY),
        "lifecycle_stage": decide(V.PRODUCT_LIFECYCLE),
    })

    def positive(col: str) -> Column:
        return F.greatest(F.col(col).cast("double"), F.lit(0.0))

    channels = F.col("channel_presence")
    score = (
        positive("gross_margin_rate") * 30
        + F.least(F.lit(25.0), positive("daily_sales_velocity") * 2.5)
        + F.least(F.lit(25.0), positive("total_revenue") / 2000)
        + F.when(channels >= 2, 10).otherwise(channels * 5)
        + F.when(F.col("lifecycle_stage").isin("growth", "stable"), 10).otherwise(0)
    )
    return df.withColumns({
        "product_intelligence_key": surrogate_key("product_sku"),
        "investment_recommendation": decide(V.PRODUCT_INVESTMENT),
        "marketing_strategy": decide(V.PRODUCT_MARKETING),
        "product_score": clamp(score),
        "strategic_classification": decide(V.PRODUCT_CLASS),
        "intelligence_updated_at": F.lit(p.as_of).cast("timestamp"),
    }).withColumn(
        "recommended_action", map_values("strategic_classification", V.PRODUCT_ACTION, V.PRODUCT_ACTION_OTHER)
    ).drop("silent_days", "avg_cost_price", "avg_cost_price_alt", "cost_price_volatility", "expense_transaction_count")
