"""Core sales tables: product dimension, order-item fact, daily sales, unified sales."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import mean, mean_over, safe_divide, year_month
from ..operators import ordered
from ..sources.staging import stage


def product_dimension(sales: DataFrame) -> DataFrame:
    return (
        sales.filter("product_sku is not null")
        .groupBy("product_sku", "product_category", "product_style", "product_asin")
        .agg(
            F.count_distinct("order_id").alias("total_orders_containing_product"),
            F.sum("quantity").alias("total_quantity_sold_across_all_orders"),
        )
    )


def order_items(sales: DataFrame, products: DataFrame, prices: DataFrame) -> DataFrame:
    """Order lines with product attributes and profit over trade price.

    Both dimensions are reduced to one row per SKU and joined to each other first, so no
    line is multiplied and the lines move once.
    """
    per_sku = products.groupBy("product_sku").agg(
        F.max("product_category").alias("product_category"), F.max("product_style").alias("product_style"),
    )
    cost = prices.groupBy("product_sku").agg(mean("cost_price_tp1").alias("unit_cost"))
    item = per_sku.join(cost, "product_sku", "left")
    lines = sales.filter("product_sku is not null").drop("product_category", "product_style")
    profit = F.col("amount").cast("double") - F.col("unit_cost") * F.col("quantity")
    return lines.join(item, "product_sku", "left").select(
        "order_id", "order_date", "order_status", "fulfillment_type", "is_b2b", "product_sku",
        "product_category", "product_style", "quantity", F.col("amount").alias("item_revenue_amount"),
        "currency", F.coalesce(profit, F.lit(0.0)).alias("item_profit_amount"), "_source_file_name",
    )


def daily_sales(items: DataFrame) -> DataFrame:
    return items.groupBy("order_date", "product_category", "fulfillment_type").agg(
        F.sum("item_revenue_amount").alias("daily_revenue"),
        F.sum("quantity").alias("daily_quantity_sold"),
        F.count_distinct("order_id").alias("daily_unique_orders"),
        F.sum("item_profit_amount").alias("daily_profit"),
    )


_UNIFIED = (
    "order_item_key", "order_id", "sales_channel", "order_date", "order_year", "order_month", "season", "sku",
    "product_category", "product_size", "customer_segment", "is_b2b", "city_tier", "order_amount", "quantity",
    "unit_price", "recognized_revenue", "estimated_gst_amount", "net_order_amount", "order_performance_score",
    "composite_performance_score", "shipping_city", "shipping_state", "shipping_country", "fulfillment_model",
    "order_status_category", "has_promotion",
)
# lines of one day follow these columns, so that every window has one possible result
TIE_BREAK = ("order_item_key", "order_amount", "quantity", "unit_price")
#: wide rows of a report that meet their results at a time, about, unless these are more slices than the second number
SLICE_ROWS, SLICES = 500_000, 4


def _dated(*more: str) -> list[ordered.By]:
    return ordered.by("order_date", *more)


def _one_shape(orders: DataFrame, international: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Marketplace and international lines in one shape; the id of international lines is NULL."""
    market = orders.filter("business_validation_status = 'VALID'").withColumn("sales_channel", F.lit("AMAZON"))
    abroad = international.filter("data_quality_flag = 'VALID'").withColumnsRenamed(
        {"gross_amount": "order_amount", "unit_rate": "unit_price"}
    )
    amount = F.col("order_amount")
    abroad = abroad.withColumns({
        "order_item_key": F.md5(F.concat_ws("-", "sku", F.col("order_date").cast("string"), "customer_name")),
        "order_id": F.lit(None).cast("string"),
        "is_b2b": F.lit(False),
        "recognized_revenue": amount,
        "estimated_gst_amount": F.round(amount * F.lit(V.GST_RATE).cast("decimal(3,2)"), 2),
        "net_order_amount": F.round(amount * F.lit(V.NET_RATE).cast("decimal(3,2)"), 2),
        "order_performance_score": F.lit(V.INTERNATIONAL_ORDER_SCORE),
        "composite_performance_score": F.lit(V.INTERNATIONAL_COMPOSITE),
        "has_promotion": F.lit(False),
        **{name: F.lit(text) for name, text in V.INTERNATIONAL_FIELDS.items()},
    })
    return market.select(*_UNIFIED), abroad.select(*_UNIFIED)


def _intl_id(number: str) -> Column:
    return F.concat(F.lit("INTL-"), F.col(number).cast("string"))


def union_sales(
    orders: DataFrame, international: DataFrame, order_ids: bool = True,
) -> DataFrame:
    """Marketplace and international lines in one shape.

    International lines get a running order number over the whole report.  Aggregates that
    do not look at order ids skip it with ``order_ids=False`` (the id is then NULL).
    """
    market, abroad = _one_shape(orders, international)
    if order_ids:
        abroad = stage(abroad, "international")
        abroad = ordered.row_numbers(abroad, [], _dated(*TIE_BREAK), "line_no", abroad.count())
        abroad = abroad.withColumn("order_id", _intl_id("line_no")).select(*_UNIFIED)
    return market.unionByName(abroad)


def unified_sales(orders: DataFrame, international: DataFrame) -> DataFrame:
    """Unified lines with lags, rolling values, sequences and ranks.

    Both reports are staged once with a row key.  Windows and ranks run over narrow rows (row key, order, the columns they read); their
    results meet each other by row key, and the wide rows meet them once.
    Large tables are kept small on disk: results are staged one after the other, and the wide rows meet them in slices.
    """
    market, abroad = _one_shape(orders, international)
    types = market.unionByName(abroad).dtypes
    market, abroad = (
        df.select(*[F.col(c).cast(kind) for c, kind in types]).withColumn("order_cohort", year_month("order_date")) for df in (market, abroad))
    parts = [ordered.with_row_key(market, "market"), ordered.with_row_key(abroad, "abroad", below_zero=True)]
    base = parts[0].unionByName(parts[1])
    key, rows = ordered.ROW_KEY, base.count()
    order, ordering = _dated(*TIE_BREAK, key), [key, "order_date", *TIE_BREAK]
    large = rows > ordered.PART_ROWS

    def kept(df: DataFrame, label: str) -> DataFrame:
        return stage(df, label) if large else df

    by_channel = kept(ordered.with_frames(
        base.select(*ordering, "sales_channel", "customer_segment"), ["sales_channel"], order,
        lambda w: {"rolling_30d_avg_order_value": mean_over("order_amount", w.rowsBetween(-29, 0))}, reach=29,
        counts={"customer_segment_order_count": ["customer_segment"]}, at_most=rows,
    ).select(key, "rolling_30d_avg_order_value", "customer_segment_order_count"), "by_channel")
    by_sku = kept(ordered.numbered_frames(
        base.select(*ordering, "sales_channel", "sku", "recognized_revenue"), ["sku"], ["sales_channel"], order, lambda w: {
            "prev_order_amount": F.lag("order_amount", 1).over(w),
            "rolling_7d_revenue": F.sum("recognized_revenue").over(w.rowsBetween(-6, 0)),
        }, reach=6, out="product_order_sequence", at_most=rows,
    ).select(key, "product_order_sequence", "prev_order_amount", "rolling_7d_revenue"), "by_sku")

    score, ranked = "composite_performance_score", base.select(
        key, "product_category", "sales_channel", "order_date", "composite_performance_score", "order_amount")
    ranks = ordered.row_ranks(ranked, ["sales_channel", "order_date"], "order_amount", "daily_order_rank", descending=True, at_most=rows)
    ranks = ordered.value_ranks(
        ranks, ["product_category"], score, descending=True, dense="category_performance_rank", source=ranked, at_most=rows)
    ranks = ordered.value_ranks(ranks, ["sales_channel"], score, percent="channel_performance_percentile", source=ranked, at_most=rows)
    ranks = kept(ranks.select(key, "category_performance_rank", "channel_performance_percentile", "daily_order_rank"), "ranks")

    numbers = kept(ordered.row_numbers(parts[1].select(*ordering), [], order, "line_no", rows).select(key, _intl_id("line_no").alias("order_id")), "numbers")
    seasonal = kept(base.groupBy("season", "product_category").agg(mean("order_amount").alias("seasonal_avg_order_value")), "seasonal")
    growth = safe_divide(F.col("order_amount") - F.col("prev_order_amount"), "prev_order_amount") * 100

    def finish(df: DataFrame) -> DataFrame:
        df = ordered.null_safe_join(df, seasonal, ["season", "product_category"], "left")
        return df.withColumn("order_value_growth_rate", F.round(growth, 2)).drop(key)

    # the number of an international line is a result too
    wide, results = [parts[0], parts[1].drop("order_id")], [by_channel, by_sku, ranks]
    if large:
        slices = min(SLICES, math.ceil(rows / 2 / SLICE_ROWS))
        return ordered.join_by_row_key([(wide[0], results), (wide[1], [*results, numbers])], "unified", finish, slices)
    found = wide[0].unionByName(wide[1].join(numbers, key))
    return finish(found.join(by_channel.join(by_sku, key).join(ranks, key), key))
