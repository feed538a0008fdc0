"""Staged tables: scored marketplace orders, simple report stagings and channel unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import (
    day_of_week0, decide, map_values, parse_month_first, safe_decimal, safe_divide, safe_int, set_map, surrogate_key,
    tier, year_month,
)
from ..params import Params


def _points(col: str, table) -> Column:
    rest = next(points for label, points in table if label is None)
    return map_values(col, {label: points for label, points in table if label is not None}, rest)


def staged_orders(orders: DataFrame, p: Params) -> DataFrame:
    """Valid marketplace lines with tax split, performance scores, segment and city tier."""
    score = reduce(
        lambda c, row: c.when(F.expr(row[1]), row[0]), V.ORDER_SCORE[1:],
        F.when(F.expr(V.ORDER_SCORE[0][1]), V.ORDER_SCORE[0][0]),
    ).otherwise(V.ORDER_SCORE_OTHER)
    df = orders.filter("data_quality_flag = 'VALID'").withColumns({
        "estimated_gst_amount": F.round(F.col("order_amount") * F.lit(V.GST_RATE).cast("decimal(3,2)"), 2),
        "net_order_amount": F.round(F.col("order_amount") * F.lit(V.NET_RATE).cast("decimal(3,2)"), 2),
        "order_performance_score": score,
        "customer_segment": decide(V.BUYER_SEGMENT),
        "fulfillment_model": map_values("fulfillment_type", V.FULFILMENT_MODEL, "OTHER"),
        "city_tier": set_map(F.upper("shipping_city"), V.CITY_TIERS, "TIER_3"),
        "shipping_speed_category": map_values("shipping_service_level", V.SHIPPING_SPEED, "SLOW"),
        "order_item_key": F.md5(F.concat_ws("", "order_id", F.lit("-"), "sku")),
        "order_cohort": year_month("order_date"),
        "days_since_order": F.datediff(F.lit(p.as_of), "order_date"),
        "as_of": F.lit(p.as_of),
    })
    # whole-number weights keep the weighted sum exact, so half points round the same everywhere
    w_order, w_model, w_city = (round(10 * w) for w in V.COMPOSITE_WEIGHTS)
    weighted = (
        F.col("order_performance_score") * w_order
        + _points("fulfillment_model", V.FULFILMENT_POINTS) * w_model
        + _points("city_tier", V.CITY_POINTS) * w_city
    )
    zero = F.lit(0).cast("decimal(10,2)")
    return df.withColumns({
        "composite_performance_score": F.round(weighted / 10.0, 0).cast("int"),
        "recognized_revenue": F.when(
            F.col("order_status_category") == "DELIVERED", F.col("order_amount")
        ).otherwise(zero),
        "business_validation_status": decide(V.ORDER_VALIDATION),
    }).drop("as_of")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _clean(name: str) -> Column:
    return F.trim(F.lower(F.col(f"`{name}`")))


def stage_stock_report(raw: DataFrame) -> DataFrame:
    """Stock report in the shape of an order line (no date, amount or status known)."""
    return raw.filter("`SKU Code` is not null").select(
        F.md5(F.concat("`SKU Code`", "`Design No.`")).alias("order_item_id"),
        F.col("`SKU Code`").alias("order_id"),
        _null("date").alias("order_date"),
        _null("string").alias("order_status"),
        _null("string").alias("fulfilment_method"),
        _clean("Category").alias("product_category"),
        _null("string").alias("product_style"),
        _clean("SKU Code").alias("product_sku"),
        _clean("Design No.").alias("product_asin"),
        safe_int("Stock").alias("quantity"),
        _null("decimal(10,2)").alias("amount"),
        _null("string").alias("currency"),
        F.lit(False).alias("is_b2b_sale"),
        F.lit("sale_report").alias("_source_file_name"),
    )


def stage_international_report(raw: DataFrame) -> DataFrame:
    """International report in the shape of an order line; dates are month-day-year texts."""
    key = F.md5(F.concat("SKU", "DATE"))
    amount = F.col("`GROSS AMT`")
    return raw.filter(F.col("SKU").isNotNull() & safe_decimal("`GROSS AMT`", 18, 3).isNotNull()).select(
        key.alias("order_item_id"),
        key.alias("order_id"),
        parse_month_first("DATE").alias("order_date"),
        _null("string").alias("order_status"),
        _null("string").alias("fulfilment_method"),
        _null("string").alias("product_category"),
        _clean("SKU").alias("product_sku"),
        _null("string").alias("product_style"),
        _null("string").alias("product_asin"),
        safe_int("PCS").alias("quantity"),
        amount.try_cast("decimal(10,2)").alias("amount"),
        _null("string").alias("currency"),
        F.lit(False).alias("is_b2b_sale"),
        F.lit("international_sale_report").alias("_source_file_name"),
    )


def stage_price_list(raw: DataFrame) -> DataFrame:
    return raw.filter("Sku is not null").select(
        _clean("Sku").alias("product_sku"),
        _clean("Category").alias("product_category"),
        safe_decimal("`TP 1`", 10, 2).alias("cost_price_tp1"),
        safe_decimal("`TP 2`", 10, 2).alias("cost_price_tp2"),
        safe_decimal("`Final MRP Old`", 10, 2).alias("final_mrp_old"),
        F.lit("pl_march_2021").alias("_source_file_name"),
    )


def stage_expenses(raw: DataFrame) -> DataFrame:
    """Expense lines with a parseable amount; title and header lines fail that test."""
    return raw.filter(safe_decimal("column4", 18, 3).isNotNull()).select(
        parse_month_first("column1").alias("expense_date"),
        _clean("column2").alias("product_sku"),
        _clean("column3").alias("expense_description"),
        safe_decimal("column4", 10, 2).alias("expense_amount"),
        F.lit("expense_iigf").alias("_source_file_name"),
    )


_ALL_SALES = (
    "order_item_key", "order_id", "order_date", "order_status", "fulfillment_type", "product_category",
    "product_style", "product_sku", "product_asin", "quantity", "amount", "currency", "is_b2b", "_source_file_name",
)


def all_sales(orders: DataFrame, stock: DataFrame) -> DataFrame:
    """Order lines of the marketplace and of the stock report, columns aligned."""
    left = orders.withColumnsRenamed({
        "style_code": "product_style", "sku": "product_sku", "asin": "product_asin",
        "order_amount": "amount", "currency_code": "currency",
    }).withColumn("_source_file_name", F.lit("amazon_sales"))
    right = stock.withColumnsRenamed({
        "order_item_id": "order_item_key", "fulfilment_method": "fulfillment_type", "is_b2b_sale": "is_b2b",
    })
    return left.select(*_ALL_SALES).unionByName(right.select(*_ALL_SALES))


_LINE = (
    "partner_channel", "order_id", "order_date", "order_status", "fulfillment_type", "product_category",
    "product_sku", "product_style", "product_asin", "quantity", "revenue", "currency", "is_b2b", "_source_file_name",
)


def channel_lines(orders: DataFrame, stock: DataFrame, international: DataFrame) -> DataFrame:
    """Sales lines of the three channels from their staged reports."""
    def report(df: DataFrame, channel: str) -> DataFrame:
        df = df.withColumnsRenamed({
            "fulfilment_method": "fulfillment_type", "amount": "revenue", "is_b2b_sale": "is_b2b",
        })
        return df.withColumn("partner_channel", F.lit(channel)).select(*_LINE)

    market = orders.withColumnsRenamed({
        "sku": "product_sku", "style_code": "product_style", "asin": "product_asin",
        "order_amount": "revenue", "currency_code": "currency",
    }).withColumns({"partner_channel": F.lit("amazon"), "_source_file_name": F.lit("amazon_sales")}).select(*_LINE)
    amazon, merchant, abroad = V.CHANNELS
    return market.unionByName(report(stock, merchant)).unionByName(report(international, abroad))


def partner_base(lines: DataFrame, p: Params) -> DataFrame:
    """Valid sales lines of all channels with tiers, scores and calendar parts.

    A line without a date (the stock report has none) does not pass the date floor.
    Columns of ``lines`` beyond the standard ones are kept.
    """
    high, medium, low = V.LINE_VALUE_LABELS
    value = V.Bands(">=", ((p.high_value_order, high), (V.MEDIUM_VALUE_LINE, medium)), low)
    dow = day_of_week0("order_date")
    df = lines.withColumn("product_category", F.coalesce("product_category", F.lit("Unknown")))
    df = df.withColumn("data_quality_flag", decide(V.LINE_QUALITY)).filter(
        (F.col("data_quality_flag") == "valid") & (F.col("order_date") >= F.lit(p.min_date))
    )
    return df.withColumns({
        "partner_performance_key": surrogate_key("partner_channel", "order_id", "product_sku"),
        "order_value_tier": tier("revenue", value),
        "customer_segment": F.when(F.col("is_b2b"), "b2b").otherwise("b2c"),
        # status and fulfilment texts differ in case between reports
        "fulfilment_efficiency_score": map_values(F.lower("fulfillment_type"), V.EFFICIENCY_POINTS, V.EFFICIENCY_OTHER),
        "estimated_processing_days": map_values(F.lower("order_status"), V.PROCESSING_DAYS, V.PROCESSING_OTHER),
        "revenue_per_unit": F.when(F.col("quantity") > 0, safe_divide("revenue", "quantity")).otherwise(0.0),
        "quarter": F.quarter("order_date"),
        "month": F.month("order_date"),
        "day_of_week": dow,
        "is_business_day": ~dow.isin(0, 6),
        "channel_group": F.when(
            F.col("partner_channel").isin(*V.PRIMARY_CHANNELS), "primary_channels"
        ).otherwise("secondary_channels"),
    })


__all__ = [
    "all_sales", "channel_lines", "partner_base", "stage_expenses", "stage_international_report",
    "stage_price_list", "stage_stock_report", "staged_orders",
]
