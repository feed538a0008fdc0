"""Cleaning and rule tagging of the raw reports (one output row per keyed input row)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import (
    day_of_week0, decide, exact_ratio, map_values, margin_percent, pattern_map, row_hash, safe_decimal, safe_divide,
    safe_int, season_of, set_map, suffix_map, tier,
)
from ..params import Params


def with_audit(df: DataFrame, ingested_at: datetime, run_id: str) -> DataFrame:
    """A raw table with the time and the run of its load."""
    return df.withColumns({"ingested_at": F.lit(ingested_at).cast("timestamp"), "ingestion_run_id": F.lit(run_id)})


def _rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in names.items()])


def _calendar(df: DataFrame) -> DataFrame:
    d = F.col("order_date")
    return df.withColumns({
        "order_year": F.year(d), "order_month": F.month(d), "order_day": F.dayofmonth(d),
        "day_of_week": day_of_week0(d),
    }).withColumns({
        "season": season_of(F.col("order_month")),
        # an unknown date counts as a weekday
        "is_weekend": F.coalesce(F.col("day_of_week").isin(0, 6), F.lit(False)),
    })


def _unit_price(amount: str, units: str):
    return exact_ratio(amount, units)


def _amount_labels(bound, half):
    high, medium, low = V.ORDER_AMOUNT_LABELS
    return V.Bands(">", ((bound, high), (half, medium)), low)


def marketplace_orders(raw: DataFrame, p: Params) -> DataFrame:
    """Marketplace order lines: typed, flagged, with season, weekend and value segment."""
    df = _rename(raw, {
        "Order ID": "order_id", "SKU": "sku", "ASIN": "asin", "Style": "style_code", "Date": "order_date_text",
        "Status": "order_status", "Fulfilment": "fulfillment_type", "Sales Channel": "sales_channel",
        "ship-service-level": "shipping_service_level", "Courier Status": "courier_status",
        "Category": "product_category", "Size": "product_size", "currency": "currency_code",
        "Amount": "amount_text", "Qty": "quantity_text", "ship-city": "shipping_city",
        "ship-state": "shipping_state", "ship-postal-code": "shipping_postal_code",
        "ship-country": "shipping_country", "B2B": "b2b_text", "fulfilled-by": "fulfilled_by",
        "promotion-ids": "promotion_ids",
    }).filter("order_id is not null")
    df = df.withColumns({
        "order_date": F.col("order_date_text").try_cast("date"),
        "order_amount": safe_decimal("amount_text", 10, 2),
        "quantity": safe_int("quantity_text"),
        "is_b2b": F.col("b2b_text").try_cast("boolean"),
        "has_promotion": F.coalesce(F.col("promotion_ids") != "", F.lit(False)),
        "data_quality_flag": decide(V.ORDER_QUALITY),
        "row_hash": row_hash("order_id", "order_date_text", "amount_text", "order_status", "quantity_text"),
    })
    return _calendar(df).withColumns({
        "unit_price": _unit_price("order_amount", "quantity"),
        "order_status_category": map_values("order_status", V.ORDER_STATUS, "OTHER"),
        "order_value_segment": tier("order_amount", _amount_labels(p.high_value_order, p.high_value_order * 0.5)),
    }).drop("order_date_text", "amount_text", "quantity_text", "b2b_text")


def international_sales(raw: DataFrame) -> DataFrame:
    """International sales lines with buyer, category, size and profitability rules."""
    df = _rename(raw, {
        "SKU": "sku", "Style": "style_code", "CUSTOMER": "customer_name", "DATE": "order_date_text",
        "Months": "order_month_text", "Size": "product_size", "PCS": "quantity_text", "RATE": "rate_text",
        "GROSS AMT": "gross_amount_text",
    }).filter("sku is not null")
    df = df.withColumns({
        "order_date": F.col("order_date_text").try_cast("date"),
        "quantity": safe_int("quantity_text"),
        "unit_rate": safe_decimal("rate_text", 10, 2),
        "gross_amount": safe_decimal("gross_amount_text", 10, 2),
        "data_quality_flag": decide(V.INTERNATIONAL_QUALITY),
        "row_hash": row_hash("sku", "order_date_text", "gross_amount_text", "customer_name", "quantity_text"),
    })
    return _calendar(df).withColumns({
        "calculated_unit_price": _unit_price("gross_amount", "quantity"),
        "order_value_segment": tier("gross_amount", _amount_labels(1000, 500)),
        "customer_segment": pattern_map(F.col("customer_name"), V.CUSTOMER_PATTERNS, "STANDARD_CUSTOMER"),
        "product_category": pattern_map(F.col("sku"), V.SKU_PATTERNS, "UNISEX"),
        "standardized_size": map_values("product_size", V.SIZES, "OTHER"),
    }).withColumn("profitability_flag", decide(V.PROFITABILITY)).drop(
        "order_date_text", "quantity_text", "rate_text", "gross_amount_text"
    )


def stock_levels(raw: DataFrame) -> DataFrame:
    """Stock by SKU with level, risk, reorder advice, colour family and estimated value."""
    df = _rename(raw, {
        "SKU Code": "sku_code", "Design No.": "design_number", "Category": "product_category",
        "Size": "product_size", "Color": "product_color", "Stock": "stock_text",
    }).filter("sku_code is not null")
    return df.withColumns({
        "stock_quantity": safe_int("stock_text"),
        "data_quality_flag": decide(V.STOCK_QUALITY),
        "row_hash": row_hash("sku_code", "design_number", "stock_text", "product_category"),
    }).withColumns({
        "stock_level_category": decide(V.STOCK_LEVEL),
        "standardized_size": map_values("product_size", V.SIZES, "OTHER"),
        "color_family": set_map(F.lower("product_color"), V.COLOUR_FAMILIES, "OTHER_FAMILY"),
        "category_group": pattern_map(F.col("product_category"), V.CATEGORY_PATTERNS, "OTHER_CATEGORY"),
        "inventory_risk_level": decide(V.STOCK_RISK),
        "reorder_recommendation": decide(V.STOCK_REORDER),
        "estimated_stock_value": F.col("stock_quantity").cast("bigint") * V.STOCK_UNIT_VALUE,
        "demand_inference": decide(V.STOCK_DEMAND),
    }).drop("stock_text")


def price_catalog(raw: DataFrame) -> DataFrame:
    """Catalog with the spread of marketplace prices, margins and pricing advice."""
    headers = {m: f"{'Amazon FBA' if m == 'amazon_fba' else m.capitalize()} MRP" for m in V.MARKETPLACES}
    prices = [f"{m}_mrp" for m in V.MARKETPLACES]
    df = _rename(raw, {
        "Sku": "sku", "Style Id": "style_id", "Catalog": "catalog_name", "Category": "product_category",
        "Weight": "weight_text", "TP 1": "trade_price_1_text", "TP 2": "trade_price_2_text",
        "MRP Old": "mrp_old_text", "Final MRP Old": "final_mrp_old_text",
        **{headers[m]: f"{m}_mrp_text" for m in V.MARKETPLACES},
    }).filter("sku is not null")
    money = ["trade_price_1", "trade_price_2", "mrp_old", "final_mrp_old", *prices]
    df = df.withColumns({
        "weight_kg": safe_decimal("weight_text", 5, 2),
        **{c: safe_decimal(f"{c}_text", 10, 2) for c in money},
        "data_quality_flag": decide(V.CATALOG_QUALITY),
        "row_hash": row_hash("sku", "style_id", "trade_price_1_text", "amazon_mrp_text", "flipkart_mrp_text"),
    })
    total = sum((F.col(c) for c in prices[1:]), F.col(prices[0]))
    df = df.withColumns({
        "marketplace_prices": F.array(*prices),
        "min_marketplace_price": F.least(*prices),
        "max_marketplace_price": F.greatest(*prices),
        "avg_marketplace_price": total.cast("double") / 8.0,
        **{f"{m}_margin_percent": margin_percent(f"{m}_mrp", "trade_price_1") for m in V.MARGIN_MARKETPLACES},
        "product_classification": map_values("product_category", V.CATALOG_CLASS, "OTHER"),
        "size_from_sku": suffix_map(F.col("sku"), V.SIZE_SUFFIXES, "UNKNOWN"),
    }).withColumn(
        "price_spread",
        safe_divide(F.col("max_marketplace_price") - F.col("min_marketplace_price"), "min_marketplace_price"),
    )
    cheapest = F.lit(V.CHEAPEST_OTHER)
    for m in reversed(V.CHEAPEST_PRIORITY):
        cheapest = F.when(F.col(f"{m}_mrp") == F.col("min_marketplace_price"), m.upper()).otherwise(cheapest)
    return df.withColumns({
        "price_variance_category": decide(V.PRICE_VARIANCE),
        "most_competitive_marketplace": cheapest,
        "pricing_recommendation": decide(V.PRICING_ADVICE),
        "product_tier": tier("avg_marketplace_price", V.PRODUCT_TIER),
    }).drop("price_spread", "weight_text", *[f"{c}_text" for c in money])
