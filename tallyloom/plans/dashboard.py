"""Aggregates behind the dashboard pages (inputs: unified sales, customer analytics, catalog)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions import mean
from ..operators import ordered
from ..operators.reshape import pivot_table
from ..operators.series import moving_averages

# fixed values: columns and first day of the pages' inputs
SALES_FROM = date(2022, 1, 1)
SALES_COLUMNS = (
    "order_date", "sales_channel", "product_category", "customer_segment", "order_amount", "recognized_revenue",
    "quantity", "city_tier", "fulfillment_model", "order_performance_score", "seasonal_avg_order_value",
    "rolling_30d_avg_order_value",
)
CUSTOMER_COLUMNS = (
    "customer_id", "sales_channel", "customer_segment", "rfm_segment", "lifecycle_stage", "value_tier",
    "total_revenue", "total_orders", "predicted_clv_2year", "churn_probability", "days_since_last_order",
    "seasonal_preference", "city_tier",
)
PRODUCT_COLUMNS = (
    "sku", "product_category", "avg_marketplace_price", "min_marketplace_price", "max_marketplace_price",
    "amazon_margin_percent", "flipkart_margin_percent", "product_tier", "pricing_recommendation",
)


def _revenue():
    # a group without any known amount counts as 0
    return F.coalesce(F.sum("recognized_revenue"), F.lit(0))


def _daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("order_date").agg(_revenue().alias("recognized_revenue"))


def sales_page(unified: DataFrame, since: date = SALES_FROM) -> DataFrame:
    return unified.filter(F.col("order_date") >= F.lit(since)).select(*SALES_COLUMNS).orderBy(F.col("order_date").desc())


def customer_page(customers: DataFrame) -> DataFrame:
    return customers.select(*CUSTOMER_COLUMNS)


def product_page(catalog: DataFrame) -> DataFrame:
    return catalog.select(*PRODUCT_COLUMNS)


def kpi_totals(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, order lines, mean order amount and number of customers, in one row."""
    totals = sales.agg(
        _revenue().alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        mean("order_amount").alias("avg_order_value"),
    )
    return totals.withColumn("total_customers", customers.agg(F.count(F.lit(1))).scalar())


def daily_channel_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("order_date", "sales_channel").agg(_revenue().alias("revenue"))


def channel_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sales_channel").agg(
        _revenue().alias("revenue"), F.count("order_amount").alias("orders"),
    )


def category_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_category").agg(_revenue().alias("revenue"))


def category_channel_pivot(sales: DataFrame) -> DataFrame:
    return pivot_table(sales, ["product_category"], "sales_channel", "recognized_revenue", values=("AMAZON", "INTERNATIONAL"))


def monthly_pattern(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.month("order_date").alias("month")).agg(_revenue().alias("revenue"))


def weekday_pattern(sales: DataFrame) -> DataFrame:
    """Mean daily revenue by day of week, Monday = 0."""
    return _daily_revenue(sales).groupBy(F.weekday("order_date").alias("day_of_week")).agg(
        mean("recognized_revenue").alias("avg_daily_revenue")
    )


def fulfilment_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("fulfillment_model").agg(mean("order_performance_score").alias("avg_score"))


def city_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("city_tier").agg(_revenue().alias("revenue"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def clv_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(F.avg("predicted_clv_2year").alias("avg_clv"))


def churn_by_tier(customers: DataFrame) -> DataFrame:
    return customers.groupBy("value_tier").agg(F.avg("churn_probability").alias("avg_churn"))


def lifecycle_counts(customers: DataFrame) -> DataFrame:
    return customers.groupBy("sales_channel", "lifecycle_stage").agg(F.count(F.lit(1)).alias("customers"))


def price_by_tier(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("product_tier").agg(F.avg("avg_marketplace_price").alias("avg_price"))


def margin_quartiles(catalog: DataFrame) -> DataFrame:
    """Margins of two marketplaces in long form, reduced to box-plot quartiles."""
    margins = ["amazon_margin_percent", "flipkart_margin_percent"]
    long = catalog.select(*margins).unpivot([], margins, "variable", "value")
    wanted = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}
    return ordered.exact_percentiles(long, ["variable"], "value", wanted)


def revenue_moving_average(sales: DataFrame) -> DataFrame:
    return moving_averages(_daily_revenue(sales), "order_date", "recognized_revenue")
