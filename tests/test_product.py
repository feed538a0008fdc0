"""Product intelligence on a few lines."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.plans import product
from tallyloom.sources import staging

from .conftest import rows

KINDS = """product_sku string, order_id long, order_date date, partner_channel string, customer_segment string, product_category string,
    product_style string, product_asin string, quantity int, revenue decimal(18,2), order_value_tier string, quarter int,
    fulfilment_efficiency_score int, estimated_processing_days int"""


def _base(spark):
    """Every third line is of one SKU; orders come with both segments, and nulls are everywhere."""
    def line(i):
        return (
            "big" if i % 3 == 0 else None if i % 17 == 0 else f"s{i % 11}", None if i % 13 == 0 and i % 11 != 5 else i // 2 % 60,
            None if i % 19 == 0 else date(2022, 1 + i % 12, 1 + i % 7), None if i % 23 == 0 else ("amazon", "international", "x")[i % 3],
            None if i % 7 == 0 or i % 11 == 5 else ("b2b", "b2c")[i % 2], f"c{i % 2}", None if i % 5 == 0 else f"y{i % 4}", f"a{i % 9}",
            i % 6, Decimal(i) / 4, ("high_value", "low_value")[i % 2], 1 + i % 4, 80 + i % 3, i % 5)

    return spark.createDataFrame([line(i) for i in range(600)], KINDS)


def test_sales_of_very_large_skus_equal_the_others(spark, monkeypatch):
    """One exchange by SKU or parts that combine on the map side: the same rows, and distinct counts are the plain ones."""
    base = _base(spark)
    lines = base.filter("product_sku is not null")
    plain = lines.groupBy("product_sku").agg(
        F.count_distinct("order_id").alias("total_orders"), F.count_distinct("order_date").alias("active_sales_days"),
        F.count_distinct("partner_channel").alias("channel_presence"), F.sum("revenue").alias("total_revenue"),
        F.max("product_asin").alias("product_asin"))
    parts = product._combined_by_sku(lines).withColumn("revenue_volatility", F.round("revenue_volatility", 8))
    assert parts.filter("b2b_orders is null").count() == 1  # the SKU without any segment
    for most, combined in ((50, True), (staging.TASK_ROWS, False)):
        monkeypatch.setattr(staging, "TASK_ROWS", most)
        got = product._sales_by_sku(base).withColumn("revenue_volatility", F.round("revenue_volatility", 8))
        assert rows(got, *plain.columns) == rows(plain, *plain.columns)
        assert rows(got, *parts.columns) == rows(parts, *parts.columns)
        assert rows(got, "business_orders") == rows(got, "b2b_orders")
        assert ("Union" in got._jdf.queryExecution().optimizedPlan().toString()) == combined


def test_sales_by_sku_meet_once(spark):
    """No line is moved again for a distinct count, and nothing is joined."""
    plan = product._sales_by_sku(_base(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Expand" not in plan and plan.count("RepartitionByExpression") == 1
