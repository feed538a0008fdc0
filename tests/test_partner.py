"""Partner tables on a few lines."""

from datetime import date

from pyspark.sql import functions as F

from tallyloom.plans import partner
from tallyloom.sources import staging

from .conftest import rows


def test_daily_distinct_counts_meet_in_bounded_tasks(spark, monkeypatch):
    """Both counts equal plain distinct counts, NULL keys, orders and SKUs included; no line is copied per count."""
    monkeypatch.setattr(staging, "TASK_ROWS", 20)
    data = [
        (None if i % 7 == 0 else "amazon", date(2022, 1, 1 + i % 2), "primary_channels", "b2b" if i % 3 else "b2c", 1, 1, i % 2, True,
         None if i % 11 == 0 else i % 40, None if i % 13 == 0 else f"s{i % 9}", i % 5, 10 + i, 2.0, 90, 3, "valid", "low_value")
        for i in range(300)]
    kinds = """partner_channel string, order_date date, channel_group string, customer_segment string, quarter int, month int,
        day_of_week int, is_business_day boolean, order_id long, product_sku string, quantity int, revenue decimal(18,2),
        revenue_per_unit double, fulfilment_efficiency_score int, estimated_processing_days int, data_quality_flag string,
        order_value_tier string"""
    from decimal import Decimal
    base = spark.createDataFrame([(*r[:11], Decimal(r[11]), *r[12:]) for r in data], kinds)
    keys = ("partner_channel", "order_date", "customer_segment", "day_of_week")
    plain = base.groupBy(*keys).agg(
        F.count_distinct("order_id").alias("daily_orders"), F.count_distinct("product_sku").alias("daily_unique_products"),
        F.sum("quantity").alias("daily_units_sold"), F.count("*").alias("total_records"))
    got = partner.daily_partner_metrics(base)
    outs = (*keys, "daily_orders", "daily_unique_products", "daily_units_sold", "total_records")
    assert rows(got, *outs) == rows(plain, *outs)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "RepartitionByExpression" in plan


def test_financial_performance_reads_its_named_columns_only(spark):
    from tallyloom.plans import finance

    data = [("amazon", date(2022, 1, 1 + i % 2), "c", f"s{i % 3}", "b2b", i % 4, i + 1, 2, 1.5, "x") for i in range(20)]
    base = spark.createDataFrame(data, """partner_channel string, order_date date, product_category string, product_sku string,
        customer_segment string, order_id long, revenue long, quantity int, revenue_per_unit double, more string""")
    whole, narrow = (finance.financial_performance(df) for df in (base, base.select(*finance.LINE_COLUMNS)))
    assert rows(narrow, *whole.columns) == rows(whole, *whole.columns)
