"""Unified sales of a few lines, whole and in slices."""

import os
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest

from tallyloom.operators import ordered
from tallyloom.plans import sales
from tallyloom.sources import staging

from .conftest import rows

MARKET = """order_item_key string, order_id string, order_date date, order_year int, order_month int, season string, sku string,
    product_category string, product_size string, customer_segment string, is_b2b boolean, city_tier string, order_amount decimal(10,2),
    quantity int, unit_price decimal(12,4), recognized_revenue decimal(10,2), estimated_gst_amount decimal(12,2), net_order_amount decimal(12,2),
    order_performance_score int, composite_performance_score int, shipping_city string, shipping_state string, shipping_country string,
    fulfillment_model string, order_status_category string, has_promotion boolean, business_validation_status string"""
ABROAD = """sku string, customer_name string, order_date date, order_year int, order_month int, season string, product_category string,
    product_size string, customer_segment string, gross_amount decimal(10,2), quantity int, unit_rate decimal(10,2), data_quality_flag string"""


def reports(spark, n_market, n_abroad):
    rng = random.Random(5)

    def day(i):
        return None if i % 17 == 0 else date(2022, 1, 1) + timedelta(i % 40)

    market = [
        (f"k{i}", f"o{i // 2}", day(i), 2022, 1, rng.choice(["SPRING", None]), f"s{i % 7}" if i % 5 else None, rng.choice(["KURTA", "SET", None]), "M",
         rng.choice(["RETAIL", "BULK", None]), False, "TIER_1", None if i % 13 == 0 else Decimal(i % 9), 1 + i % 3, Decimal(i % 4), Decimal(i % 9), Decimal(1),
         Decimal(1), 50, rng.randrange(60, 64), "PUNE", "MH", "IN", "EASY", "SHIPPED", False, "VALID" if i % 19 else "INVALID")
        for i in range(n_market)]
    abroad = [
        (f"s{i % 7}", f"c{i}", day(i), 2022, 1, "SPRING", "SET", "L", rng.choice(["RETAIL", "EXPORT"]), Decimal(i % 11), 1, Decimal(3),
         "VALID" if i % 23 else "INVALID")
        for i in range(n_abroad)]
    return (spark.createDataFrame(market, MARKET).repartition(6), spark.createDataFrame(abroad, ABROAD).repartition(5))


@pytest.mark.parametrize(("n_market", "n_abroad"), [(300, 200), (300, 0)])
def test_large_reports_meet_their_results_in_slices(spark, monkeypatch, n_market, n_abroad):
    """The same rows as in one piece; of the tables on the way only the result is left, and reading it shuffles nothing."""
    orders, abroad = reports(spark, n_market, n_abroad)
    whole = sales.unified_sales(orders, abroad)
    monkeypatch.setattr(ordered, "PART_ROWS", 40)
    monkeypatch.setattr(sales, "SLICE_ROWS", 40)
    folder = staging.shared_dir(spark)
    before = set(os.listdir(folder))
    sliced = sales.unified_sales(orders, abroad)
    assert sorted(sliced.dtypes) == sorted(whole.dtypes)
    assert rows(sliced, *whole.columns) == rows(whole, *whole.columns)
    kept = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert "unified" in kept and not kept & {"market", "abroad", "by_channel", "by_sku", "ranks", "numbers"}
    plan = sliced._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_international_numbers_follow_the_order(spark):
    """One running number over the whole report, by day and tie break; marketplace lines keep their ids."""
    orders, abroad = reports(spark, 60, 50)
    got = sales.unified_sales(orders, abroad).collect()
    lines = [r for r in got if r.sales_channel == "INTERNATIONAL"]
    assert len(lines) == 47 and {r.order_id for r in lines} == {f"INTL-{i}" for i in range(1, 48)}
    lines.sort(key=lambda r: int(r.order_id[5:]))
    order = [(r.order_date is None, r.order_date or date.min, r.order_item_key) for r in lines]
    assert order == sorted(order)
    assert all(r.order_id.startswith("o") for r in got if r.sales_channel == "AMAZON")
