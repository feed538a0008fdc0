from collections import defaultdict
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import attribution, calendar, cohorts, customers, partners, recommend, reshape, series

from .conftest import rows

D = date


@pytest.fixture(scope="module")
def purchases(spark):
    data = [
        ("u1", D(2022, 1, 5), 100.0), ("u1", D(2022, 1, 5), 50.0), ("u1", D(2022, 3, 6), 30.0),
        ("u2", D(2022, 1, 9), 20.0), ("u3", D(2022, 2, 1), 70.0), ("u3", D(2022, 3, 1), 10.0), (None, D(2022, 2, 2), 5.0),
    ]
    return spark.createDataFrame(data, "u string, d date, r double")


def test_ltv(purchases, params):
    got = {r.u: r for r in customers.customer_ltv(purchases, "u", "r", "d", params).collect()}
    assert got["u1"].predicted_ltv == pytest.approx(180 / 60 * 365)
    assert got["u2"].predicted_ltv == 20 and got["u2"].ltv_segment == "Low Value"
    clv = {r.u: r.estimated_clv for r in customers.customer_lifetime_value(purchases, "u", "r", "d").collect()}
    assert set(clv) == {"u1", "u2", "u3"} and clv["u1"] == pytest.approx(2 * 60 * 12 / 2)


def test_retention_starts_at_one(purchases):
    df = cohorts.cohort_retention(purchases.filter("u is not null"), "u", "d", "r")
    got = {(r.cohort_month, r.period_number): (r.customers, r.retention_rate) for r in df.collect()}
    assert got == {
        (D(2022, 1, 1), 0): (2, 1.0), (D(2022, 1, 1), 2): (1, 0.5),
        (D(2022, 2, 1), 0): (1, 1.0), (D(2022, 2, 1), 1): (1, 1.0),
    }
    active = cohorts.monthly_activity(purchases, "u", "d", "r")
    assert rows(active, "cohort_month", "users")[1] == (D(2022, 2, 1), 1)


def test_rfm_buckets(spark, params):
    df = spark.createDataFrame([(i, D(2022, 1, 1 + i), float(i)) for i in range(11)], "u int, d date, r double")
    out = customers.rfm(df, "u", "d", "r", params)
    sizes = [r[1] for r in rows(out.groupBy("monetary_score").count(), "monetary_score", "count")]
    assert sizes == [3, 2, 2, 2, 2]
    assert out.filter("u = 10").first().rfm_segment in ("Champions", "Potential Loyalists")


def test_recommendation_features(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 3), (1, "b", 4), (2, "a", 1)], "u int, i string, r int")
    out = recommend.recommendation_features(df, "u", "i", "r")
    assert rows(out, "u", "i", "interaction_count", "user_count", "user_product_rank") == [
        (1, "a", 2, 2, 1), (1, "b", 1, 1, 1), (2, "a", 1, 2, 1),
    ]


def test_attribution(spark):
    df = spark.createDataFrame([("c", 1, "ad"), ("c", 2, "mail"), ("d", 5, "ad")], "conv string, at int, touch string")
    run = lambda m: attribution.attribution(df, "touch", "conv", ["at"], m)
    assert rows(run("first_touch"), "conv", "touch") == [("c", "ad"), ("d", "ad")]
    assert rows(run("last_touch"), "conv", "touch") == [("c", "mail"), ("d", "ad")]
    assert rows(run("linear"), "conv", "attribution_weight") == [("c", 0.5), ("c", 0.5), ("d", 1.0)]
    with pytest.raises(ValueError):
        run("other")


def test_series(spark, params):
    df = spark.createDataFrame([(D(2022, 1, 1 + i), float(i)) for i in range(10)], "d date, v double")
    ts = series.time_series_features(df, "d", "v", windows=(3,))
    assert (2, 0.0, 0.5) in rows(ts, "row_num", "lag_1", "rolling_avg_3")
    ma = series.moving_averages(df, "d", "v", (3,))
    got = dict(rows(ma, "d", "ma_3"))
    assert (got[D(2022, 1, 2)], got[D(2022, 1, 3)]) == (None, 1.0)
    spiky = spark.createDataFrame([(1.0,)] * 30 + [(100.0,)], "v double")
    assert series.zscore_anomalies(spiky, "v", params).filter("is_anomaly").count() == 1
    assert series.iqr_anomalies(spiky, "v", params).filter("is_anomaly").count() == 1
    flat = spark.createDataFrame([(1.0,)] * 3, "v double")
    assert rows(series.zscore_anomalies(flat, "v", params), "z_score", "is_anomaly") == [(None, False)] * 3
    adj = series.seasonal_adjustment(spark.createDataFrame([(D(2022, 1, 1), 10.0), (D(2022, 4, 1), 30.0)], "d date, v double"), "d", "v")
    assert rows(adj, "seasonal_factor", "seasonally_adjusted_value") == [(0.5, 20.0), (1.5, 20.0)]


def test_partner_score(spark, params):
    df = spark.createDataFrame([(2_000_000.0, 1000)], "r double, n int")
    got = partners.partner_performance_score(df, "r", "n", params).first()
    assert got.total_performance_score == 100 and got.performance_grade == "A+"


def test_reshape(spark):
    df = spark.createDataFrame([("g", "New York", 1), ("g", "x-y", 2), ("h", None, 3)], "g string, c string, v int")
    assert rows(reshape.pivot_table(df, ["g"], "c", "v"), "g", "new_york", "x_y") == [("g", 1, 2), ("h", 0, 0)]
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    with pytest.raises(ValueError):
        reshape.pivot_table(df, ["g"], "c", "v")
    spark.conf.unset("spark.sql.pivotMaxValues")
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a")], "k int, x string")
    assert rows(reshape.duplicate_keys(dup, "k", ["x"]), "k", "combinations") == [(1, 2)]
    new = spark.createDataFrame([(1, "a"), (3, "c")], "k int, x string")
    old = spark.createDataFrame([(1, "b"), (2, "d")], "k int, x string")
    assert rows(reshape.row_hash_changes(old, new, ["k"], ["x"]), "k", "change_type") == [(1, "changed"), (2, "removed"), (3, "added")]


def test_calendar(spark):
    df = spark.createDataFrame([(D(2022, 1, 1),), (D(2022, 1, 4),)], "d date")
    assert rows(calendar.date_dimension(df, "d"), "day_of_month", "day_of_week", "is_weekend") == [
        (1, 6, "Weekend"), (2, 0, "Weekend"), (3, 1, "Weekday"), (4, 2, "Weekday"),
    ]
    assert calendar.business_days_between(spark, D(2022, 1, 1), D(2022, 1, 8)).first()[0] == 5
    assert df.select(F.max("d")).first()[0] == D(2022, 1, 4)
