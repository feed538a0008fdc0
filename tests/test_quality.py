from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.quality import checks, monitor, profile
from tallyloom.sources.sinks import append_table

from .conftest import rows

NOW = datetime(2022, 7, 1)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "a", "5", "2022-06-30"), (1, None, "x", "bad"), (2, "", "7", None), (None, "b", None, "2022-06-29")],
        "id int, name string, amount string, day string",
    )


def test_quality_check(table, params):
    got = profile.quality_check(table, "t", NOW, "id", ["name", "amount"], ["amount"], ["day"]).first()
    assert (got.total_rows, got.null_count_name, got.unique_id, got.duplicate_count_id) == (4, 1, 2, 2)
    assert (got.invalid_numeric_amount, got.invalid_date_day, got.avg_amount) == (1, 1, 6.0)
    assert got.quality_score == round(100 * (1 - (0.25 + 0.25 + 0.5) / 3), 2)
    alert = profile.quality_alerts(profile.quality_check(table, "t", NOW, "id", ["name"], [], ["day"]), params).first()
    assert (alert.alert_level, alert.alert_message) == ("CRITICAL", "Data quality below threshold")


def test_rules_null_is_no_violation(table):
    got = profile.business_rules(table, "t", {"big": "id > 1"}).first()
    assert (got.violations_big, got.total_rows) == (2, 4)


def test_profile_sample_drift_audit(spark, table):
    got = {r.column_name: r for r in profile.profile_table(table, "t").collect()}
    assert (got["id"].null_count, got["id"].distinct_count, got["id"].avg) == (1, 2, pytest.approx(4 / 3))
    assert (got["name"].avg_length, got["name"].avg) == (pytest.approx(2 / 3), None)
    drawn = profile.profile_table(spark.range(1000), "r", sample_percent=10).first().sample_size
    assert 60 < drawn < 140 and drawn == profile.profile_table(spark.range(0, 1000, 1, 7), "r", sample_percent=10, keys=["id"]).first().sample_size
    days = spark.createDataFrame([("2022-01-01", 1.0), ("2022-01-01", 3.0), ("2022-01-02", 9.0)], "d string, v double")
    drift = profile.detect_drift(days, "t", "d", datetime(2022, 1, 1).date(), datetime(2022, 1, 2).date(), ["v"]).first()
    assert (drift.drift_severity_v, drift.volume_drift_percent, drift.volume_drift_severity) == ("HIGH", 50.0, "HIGH")
    assert (profile.default_key("fct_x"), profile.default_key("stg"), profile.default_date("dim_x")) == ("x_key", "id", "created_at")
    assert profile.audit_summary(table, "t", "id", "day").first().unique_key_count == 2


def test_lineage_and_run_log(spark, table, tmp_path):
    row = profile.lineage_record(spark, "t", ["a", "b"], "join", "run", NOW).first()
    assert (row.source_table_2, row.transformation_type) == ("b", "join")
    for _ in range(2):
        append_table(profile.run_log(table, "t", "run", NOW, datetime(2022, 7, 1, 0, 1)), str(tmp_path / "log"))
    assert rows(spark.read.parquet(str(tmp_path / "log")), "execution_time", "rows_affected") == [(60, 4)] * 2


def test_declarative_checks(spark, table, params):
    assert checks.not_null(table, "id").count() == 1
    assert rows(checks.unique(table, "id"), "id", "n_records") == [(1, 2)]
    assert rows(checks.accepted_values(table, "name", ["a"]), "value_field", "n_records") == [("", 1), ("b", 1)]
    assert checks.relationships(table, "id", spark.range(1, 2), "id").count() == 1
    assert checks.completeness_below(table, "name").first().data_quality_score == 0.5
    assert checks.completeness_below(table, "name", 0.4).count() == 0
    a = spark.createDataFrame([(5000.0,)], "v double")
    assert checks.reconcile_totals(a, "v", a.select((F.col("v") - 900).alias("v")), "v").count() == 0
    assert checks.reconcile_totals(a, "v", a.select((F.col("v") - 1100).alias("v")), "v").count() == 1
    stamped = spark.createDataFrame([(datetime(2022, 6, 30, 17),), (datetime(2022, 6, 30, 19),)], "at timestamp")
    assert checks.stale_rows({"t": (stamped, "at")}, NOW, params).count() == 1


def dashboard_rows(spark):
    return spark.createDataFrame(
        [("k1", "amazon", "b2c", 60000.0, 10.0, 0.9, -0.1, 5, "maintain_current_strategy", NOW),
         ("k1", "amazon", "b2b", -1.0, 120.0, -0.6, 0.3, 7, "maintain_current_strategy", NOW)],
        "dashboard_key string, partner_channel string, customer_segment string, revenue_30d double, overall_health_score double,"
        "order_growth_30d double, avg_gross_margin_30d double, orders_30d int, recommended_action string, dashboard_updated_at timestamp",
    ).withColumn("revenue_growth_30d", F.col("order_growth_30d"))


def test_contradictions_and_monitor(spark, params, tmp_path):
    dash = dashboard_rows(spark)
    assert checks.contradictions(dash).count() == 2
    later = datetime(2022, 7, 4)

    def broken():
        raise OSError("gone")

    tables = {monitor.PARTNER_DASHBOARD: lambda: dash, "missing": lambda: None, "broken": broken}
    results = monitor.run_checks(spark, tables, later, params)
    got = {(r.check_name, r.column_name): (r.status, r.severity) for r in results.collect()}
    assert got["data_uniqueness", "dashboard_key"] == ("FAIL", "HIGH")
    assert got["data_freshness", "dashboard_updated_at"] == ("FAIL", "CRITICAL")
    assert got["revenue_validity", "revenue_30d"] == ("FAIL", "HIGH")
    assert got["revenue_health_consistency", None] == ("WARN", "MEDIUM")
    assert got["table_accessibility", None] == ("FAIL", "HIGH")
    odd = monitor.volume_anomalies(dash, later, params).unionByName(monitor.margin_anomalies(dash, later))
    assert odd.count() == 3
    digest = monitor.alert_digest(results, odd)
    sizes = dict(rows(digest.select("section", "section_size").distinct(), "section", "section_size"))
    assert sizes["CRITICAL"] == 1 and sizes["ANOMALY"] == 3
    report = monitor.monitoring_cycle(spark, tables, str(tmp_path), later, params)
    figures = {(r.section, r.item): r.figure for r in report.collect()}
    assert figures["anomaly_summary", "total_anomalies"] == 3
    assert figures["summary", "total_checks"] == results.count()
    assert spark.read.parquet(str(tmp_path / "quality_results")).count() == results.count()
    assert spark.read.parquet(str(tmp_path / "anomaly_results")).count() == 3
    assert spark.read.json(str(tmp_path / "report")).count() == report.count()


def test_recent_zscores(spark, params):
    data = [(datetime(2022, 6, 10 + i).date(), "amazon", "b2c", "x", 100.0 if i < 9 else 900.0) for i in range(10)]
    df = spark.createDataFrame(data, "order_date date, partner_channel string, customer_segment string, product_category string, daily_revenue double")
    found = monitor.revenue_anomalies(df, NOW, params).first()
    assert found.current_value == 900 and found.anomaly_score == pytest.approx(3.0) and found.context["threshold"] == "2.0"
    assert monitor.revenue_zscores(df.limit(6), params).count() == 0
