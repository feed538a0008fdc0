"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.tables import Tables
from tallyloom.sources.staging import shared_dir
from tools.compare import TABLES, compare

SMALL = entry.SMALL
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")

CHECKED = (
    "agg_daily_sales", "price_catalog", "financial_summary", "partner_optimization", "unified_sales", "customer_analytics",
    "customer_segments", "product_intelligence", "cohort_analysis", "incremental_upsert", "orders_per_hour", "split_windows",
    "margin_quartiles", "quality_report", "monitor_results", "alert_digest", "csv_orders", "csv_expenses", "upsert_versions", "raw_audit",
    "isolation_facts", "forest_facts", "kmeans_facts", "test_relationships", "row_hash_changes", "sink_failures",
)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SMALL, name, entry.queries()[name], entry.oracle_sql()[name]).startswith("ok")


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 100


def test_models_without_sql(spark):
    q = entry.queries()
    clusters = q["kmeans_customers"](spark, SMALL)
    assert 1 < clusters.select("cluster").distinct().count() <= 4
    outliers = q["isolation_forest"](spark, SMALL)
    n = outliers.count()
    assert 0 < outliers.filter("is_anomaly").count() <= 0.1 * n + 1
    forest = q["revenue_forest"](spark, SMALL).collect()
    assert sum(r.importance for r in forest) == pytest.approx(1.0, abs=1e-3)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_split_windows_over_cut_groups(spark, con, monkeypatch):
    """The few groups cut into many parts."""
    monkeypatch.setattr("tallyloom.operators.ordered.PART_ROWS", 400)
    assert compare(spark, con, SMALL, "split_windows", entry.queries()["split_windows"], entry.oracle_sql()["split_windows"]).startswith("ok")


def test_csv_skip_writes_more_files_for_more_lines(spark, con, monkeypatch):
    """Every file is written by a task of its own, and no task writes more than a share of the lines."""
    from checks import q_files

    monkeypatch.setattr(q_files, "FILE_ROWS", 500)
    lines = entry.queries()["csv_skip"](spark, SMALL)
    assert 8 <= len(lines.inputFiles()) <= 24
    assert compare(spark, con, SMALL, "csv_skip", lambda s, d: lines, entry.oracle_sql()["csv_skip"]).startswith("ok")


@pytest.mark.parametrize("name", ["financial_performance", "financial_summary", "partner_daily_metrics", "duplicate_keys", "customer_segments"])
def test_tasks_follow_the_rows(spark, con, monkeypatch, name):
    """Many lines are dealt to more tasks than the session's number of shuffle partitions, with the same result."""
    monkeypatch.setattr("tallyloom.sources.staging.TASK_ROWS", 400)
    assert compare(spark, con, SMALL, name, entry.queries()[name], entry.oracle_sql()[name]).startswith("ok")
    parts = entry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in parts


@pytest.mark.parametrize("name", ["quality_report", "alert_digest"])
def test_reports_read_the_lines_once(spark, name):
    """A report reads its staged results and anomalies; the lines were staged once, narrow, and are gone."""
    folder = shared_dir(spark)
    before = set(os.listdir(folder))
    report = entry.queries()[name](spark, SMALL)
    kept = sorted(x.split("-")[0] for x in set(os.listdir(folder)) - before)
    assert kept == ["anomalies", "dashboard", "results"]
    assert "lineitem" not in str(report.inputFiles()) and report.count() > 0


def test_lines_staged_for_several_reads_are_narrow(spark):
    lines = Tables(spark, SMALL).base_once
    assert not {"line_key", "partner_performance_key", "order_status"} & set(lines.columns)
    assert "fulfillment_type" in lines.columns and lines.count() > 0
