"""Quality monitor: check results, anomalies, report and alert digest as DataFrames.

A table's checks come out of one aggregation; results are small rows that are unioned and
appended once per cycle.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import fixed_values as V
from ..functions import safe_divide, tier
from ..params import Params
from ..sources.sinks import append_table, write_json
from ..sources.staging import stage

RESULT_SCHEMA = (
    "check_name string, table_name string, column_name string, check_type string, status string, "
    "value double, threshold double, message string, timestamp timestamp, severity string"
)
ANOMALY_SCHEMA = (
    "table_name string, metric_name string, current_value double, expected_value double, deviation double, "
    "anomaly_score double, is_anomaly boolean, timestamp timestamp, context map<string,string>"
)
METRIC_SCHEMA = "metric_name string, metric_value double, dimension string, timestamp timestamp"

PARTNER_DASHBOARD = "mart_partner_performance_dashboard"
FINANCIAL_SUMMARY = "mart_financial_performance_summary"
MONITORED = (
    PARTNER_DASHBOARD, FINANCIAL_SUMMARY, "mart_partner_optimization_insights",
    "mart_cohort_analysis", "dim_customer_segments", "dim_product_intelligence",
)


def _result(name, column, kind, passed: Column, value: Column, threshold, message: Column, severity: Column, fail="FAIL"):
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(column).cast("string").alias("column_name"),
        F.lit(kind).alias("check_type"), F.when(passed, "PASS").otherwise(fail).alias("status"),
        value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"),
        message.alias("message"), severity.alias("severity"),
    )


def _rate_text(label: str, rate: Column, part: Column, rest: str) -> Column:
    return F.format_string(f"{label}: %.2f%% ({rest})", rate * 100, part)


def table_checks(df: DataFrame, table: str, now: datetime, p: Params) -> DataFrame:
    """Completeness, freshness, uniqueness, validity and rule results of one table."""
    names = df.columns
    keys = [c for c in names if c.endswith("_key")]
    complete = [c for c in names if c.endswith("_key") or c in V.EXTRA_COMPLETENESS_COLUMNS]
    fresh = next((c for c in V.TIMESTAMP_COLUMNS if c in names), None)
    is_dashboard = table == PARTNER_DASHBOARD
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count(c).alias(f"filled_{c}") for c in complete]
    aggs += [F.count_distinct(c).alias(f"distinct_{c}") for c in keys]
    if fresh:
        aggs.append(F.max(fresh).cast("timestamp").alias("latest"))
    if is_dashboard:
        score = F.col("overall_health_score")
        aggs += [
            F.count_if(F.col("revenue_30d") < 0).alias("negative"),
            F.count_if((score < 0) | (score > 100)).alias("out_of_range"),
            F.count_if((F.col("revenue_30d") > 50000) & (score < 30)).alias("odd"),
        ]
    row = df.agg(*aggs)
    n = F.col("n")
    rows = []
    for c in complete:
        filled = F.col(f"filled_{c}")
        rate = safe_divide(filled, n)
        rows.append(_result(
            "data_completeness", c, "COMPLETENESS", rate >= p.data_completeness, rate, p.data_completeness,
            F.format_string("Completeness rate: %.2f%% (%d/%d)", rate * 100, filled, n),
            tier(rate, V.COMPLETENESS_SEVERITY),
        ))
    if fresh:
        hours = (F.unix_timestamp(F.lit(now)) - F.unix_timestamp("latest")) / 3600
        rows.append(_result(
            "data_freshness", fresh, "FRESHNESS", hours <= p.data_freshness_hours, hours, p.data_freshness_hours,
            F.format_string("Data is %.1f hours old", hours), tier(hours, V.FRESHNESS_SEVERITY),
        ))
    for c in keys:
        rate = safe_divide(F.col(f"distinct_{c}"), n)
        rows.append(_result(
            "data_uniqueness", c, "UNIQUENESS", rate == 1.0, rate, 1.0,
            F.format_string("Uniqueness rate: %.2f%% (%d/%d)", rate * 100, F.col(f"distinct_{c}"), n),
            tier(rate, V.UNIQUENESS_SEVERITY),
        ))
    if is_dashboard:
        for name, column, bad, label, rest in (
            ("revenue_validity", "revenue_30d", "negative", "Revenue validity", "%d negative values"),
            ("health_score_validity", "overall_health_score", "out_of_range", "Health score validity", "%d invalid values"),
        ):
            rate = F.coalesce(safe_divide(n - F.col(bad), n), F.lit(1.0))
            rows.append(_result(
                name, column, "VALIDITY", rate == 1.0, rate, 1.0,
                _rate_text(label, rate, F.col(bad), rest), tier(rate, V.VALIDITY_SEVERITY),
            ))
        rate = safe_divide(n - F.col("odd"), n)
        rows.append(_result(
            "revenue_health_consistency", None, "BUSINESS_RULE", rate >= V.COMPLIANCE_PASS, rate, V.COMPLIANCE_PASS,
            _rate_text("Revenue-health consistency", rate, F.col("odd"), "%d anomalous"),
            tier(rate, V.COMPLIANCE_SEVERITY), fail="WARN",
        ))
    # an empty table has no rates; checks without a value are left out
    results = row.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("value is not null")
    return results.withColumns({"table_name": F.lit(table), "timestamp": F.lit(now).cast("timestamp")}).select(
        *[part.split()[0] for part in RESULT_SCHEMA.split(", ")]
    )


def _access_failure(spark: SparkSession, table: str, error: str, now: datetime) -> DataFrame:
    row = ("table_accessibility", table, None, "SYSTEM", "FAIL", 0.0, 1.0, f"Table check failed: {error}", now, "HIGH")
    return spark.createDataFrame([row], RESULT_SCHEMA)


def run_checks(spark: SparkSession, tables: dict[str, Callable[[], DataFrame | None]], now: datetime, p: Params) -> DataFrame:
    """Checks of several tables; a table given as None is skipped, an error becomes a FAIL row."""
    parts = []
    for table, load in tables.items():
        try:
            df = load()
            if df is not None:
                parts.append(table_checks(df, table, now, p))
        except Exception as error:  # an unreadable table is a finding, not a crash
            parts.append(_access_failure(spark, table, str(error).split("\n")[0], now))
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], RESULT_SCHEMA))


def _anomalies(df: DataFrame, table: str, metric: str, value, expected, score, context: dict, now: datetime) -> DataFrame:
    pairs = [x for k, v in context.items() for x in (F.lit(k), v.cast("string"))]
    value, expected = value.cast("double"), expected.cast("double")
    return df.select(
        F.lit(table).alias("table_name"), F.lit(metric).alias("metric_name"), value.alias("current_value"),
        expected.alias("expected_value"), F.abs(value - expected).alias("deviation"),
        score.alias("anomaly_score"), F.lit(True).alias("is_anomaly"),
        F.lit(now).cast("timestamp").alias("timestamp"), F.create_map(*pairs).alias("context"),
    )


def revenue_zscores(summary: DataFrame, p: Params) -> DataFrame:
    """Last rows of each channel and segment far from its 30-day mean (population deviation).

    The summary has one row per day, category and group, and only 30 days are read.
    """
    recent = summary.filter(F.col("order_date") >= F.date_sub(F.lit(p.as_of), V.RECENT_DAYS))
    whole = Window.partitionBy("partner_channel", "customer_segment")
    latest = whole.orderBy(F.col("order_date").desc(), F.col("product_category").desc())
    x = F.col("daily_revenue").cast("double")
    return recent.withColumns({
        "mean_revenue": F.avg(x).over(whole),
        "std_revenue": F.stddev_pop(x).over(whole),
        "rows_in_group": F.count(F.lit(1)).over(whole),
        "from_end": F.row_number().over(latest),
    }).withColumn("z_score", F.try_divide(x - F.col("mean_revenue"), F.col("std_revenue"))).filter(
        (F.col("rows_in_group") >= V.MIN_GROUP_ROWS) & (F.col("from_end") <= V.LAST_ROWS)
        & (F.abs("z_score") > V.Z_LIMIT)
    )


def revenue_anomalies(summary: DataFrame, now: datetime, p: Params) -> DataFrame:
    z = F.col("z_score")
    return _anomalies(
        revenue_zscores(summary, p), FINANCIAL_SUMMARY, "daily_revenue", F.col("daily_revenue"),
        F.col("mean_revenue"), F.abs(z),
        {"partner_channel": F.col("partner_channel"), "customer_segment": F.col("customer_segment"),
         "z_score": z, "threshold": F.lit(V.Z_LIMIT)}, now,
    )


def volume_anomalies(dashboard: DataFrame, now: datetime, p: Params) -> DataFrame:
    g = F.col("order_growth_30d")
    return _anomalies(
        dashboard.filter(F.abs(g) > p.order_volume_anomaly), PARTNER_DASHBOARD, "order_volume_growth", g, F.lit(0.0),
        F.abs(g) / p.order_volume_anomaly,
        {"partner_channel": F.col("partner_channel"), "customer_segment": F.col("customer_segment"),
         "orders_30d": F.col("orders_30d")}, now,
    )


def margin_anomalies(dashboard: DataFrame, now: datetime) -> DataFrame:
    m = F.col("avg_gross_margin_30d")
    return _anomalies(
        dashboard.filter(m < 0), PARTNER_DASHBOARD, "gross_margin", m, F.lit(V.EXPECTED_MARGIN),
        F.abs(m - V.EXPECTED_MARGIN) / V.EXPECTED_MARGIN,
        {"partner_channel": F.col("partner_channel"), "customer_segment": F.col("customer_segment"),
         "type": F.lit("negative_margin")}, now,
    )


def quality_report(results: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Long report: section, item and its figure (counts, success rate, anomalies per metric)."""
    status = F.col("status")
    totals = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        *[F.count_if(status == s).alias(n) for s, n in (("PASS", "passed_checks"), ("FAIL", "failed_checks"), ("WARN", "warning_checks"))],
    ).withColumn("success_rate", F.coalesce(safe_divide("passed_checks", "total_checks"), F.lit(0.0)))
    extremes = anomalies.agg(
        F.count(F.lit(1)).alias("total_anomalies"), F.count_if(F.col("anomaly_score") > 3).alias("high_score_anomalies")
    )

    def long(df: DataFrame, section: str) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
        return wide.unpivot([], df.columns, "item", "figure").select(F.lit(section).alias("section"), "item", "figure")

    def counted(df: DataFrame, section: str, item: Column) -> DataFrame:
        grouped = df.groupBy(item.alias("item")).agg(F.count(F.lit(1)).cast("double").alias("figure"))
        return grouped.select(F.lit(section).alias("section"), "item", "figure")

    per_table = results.groupBy("table_name").pivot("status", ["PASS", "FAIL", "WARN"]).agg(F.count(F.lit(1)))
    filled = per_table.select("table_name", *[
        F.coalesce(F.col(s), F.lit(0)).cast("double").alias(s) for s in ("PASS", "FAIL", "WARN")
    ]).unpivot(["table_name"], ["PASS", "FAIL", "WARN"], "status", "figure")
    tables = filled.select(
        F.lit("table_summary").alias("section"), F.concat_ws(":", "table_name", "status").alias("item"), "figure",
    )
    return reduce(DataFrame.unionByName, [
        long(totals, "summary"),
        counted(results, "severity_breakdown", F.col("severity")),
        tables,
        long(extremes, "anomaly_summary"),
        counted(anomalies, "anomalies_by_metric", F.col("metric_name")),
    ])


def alert_digest(results: DataFrame, anomalies: DataFrame, per_section: int = V.DIGEST_ROWS) -> DataFrame:
    """First lines of the critical, high and anomaly sections with the size of each section."""
    issues = results.filter(F.col("severity").isin("CRITICAL", "HIGH")).select(
        F.col("severity").alias("section"), "table_name",
        F.concat_ws(": ", "table_name", "message").alias("line"),
    )
    odd = anomalies.filter("is_anomaly").select(
        F.lit("ANOMALY").alias("section"), "table_name",
        F.format_string("%s: %s anomaly (score: %.2f)", "table_name", "metric_name", "anomaly_score").alias("line"),
    )
    lines = issues.unionByName(odd)
    sizes = lines.groupBy("section").agg(F.count(F.lit(1)).alias("section_size"))
    # a rank under a limit is cut in each task before rows move, so a long section costs a few rows per task
    first = F.row_number().over(Window.partitionBy("section").orderBy("line"))
    top = lines.withColumn("position", first).filter(F.col("position") <= per_section)
    return top.join(sizes, "section")


def monitoring_cycle(
    spark: SparkSession, tables: dict[str, Callable[[], DataFrame | None]], folder: str, now: datetime, p: Params,
) -> DataFrame:
    """Checks, anomalies, result tables and report of one cycle; returns the report rows."""
    results = stage(run_checks(spark, tables, now, p), "results")
    found = [spark.createDataFrame([], ANOMALY_SCHEMA)]
    loaded = {}
    for name in (PARTNER_DASHBOARD, FINANCIAL_SUMMARY):
        try:
            loaded[name] = tables[name]() if name in tables else None
        except Exception:
            loaded[name] = None  # already reported as table_accessibility
    if loaded[FINANCIAL_SUMMARY] is not None:
        found.append(revenue_anomalies(loaded[FINANCIAL_SUMMARY], now, p))
    if loaded[PARTNER_DASHBOARD] is not None:
        found += [volume_anomalies(loaded[PARTNER_DASHBOARD], now, p), margin_anomalies(loaded[PARTNER_DASHBOARD], now)]
    anomalies = stage(reduce(DataFrame.unionByName, found), "anomalies")
    append_table(results, f"{folder}/quality_results")
    append_table(anomalies, f"{folder}/anomaly_results")
    report = stage(quality_report(results, anomalies), "report")
    metrics = report.select(
        F.col("item").alias("metric_name"), F.col("figure").alias("metric_value"),
        F.col("section").alias("dimension"), F.lit(now).cast("timestamp").alias("timestamp"),
    )
    append_table(metrics, f"{folder}/quality_metrics")
    write_json(report, f"{folder}/report")
    return report
