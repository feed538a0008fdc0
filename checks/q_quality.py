"""Quality checks, profiles, monitoring and reports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tallyloom import fixed_values as V
from tallyloom.plans import finance, partner
from tallyloom.quality import checks, monitor, profile
from tallyloom.sources.staging import new_path, stage, unstage

from . import sqlgen as q
from .q_marts import dashboard, mart_sql, summary
from .q_staging import sql
from .spec import REGISTRY, register
from .tables import AS_OF, NOW, PARAMS, TODAY

# ---- table-level checks ------------------------------------------------------------
_NOW_TS = "TIMESTAMP '2001-08-01 00:00:00'"


def _check_lines(t):
    """Raw texts of the marketplace report: some amounts and statuses are missing."""
    lines = t.market_raw.withColumnsRenamed({"Order ID": "order_id", "Status": "status", "Amount": "amount", "Qty": "qty", "Date": "day"})
    return profile.quality_check(
        lines, "market_raw", NOW, primary_key="order_id", required=["status", "amount"], numeric=["amount", "qty"], dates=["day"],
    )


def _check_intl(t):
    lines = t.international_raw.withColumnsRenamed({"GROSS AMT": "amount", "DATE": "day"})
    return profile.quality_check(
        lines, "international_raw", NOW, primary_key="SKU", required=["day", "CUSTOMER"], numeric=["amount"], dates=["day"],
    )


def _check_sql(table: str, name: str, pk: str, required: list[str], numeric: list[str], day: str) -> str:
    nulls = {c: f"COUNT_IF({e} IS NULL)" for c, e in required}
    parts = [f"CAST({n} AS DOUBLE) / COUNT(*)" for n in nulls.values()] + [f"CAST(COUNT(*) - COUNT(DISTINCT {pk}) AS DOUBLE) / COUNT(*)"]
    cols = [f"'{name}' AS table_name, COUNT(*) AS total_rows"]
    for c, n in nulls.items():
        cols.append(f"{n} AS null_count_{c}, ROUND(CAST({n} AS DOUBLE) / COUNT(*) * 100, 2) AS null_rate_{c}")
    cols.append(f"COUNT(DISTINCT {pk}) AS unique_key, COUNT(*) - COUNT(DISTINCT {pk}) AS duplicate_count_key")
    for c, e in numeric:
        x = f"TRY_CAST({e} AS DOUBLE)"
        cols.append(
            f"COUNT_IF(TRY_CAST({e} AS DECIMAL(18,3)) IS NULL AND {e} IS NOT NULL) AS invalid_numeric_{c}, AVG({x}) AS avg_{c}, "
            f"STDDEV_SAMP({x}) AS stddev_{c}, MIN({x}) AS min_{c}, MAX({x}) AS max_{c}"
        )
    cols.append(
        f"COUNT_IF(TRY_CAST({day} AS DATE) IS NULL AND {day} IS NOT NULL) AS invalid_date_day, MAX({day}) AS max_date, "
        f"date_diff('hour', CAST(MAX({day}) AS TIMESTAMP), {_NOW_TS}) AS hours_since_last_update, "
        f"ROUND((1 - ({' + '.join(parts)}) / {len(parts)}) * 100, 2) AS quality_score"
    )
    return f"SELECT {', '.join(cols)} FROM {table}"


_MARKET_CHECK = _check_sql(
    "market_raw", "market_raw", "order_id", [("status", "order_status"), ("amount", "amount_text")],
    [("amount", "amount_text"), ("qty", "quantity_text")], "order_date_text",
)
_INTL_CHECK = _check_sql(
    "international_raw", "international_raw", "sku", [("day", "order_date_text"), ("CUSTOMER", "customer_name")],
    [("amount", "gross_amount_text")], "order_date_text",
)
_BOTH = {"market_check": _MARKET_CHECK, "intl_check": _INTL_CHECK}

register(
    "quality_check",
    """table_name:s total_rows:i null_count_status:i null_rate_status:d null_count_amount:i null_rate_amount:d unique_key:i duplicate_count_key:i
    invalid_numeric_amount:i avg_amount:d stddev_amount:d min_amount:d max_amount:d invalid_numeric_qty:i avg_qty:d stddev_qty:d min_qty:d max_qty:d
    invalid_date_day:i max_date:s hours_since_last_update:i quality_score:d""",
    sql("SELECT * FROM market_check", **_BOTH),
)(lambda t: _check_lines(t).withColumnsRenamed({"unique_order_id": "unique_key", "duplicate_count_order_id": "duplicate_count_key"}))

_ALERT = f"""{q.bands('quality_score', V.Bands('<', ((80.0, 'CRITICAL'), (90.0, 'WARNING')), 'HEALTHY'))} AS alert_level,
    CASE WHEN quality_score < 80 THEN 'Data quality below threshold' WHEN hours_since_last_update > 6 THEN 'Data freshness issue' ELSE 'No issues detected' END AS alert_message"""
register(
    "quality_alerts",
    "table_name:s total_rows:i quality_score:d hours_since_last_update:i alert_level:s alert_message:s",
    sql(
        f"""SELECT table_name, total_rows, quality_score, hours_since_last_update, {_ALERT} FROM market_check
        UNION ALL SELECT table_name, total_rows, quality_score, hours_since_last_update, {_ALERT} FROM intl_check""", **_BOTH,
    ),
)(lambda t: _alerts(t))


def _alerts(t):
    cols = ["table_name", "total_rows", "quality_score", "hours_since_last_update", "alert_level", "alert_message"]
    both = [profile.quality_alerts(c, PARAMS).select(*cols) for c in (_check_lines(t), _check_intl(t))]
    return both[0].unionByName(both[1])


register(
    "quality_dashboard",
    """total_tables:i avg_quality_score:d min_quality_score:d total_rows_monitored:i max_hours_since_update:i tables_with_issues:i
    stale_tables:i quality_issue_rate:d freshness_issue_rate:d overall_health_status:s""",
    sql(
        f"""SELECT *, ROUND(100.0 * tables_with_issues / total_tables, 2) AS quality_issue_rate, ROUND(100.0 * stale_tables / total_tables, 2) AS freshness_issue_rate,
                   {q.bands('avg_quality_score', V.QUALITY_STATUS)} AS overall_health_status
            FROM (SELECT COUNT(*) AS total_tables, AVG(quality_score) AS avg_quality_score, MIN(quality_score) AS min_quality_score, SUM(total_rows) AS total_rows_monitored,
                         MAX(hours_since_last_update) AS max_hours_since_update, COUNT_IF(quality_score < 80) AS tables_with_issues, COUNT_IF(hours_since_last_update > 6) AS stale_tables
                  FROM (SELECT quality_score, total_rows, hours_since_last_update FROM market_check
                        UNION ALL SELECT quality_score, total_rows, hours_since_last_update FROM intl_check) AS u) AS a""", **_BOTH,
    ),
)(lambda t: profile.quality_dashboard([_check_lines(t), _check_intl(t)], PARAMS))

_RULES = {
    "positive_amount": "order_amount > 0", "whole_units": "quantity >= 5", "unit_price_known": "unit_price is not null",
    "no_promotion_on_b2b": "not (is_b2b and has_promotion)",
}
register(
    "business_rules",
    "table_name:s total_rows:i " + " ".join(f"violations_{n}:i rule_{n}_description:s" for n in _RULES),
    sql(f"""SELECT 'market' AS table_name, COUNT(*) AS total_rows, {', '.join(
        f"SUM(CASE WHEN NOT ({c}) THEN 1 ELSE 0 END) AS violations_{n}, '{c}' AS rule_{n}_description" for n, c in _RULES.items())} FROM market"""),
)(lambda t: _rules(t))


def _rules(t):
    from tallyloom.plans.raw import marketplace_orders

    return profile.business_rules(marketplace_orders(t.market_raw, PARAMS), "market", _RULES)


_PROFILED = {"order_id": "number", "line_key": "text", "revenue": "number", "order_date": "other", "product_category": "text", "is_b2b": "other"}
_TYPES = {"order_id": "bigint", "line_key": "string", "revenue": "decimal(18,2)", "order_date": "date", "product_category": "string", "is_b2b": "boolean"}


def _profile_sql(c: str, kind: str) -> str:
    number = f"AVG(CAST({c} AS DOUBLE)), MIN(CAST({c} AS DOUBLE)), MAX(CAST({c} AS DOUBLE)), STDDEV_SAMP(CAST({c} AS DOUBLE))"
    text = f"AVG(LENGTH({c})), MIN(LENGTH({c})), MAX(LENGTH({c}))"
    parts = [number if kind == "number" else "NULL, NULL, NULL, NULL", text if kind == "text" else "NULL, NULL, NULL"]
    return f"SELECT 'lines', COUNT(*), '{c}', '{_TYPES[c]}', COUNT_IF({c} IS NULL), COUNT(DISTINCT {c}), {', '.join(parts)} FROM lines"


_PROFILE_COLS = "table_name, sample_size, column_name, column_type, null_count, distinct_count, avg, min, max, stddev, avg_length, min_length, max_length"
register(
    "profile",
    "table_name:s sample_size:i column_name:s column_type:s null_count:i distinct_count:i avg:d min:d max:d stddev:d avg_length:d min_length:d max_length:d",
    sql(f"SELECT * FROM ({' UNION ALL '.join(_profile_sql(c, k) for c, k in _PROFILED.items())}) AS p({_PROFILE_COLS})"),
)(lambda t: profile.profile_table(t.lines.select(*_PROFILED), "lines"))

# a tenth of the lines by the first 32 bits of the MD5 of the seed and the line key
_DRAWN = "lines WHERE CAST('0x' || substr(md5('7-' || line_key), 1, 8) AS BIGINT) < 429496729"
register(
    "profile_sample",
    "table_name:s sample_size:i column_name:s column_type:s null_count:i distinct_count:i avg:d min:d max:d stddev:d avg_length:d min_length:d max_length:d",
    sql(f"SELECT * FROM ({' UNION ALL '.join(_profile_sql(c, k).replace('FROM lines', f'FROM {_DRAWN}') for c, k in _PROFILED.items())}) AS p({_PROFILE_COLS})"),
)(lambda t: profile.profile_table(t.lines.select(*_PROFILED), "lines", sample_percent=10, keys=["line_key"]))

_D1, _D2 = "1998-03-02", "2000-10-11"


def _drift_cols(c: str) -> str:
    z = f"ABS(AVG(CASE WHEN d2 THEN CAST({c} AS DOUBLE) END) - AVG(CASE WHEN d1 THEN CAST({c} AS DOUBLE) END)) / STDDEV_SAMP(CASE WHEN d1 THEN CAST({c} AS DOUBLE) END)"
    return f"{z} AS drift_zscore_{c}, {q.bands(z, V.DRIFT_SEVERITY)} AS drift_severity_{c}"


_VOL = "ABS(COUNT_IF(d2) - COUNT_IF(d1)) * 100.0::DOUBLE / NULLIF(COUNT_IF(d1), 0)"
register(
    "drift",
    """table_name:s baseline_date:t current_date:t drift_zscore_revenue:d drift_severity_revenue:s drift_zscore_quantity:d
    drift_severity_quantity:s volume_drift_percent:d volume_drift_severity:s""",
    sql(f"""SELECT 'lines' AS table_name, DATE '{_D1}' AS baseline_date, DATE '{_D2}' AS "current_date", {_drift_cols('revenue')}, {_drift_cols('quantity')},
                   {_VOL} AS volume_drift_percent, {q.bands(_VOL, V.VOLUME_SEVERITY)} AS volume_drift_severity
            FROM (SELECT *, order_date = DATE '{_D1}' AS d1, order_date = DATE '{_D2}' AS d2 FROM lines) AS l"""),
)(lambda t: profile.detect_drift(
    t.lines, "lines", "order_date", date.fromisoformat(_D1), date.fromisoformat(_D2), ["revenue", "quantity"]
))

register(
    "audit_summary",
    "model_name:s record_count:i unique_key_count:i min_date:t max_date:t",
    sql("""SELECT 'fct_lines' AS model_name, COUNT(*) AS record_count, COUNT(DISTINCT line_key) AS unique_key_count,
                  MIN(order_date) AS min_date, MAX(order_date) AS max_date FROM lines"""),
)(lambda t: profile.audit_summary(t.lines, "fct_lines", key="line_key"))

register(
    "run_log",
    "run_id:s model_name:s status:s execution_time:i rows_affected:i",
    sql("SELECT 'run-1' AS run_id, 'base' AS model_name, 'success' AS status, 90 AS execution_time, COUNT(*) AS rows_affected FROM base"),
)(lambda t: profile.run_log(t.base, "base", "run-1", NOW, NOW + timedelta(seconds=90)))

# ---- declarative checks (failing rows) ----------------------------------------------
register(
    "completeness",
    "column_name:s total_records:i valid_records:i data_quality_score:d",
    sql("""SELECT * FROM (SELECT c AS column_name, COUNT(*) AS total_records, COUNT_IF(v IS NOT NULL AND v <> '') AS valid_records,
                  CAST(COUNT_IF(v IS NOT NULL AND v <> '') AS DOUBLE) / COUNT(*) AS data_quality_score
           FROM (SELECT 'Amount' AS c, amount_text AS v FROM market_raw UNION ALL SELECT 'promotion-ids', promotion_ids FROM market_raw
                 UNION ALL SELECT 'Status', order_status FROM market_raw) AS u GROUP BY 1) AS r WHERE data_quality_score < 0.95"""),
)(lambda t: _completeness(t))


def _completeness(t):
    parts = [
        checks.completeness_below(t.market_raw.withColumnRenamed(c, "value"), "value").withColumn("column_name", F.lit(c))
        for c in ("Amount", "promotion-ids", "Status")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register(
    "test_not_null", "order_id:s sku:s order_date:t",
    sql("SELECT order_id, sku, order_date FROM market WHERE order_amount IS NULL"),
)(lambda t: checks.not_null(_market(t), "order_amount"))


def _market(t):
    from tallyloom.plans.raw import marketplace_orders

    return marketplace_orders(t.market_raw, PARAMS)


register(
    "test_unique", "order_item_key:s n_records:i",
    sql("SELECT order_item_key, COUNT(*) AS n_records FROM orders_staged GROUP BY 1 HAVING COUNT(*) > 1"),
)(lambda t: checks.unique(t.orders, "order_item_key"))

register(
    "test_accepted_values", "value_field:s n_records:i",
    sql("SELECT order_status_category AS value_field, COUNT(*) AS n_records FROM market GROUP BY 1 HAVING order_status_category NOT IN ('DELIVERED', 'SHIPPED')"),
)(lambda t: checks.accepted_values(_market(t), "order_status_category", ["DELIVERED", "SHIPPED"]))

register(
    "test_relationships", "o_orderkey:i o_custkey:i",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)(lambda t: checks.relationships(t.given("orders"), "o_orderkey", t.given("lineitem"), "l_orderkey"))

register(
    "reconcile", "left_total:d right_total:d",
    mart_sql(f"""SELECT * FROM (SELECT (SELECT SUM(revenue_30d) FROM dashboard) AS left_total, (SELECT SUM(revenue_ytd) FROM dashboard) AS right_total) AS t
                 WHERE ABS(left_total - right_total) > 1000
                 UNION ALL SELECT * FROM (SELECT (SELECT SUM(revenue_30d) FROM dashboard), (SELECT SUM(daily_revenue) FROM summary WHERE order_date >= {TODAY} - 30)) AS t(a, b)
                 WHERE ABS(a - b) > 1000"""),
)(lambda t: _reconcile(t))


def _reconcile(t):
    """One pair that must differ (30 days against the year) and one that must agree."""
    d = dashboard(t).select("revenue_30d", "revenue_ytd")
    s = summary(t).filter(F.col("order_date") >= F.date_sub(F.lit(AS_OF), 30))
    return checks.reconcile_totals(d, "revenue_30d", d, "revenue_ytd").unionByName(
        checks.reconcile_totals(d, "revenue_30d", s, "daily_revenue")
    )


register(
    "stale_rows", "model_name:s last_update:t n:i",
    sql("""SELECT model_name, CAST(last_update AS DATE) AS last_update, COUNT(*) AS n
           FROM (SELECT 'orders' AS model_name, o_orderdate AS last_update FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-31 18:00:00'
                 UNION ALL SELECT 'lineitem', l_shipdate FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-07-31 18:00:00') AS s GROUP BY 1, 2"""),
)(lambda t: checks.stale_rows(
    {"orders": (t.given("orders"), "o_orderdate"), "lineitem": (t.given("lineitem"), "l_shipdate")}, NOW, PARAMS,
).groupBy("model_name", F.to_date("last_update").alias("last_update")).agg(F.count(F.lit(1)).alias("n")))

register(
    "contradictions", "partner_channel:s customer_segment:s revenue_30d:d overall_health_score:d",
    mart_sql(f"SELECT partner_channel, customer_segment, revenue_30d, overall_health_score FROM dashboard WHERE {V.CONTRADICTION}"),
)(lambda t: checks.contradictions(dashboard(t)))

# ---- monitor ------------------------------------------------------------------------
_CHECKED = {
    monitor.PARTNER_DASHBOARD: ("dashboard", ["dashboard_key"], ["dashboard_key", "revenue_30d", "overall_health_score"], "dashboard_updated_at"),
    monitor.FINANCIAL_SUMMARY: ("summary", ["financial_summary_key"], ["financial_summary_key", "order_date"], "summary_created_at"),
}
_RESULT_COLS = "check_name, table_name, column_name, check_type, status, value, threshold, severity, message"


def _severity(low: str, steps: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN rate {cond} THEN '{name}'" for cond, name in steps) + f" ELSE '{low}' END"


def _monitor_sql() -> str:
    """Limits, severities and texts are written out here, apart from the operator's own tables."""
    parts = []

    def add(name, table, source, column, kind, rate, threshold, passed, severity, text, figures, part="0", fail="FAIL"):
        parts.append(
            f"SELECT '{name}', '{table}', {q.lit(column)}, '{kind}', CASE WHEN {passed} THEN 'PASS' ELSE '{fail}' END, rate, {threshold}, "
            f"{severity}, printf('{text}', {figures}) FROM (SELECT {rate} AS rate, {part} AS part, COUNT(*) AS n FROM {source}) AS r"
        )

    for table, (source, keys, complete, stamp) in _CHECKED.items():
        for c in complete:
            add("data_completeness", table, source, c, "COMPLETENESS", f"CAST(COUNT({c}) AS DOUBLE) / COUNT(*)", 0.95, "rate >= 0.95",
                _severity("LOW", [("< 0.8", "HIGH"), ("< 0.95", "MEDIUM")]), "Completeness rate: %.2f%% (%d/%d)", "rate * 100, part, n", f"COUNT({c})")
        add("data_freshness", table, source, stamp, "FRESHNESS", "MAX(0.0::DOUBLE)", 24, "rate <= 24",
            _severity("LOW", [("> 48", "CRITICAL"), ("> 24", "HIGH")]), "Data is %.1f hours old", "rate")
        for c in keys:
            add("data_uniqueness", table, source, c, "UNIQUENESS", f"CAST(COUNT(DISTINCT {c}) AS DOUBLE) / COUNT(*)", 1.0, "rate = 1",
                _severity("MEDIUM", [("< 0.9", "HIGH")]), "Uniqueness rate: %.2f%% (%d/%d)", "rate * 100, part, n", f"COUNT(DISTINCT {c})")
        if source == "dashboard":
            for name, c, bad, text in (
                ("revenue_validity", "revenue_30d", "revenue_30d < 0", "Revenue validity: %.2f%% (%d negative values)"),
                ("health_score_validity", "overall_health_score", "overall_health_score NOT BETWEEN 0 AND 100", "Health score validity: %.2f%% (%d invalid values)"),
            ):
                add(name, table, source, c, "VALIDITY", f"CAST(COUNT(*) - COUNT_IF({bad}) AS DOUBLE) / COUNT(*)", 1.0, "rate = 1",
                    _severity("MEDIUM", [("< 0.95", "HIGH")]), text, "rate * 100, part", f"COUNT_IF({bad})")
            odd = "COUNT_IF(revenue_30d > 50000 AND overall_health_score < 30)"
            add(
                "revenue_health_consistency", table, source, None, "BUSINESS_RULE", f"CAST(COUNT(*) - {odd} AS DOUBLE) / COUNT(*)", 0.95, "rate >= 0.95",
                _severity("LOW", [("< 0.9", "MEDIUM")]), "Revenue-health consistency: %.2f%% (%d anomalous)", "rate * 100, part", odd, "WARN",
            )
    parts.append("SELECT 'table_accessibility', 'broken', NULL, 'SYSTEM', 'FAIL', 0, 1, 'HIGH', 'Table check failed: cannot read'")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) AS m({_RESULT_COLS})"


def _broken():
    raise ValueError("cannot read")


def _results(t, dash=dashboard, days=summary):
    tables = {
        monitor.PARTNER_DASHBOARD: lambda: dash(t), monitor.FINANCIAL_SUMMARY: lambda: days(t),
        "missing": lambda: None, "broken": _broken,
    }
    return monitor.run_checks(t.spark, tables, NOW, PARAMS)


register(
    "monitor_results",
    "check_name:s table_name:s column_name:s check_type:s status:s value:d threshold:d severity:s message:s",
    mart_sql(_monitor_sql()),
)(_results)

_Z = f"""
SELECT *, (x - m) / NULLIF(s, 0) AS z_score
FROM (SELECT *, CAST(daily_revenue AS DOUBLE) AS x, AVG(CAST(daily_revenue AS DOUBLE)) OVER (g) AS m, STDDEV_POP(CAST(daily_revenue AS DOUBLE)) OVER (g) AS s,
             COUNT(*) OVER (g) AS n, ROW_NUMBER() OVER (PARTITION BY partner_channel, customer_segment ORDER BY order_date DESC, product_category DESC) AS back
      FROM summary WHERE order_date >= {TODAY} - 30 WINDOW g AS (PARTITION BY partner_channel, customer_segment)) AS a
WHERE n >= 7 AND back <= 3 AND ABS((x - m) / NULLIF(s, 0)) > 2
"""
register(
    "zscore_recent",
    "order_date:t partner_channel:s customer_segment:s product_category:s daily_revenue:d mean_revenue:d z_score:d",
    mart_sql("SELECT *, m AS mean_revenue FROM z", z=_Z),
)(lambda t: monitor.revenue_zscores(summary(t), PARAMS))

_ANOMALY_OUT = """table_name:s metric_name:s current_value:d expected_value:d deviation:d anomaly_score:d is_anomaly:b partner_channel:s
    customer_segment:s"""


def _flat(df):
    return df.withColumns({k: F.col("context")[k] for k in ("partner_channel", "customer_segment")})


_GROWTH = f"""SELECT '{monitor.PARTNER_DASHBOARD}' AS table_name, 'order_volume_growth' AS metric_name, order_growth_30d AS current_value, 0 AS expected_value,
    ABS(order_growth_30d) AS deviation, ABS(order_growth_30d) / 0.25 AS anomaly_score, TRUE AS is_anomaly, partner_channel, customer_segment
    FROM dashboard WHERE ABS(order_growth_30d) > 0.25"""
register("growth_anomalies", _ANOMALY_OUT, mart_sql(_GROWTH))(
    lambda t: _flat(monitor.volume_anomalies(dashboard(t), NOW, PARAMS))
)


def _with_costs(t):
    """Dashboard on all lines with a cost of 135 % of revenue for merchant-shipped and 75 % for other lines."""
    cost = F.col("revenue") * F.when(F.col("fulfillment_type") == "Merchant", F.lit("1.35").cast("decimal(3,2)")).otherwise(F.lit("0.75").cast("decimal(3,2)"))
    lines = t.base_once.withColumn("cost", cost)
    return partner.partner_dashboard(partner.daily_partner_metrics(lines, staged=True), finance.financial_performance(lines, "cost"), PARAMS)


_COSTED = f"""
SELECT partner_channel, customer_segment, AVG(margin) AS margin
FROM (SELECT partner_channel, customer_segment, order_date, product_category, product_sku,
             1 - CAST(SUM(revenue * CASE WHEN fulfillment_type = 'Merchant' THEN CAST(1.35 AS DECIMAL(3,2)) ELSE CAST(0.75 AS DECIMAL(3,2)) END) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) AS margin
      FROM base WHERE order_date >= {TODAY} - 30 GROUP BY ALL) AS a GROUP BY 1, 2
"""
register(
    "margin_anomalies", _ANOMALY_OUT,
    sql(
        f"""SELECT '{monitor.PARTNER_DASHBOARD}' AS table_name, 'gross_margin' AS metric_name, margin AS current_value, 0.2 AS expected_value, ABS(margin - 0.2) AS deviation,
                   ABS(margin - 0.2) / 0.2 AS anomaly_score, TRUE AS is_anomaly, partner_channel, customer_segment FROM costed WHERE margin < 0""",
        costed=_COSTED,
    ),
)(lambda t: _flat(monitor.margin_anomalies(_with_costs(t), NOW)))


def _found(t):
    """Check results and anomalies, staged one after the other from the same lines, which are gone then; reports read them several times."""
    lines = t.base_once
    dash, days = stage(dashboard(t), "dashboard"), finance.financial_summary(finance.financial_performance(lines, rows=t.rows), PARAMS)
    results = stage(_results(t, lambda t: dash, lambda t: days), "results")
    anomalies = monitor.revenue_anomalies(days, NOW, PARAMS).unionByName(monitor.volume_anomalies(dash, NOW, PARAMS))
    anomalies = stage(anomalies, "anomalies")
    unstage(lines)
    del t.base_once
    return results, anomalies


_FOUND = f"""
SELECT '{monitor.FINANCIAL_SUMMARY}' AS table_name, 'daily_revenue' AS metric_name, ABS(z_score) AS score FROM z
UNION ALL SELECT table_name, metric_name, anomaly_score FROM ({_GROWTH}) AS g
"""
_STATUS = ("PASS", "FAIL", "WARN")


def _report_ctes():
    return {"results": _monitor_sql(), "z": _Z, "found": _FOUND}


register(
    "quality_report", "section:s item:s figure:d",
    mart_sql(
        f"""SELECT 'summary' AS section, item, figure FROM (
                SELECT UNNEST(['total_checks', 'passed_checks', 'failed_checks', 'warning_checks', 'success_rate']) AS item,
                       UNNEST([COUNT(*)::DOUBLE, {', '.join(f"COUNT_IF(status = '{s}')::DOUBLE" for s in _STATUS)}, COUNT_IF(status = 'PASS')::DOUBLE / COUNT(*)]) AS figure FROM results) AS s
        UNION ALL SELECT 'severity_breakdown', severity, COUNT(*) FROM results GROUP BY severity
        UNION ALL SELECT 'table_summary', table_name || ':' || st, COUNT_IF(status = st) FROM results, (VALUES {', '.join(f"('{s}')" for s in _STATUS)}) AS v(st) GROUP BY table_name, st
        UNION ALL SELECT 'anomaly_summary', item, figure FROM (SELECT UNNEST(['total_anomalies', 'high_score_anomalies']) AS item, UNNEST([COUNT(*), COUNT_IF(score > 3)]) AS figure FROM found) AS a
        UNION ALL SELECT 'anomalies_by_metric', metric_name, COUNT(*) FROM found GROUP BY metric_name""", **_report_ctes(),
    ),
)(lambda t: monitor.quality_report(*_found(t)))

@register("monitoring_cycle", "section:s item:s figure:d", REGISTRY["quality_report"].sql)
def _cycle(t):
    """A whole cycle; the figures come from the metrics table that it appends to."""
    folder = new_path(t.spark, "monitor")
    dash, days = stage(dashboard(t), "dashboard"), stage(summary(t), "summary")
    tables = {monitor.PARTNER_DASHBOARD: lambda: dash, monitor.FINANCIAL_SUMMARY: lambda: days, "missing": lambda: None, "broken": _broken}
    monitor.monitoring_cycle(t.spark, tables, folder, NOW, PARAMS)
    found = t.spark.read.parquet(f"{folder}/quality_metrics")
    return found.select(F.col("dimension").alias("section"), F.col("metric_name").alias("item"), F.col("metric_value").alias("figure"))


register(
    "alert_digest", "section:s table_name:s section_size:i position:i line:s",
    mart_sql(
        """SELECT section, table_name, section_size, position, line FROM (
               SELECT *, COUNT(*) OVER (PARTITION BY section) AS section_size, ROW_NUMBER() OVER (PARTITION BY section ORDER BY line) AS position
               FROM (SELECT severity AS section, table_name, table_name || ': ' || message AS line FROM results WHERE severity IN ('CRITICAL', 'HIGH')
                     UNION ALL SELECT 'ANOMALY', table_name, printf('%s: %s anomaly (score: %.2f)', table_name, metric_name, score) FROM found) AS l) AS r
           WHERE position <= 5""", **_report_ctes(),
    ),
)(lambda t: monitor.alert_digest(*_found(t)))
