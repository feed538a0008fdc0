"""Table-level quality: checks, rules, profiles, drift, alerts, audit and run log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType, StringType

from .. import fixed_values as V
from ..functions import hours_between, tier
from ..params import Params
from ..sources.staging import stage


def quality_check(
    df: DataFrame, table: str, now: datetime, primary_key: str | None = None, required: Sequence[str] = (),
    numeric: Sequence[str] = (), dates: Sequence[str] = (),
) -> DataFrame:
    """One wide row of counts, rates, statistics and an overall score, from one aggregation."""
    n = F.count(F.lit(1))
    aggs = [n.alias("total_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_count_{c}") for c in required]
    if primary_key:
        aggs.append(F.count_distinct(primary_key).alias(f"unique_{primary_key}"))
    for c in numeric:
        number = F.col(c).try_cast("double")
        aggs += [
            F.count_if(F.col(c).try_cast("decimal(18,3)").isNull() & F.col(c).isNotNull()).alias(f"invalid_numeric_{c}"),
            F.avg(number).alias(f"avg_{c}"),
            F.stddev_samp(number).alias(f"stddev_{c}"),
            F.min(number).alias(f"min_{c}"),
            F.max(number).alias(f"max_{c}"),
        ]
    for c in dates:
        bad = F.col(c).try_cast("date").isNull() & F.col(c).isNotNull()
        aggs.append(F.count_if(bad).alias(f"invalid_date_{c}"))
    if dates:
        aggs.append(F.max(dates[0]).alias("max_date"))
    return quality_rates(df.agg(*aggs), table, now, primary_key, required, dates)


def quality_rates(
    out: DataFrame, table: str, now: datetime, primary_key: str | None = None, required: Sequence[str] = (), dates: Sequence[str] = (),
) -> DataFrame:
    """Rates and the overall score beside the counts of a table."""
    total = F.col("total_rows")

    def share(col):
        return F.try_divide(col.cast("double"), total.cast("double"))

    parts = [share(F.col(f"null_count_{c}")) for c in required]
    cols = {f"null_rate_{c}": F.round(share(F.col(f"null_count_{c}")) * 100, 2) for c in required}
    if primary_key:
        duplicates = total - F.col(f"unique_{primary_key}")
        cols[f"duplicate_count_{primary_key}"] = duplicates
        parts.append(share(duplicates))
    if dates:
        cols["hours_since_last_update"] = hours_between("max_date", F.lit(now))
    if parts:
        defect = reduce(lambda a, b: a + b, parts) / len(parts)
        cols["quality_score"] = F.round((1 - defect) * 100, 2)
    return out.withColumns(cols).withColumn("table_name", F.lit(table))


def business_rules(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    """Rows violating each named condition; a condition that is NULL is no violation."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~F.expr(cond)).alias(f"violations_{name}") for name, cond in rules.items()],
    ).withColumns({"table_name": F.lit(table), **{f"rule_{n}_description": F.lit(c) for n, c in rules.items()}})


def lineage_record(
    spark: SparkSession, target: str, sources: Sequence[str], kind: str, run_id: str, started: datetime,
) -> DataFrame:
    cols = {"target_table": target, **{f"source_table_{i}": s for i, s in enumerate(sources, 1)}}
    cols |= {"transformation_type": kind, "processed_at": started, "run_id": run_id}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


def run_log(df: DataFrame, model: str, run_id: str, started: datetime, completed: datetime) -> DataFrame:
    """Row count, duration and status of a finished build, ready to append to the run log."""
    return df.agg(F.count(F.lit(1)).alias("rows_affected")).select(
        F.lit(run_id).alias("run_id"), F.lit(model).alias("model_name"), F.lit("success").alias("status"),
        F.lit(int((completed - started).total_seconds())).alias("execution_time"), "rows_affected",
        F.lit(started).alias("run_started_at"), F.lit(completed).alias("run_completed_at"),
    )


def drawn(keys: Sequence[str], percent: float, seed: int = 7) -> Column:
    """Whether a row belongs to a sample of ``percent``: the first 32 bits of the MD5 of seed and keys lie below that share.

    The draw depends on the key alone, so any engine, layout or repeated run draws the same rows.
    """
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys]
    bits = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("bigint")
    return bits < int(percent / 100 * 2**32)


def profile_table(
    df: DataFrame, table: str, sample_percent: float | None = None, seed: int = 7, keys: Sequence[str] | None = None,
) -> DataFrame:
    """One row per column: nulls, distinct values, number or text-length statistics.

    The rows are staged once.  Plain statistics of all columns come from one aggregation;
    each distinct count then reads its own column only, which moves far less than several
    distinct counts in one aggregation.  ``sample_percent`` reads a sample drawn by
    ``keys`` (all columns if not given: equal rows are then drawn together); the default profiles every row.
    """
    if sample_percent is not None:
        df = df.filter(drawn(keys or df.columns, sample_percent, seed))
    df = stage(df, "profile")
    stats = ("avg", "min", "max", "stddev", "avg_length", "min_length", "max_length")
    aggs, none = [F.count(F.lit(1)).alias("sample_size")], F.lit(None)
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        cells = {}
        if isinstance(f.dataType, NumericType):
            x = c.cast("double")
            cells |= {"avg": F.avg(x), "min": F.min(x), "max": F.max(x), "stddev": F.stddev_samp(x)}
        if isinstance(f.dataType, StringType):
            size = F.length(c)
            cells |= {"avg_length": F.avg(size), "min_length": F.min(size), "max_length": F.max(size)}
        aggs.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"),
            F.count_if(c.isNull()).alias("null_count"), *[cells.get(s, none).cast("double").alias(s) for s in stats],
        ).alias(f"__{f.name}"))
    columns = F.array(*[F.col(f"`__{f.name}`") for f in df.schema])
    rows = df.agg(*aggs).select("sample_size", F.explode(columns).alias("c")).select("sample_size", "c.*")
    distinct = reduce(DataFrame.unionByName, (
        df.select(F.col(f"`{name}`").alias("v")).distinct().agg(F.count("v").alias("distinct_count")).withColumn(
            "column_name", F.lit(name)
        )
        for name in df.columns
    ))
    return rows.join(distinct, "column_name").select(
        F.lit(table).alias("table_name"), "sample_size", "column_name", "column_type", "null_count", "distinct_count", *stats,
    )


def detect_drift(
    df: DataFrame, table: str, date_column: str, baseline: date, current: date, columns: Sequence[str],
) -> DataFrame:
    """Mean shift in baseline standard deviations per column, and change of volume, between two days.

    Both days are read in one pass; ranges on the column itself, not on its date, reach the scan.
    """
    def on(day: date) -> Column:
        return (F.col(date_column) >= F.lit(day)) & (F.col(date_column) < F.lit(day + timedelta(days=1)))

    is_base, is_now = on(baseline), on(current)
    aggs = [F.count_if(is_base).alias("baseline_count"), F.count_if(is_now).alias("current_count")]
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.avg(F.when(is_base, x)).alias(f"baseline_avg_{c}"),
            F.stddev_samp(F.when(is_base, x)).alias(f"baseline_stddev_{c}"),
            F.avg(F.when(is_now, x)).alias(f"current_avg_{c}"),
        ]
    out = df.filter(is_base | is_now).agg(*aggs)
    change = F.abs(F.col("current_count") - F.col("baseline_count")) * 100.0
    out = out.withColumns({
        "table_name": F.lit(table), "baseline_date": F.lit(baseline), "current_date": F.lit(current),
        **{
            f"drift_zscore_{c}": F.try_divide(
                F.abs(F.col(f"current_avg_{c}") - F.col(f"baseline_avg_{c}")), F.col(f"baseline_stddev_{c}")
            )
            for c in columns
        },
        "volume_drift_percent": F.try_divide(change.cast("double"), F.col("baseline_count").cast("double")),
    })
    out = out.withColumns({
        **{f"drift_severity_{c}": tier(f"drift_zscore_{c}", V.DRIFT_SEVERITY) for c in columns},
        "volume_drift_severity": tier("volume_drift_percent", V.VOLUME_SEVERITY),
    })
    return out.select(
        "table_name", "baseline_date", "current_date",
        *[f"drift_{k}_{c}" for c in columns for k in ("zscore", "severity")],
        "volume_drift_percent", "volume_drift_severity",
    )


def quality_alerts(check: DataFrame, p: Params, threshold: float = 0.8) -> DataFrame:
    """Alert level and message for the rows of :func:`quality_check`."""
    score = F.col("quality_score")
    low, warn = threshold * 100, (threshold + 0.1) * 100
    return check.withColumns({
        "alert_level": tier(score, V.Bands("<", ((low, "CRITICAL"), (warn, "WARNING")), "HEALTHY")),
        "alert_message": F.when(score < low, "Data quality below threshold")
        .when(F.col("hours_since_last_update") > p.freshness_hours, "Data freshness issue")
        .otherwise("No issues detected"),
    })


def quality_dashboard(checks: Sequence[DataFrame], p: Params) -> DataFrame:
    """Totals, issue rates and overall status over the checks of several tables."""
    cols = ("table_name", "quality_score", "total_rows", "hours_since_last_update")
    rows = reduce(DataFrame.unionByName, (c.select(*cols) for c in checks))
    out = rows.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.avg("quality_score").alias("avg_quality_score"),
        F.min("quality_score").alias("min_quality_score"),
        F.sum("total_rows").alias("total_rows_monitored"),
        F.max("hours_since_last_update").alias("max_hours_since_update"),
        F.count_if(F.col("quality_score") < 80).alias("tables_with_issues"),
        F.count_if(F.col("hours_since_last_update") > p.freshness_hours).alias("stale_tables"),
    )

    def rate(c):
        return F.round(F.try_divide(F.col(c) * 100.0, F.col("total_tables")), 2)

    return out.withColumns({
        "quality_issue_rate": rate("tables_with_issues"),
        "freshness_issue_rate": rate("stale_tables"),
        "overall_health_status": tier("avg_quality_score", V.QUALITY_STATUS),
    })


def default_key(table: str) -> str:
    """Key column by naming convention: fct_x and dim_x have x_key, others id."""
    for prefix in ("fct_", "dim_"):
        if table.startswith(prefix):
            return table.removeprefix(prefix) + "_key"
    return "id"


def default_date(table: str) -> str:
    return "order_date" if table.startswith("fct_") else "created_at"


def audit_summary(df: DataFrame, table: str, key: str | None = None, date_column: str | None = None) -> DataFrame:
    k, d = key or default_key(table), date_column or default_date(table)
    return df.agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct(k).alias("unique_key_count"),
        F.min(d).alias("min_date"), F.max(d).alias("max_date"),
    ).withColumn("model_name", F.lit(table))
