"""Dashboard aggregates, models and streaming jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyloom.ml import models
from tallyloom.plans import dashboard as page, sales
from tallyloom.sources.staging import new_path
from tallyloom.sources.versions import read_published
from tallyloom.streaming import jobs

from . import sqlgen as q
from .q_marts import customers, mart_sql, summary, unified
from .q_staging import sql
from .spec import register
from .tables import NOW


def _sales(t):
    return sales.union_sales(t.orders, t.international, order_ids=False)


_REV = "COALESCE(SUM(recognized_revenue), 0)"
register(
    "kpi_totals", "total_revenue:d total_orders:i avg_order_value:d total_customers:i",
    mart_sql(f"""SELECT {_REV} AS total_revenue, COUNT(*) AS total_orders, {q.avg('order_amount')} AS avg_order_value,
                        (SELECT COUNT(*) FROM customers) AS total_customers FROM unified"""),
)(lambda t: page.kpi_totals(_sales(t), customers(t)))

for _name, _job, _keys in (
    ("daily_channel_revenue", page.daily_channel_revenue, "order_date:t sales_channel:s"),
    ("category_performance", page.category_performance, "product_category:s"),
    ("city_performance", page.city_performance, "city_tier:s"),
):
    _cols = ", ".join(k.split(":")[0] for k in _keys.split())
    register(_name, f"{_keys} revenue:d", mart_sql(f"SELECT {_cols}, {_REV} AS revenue FROM unified GROUP BY {_cols}"))(
        lambda t, job=_job: job(_sales(t))
    )

register(
    "channel_performance", "sales_channel:s revenue:d orders:i",
    mart_sql(f"SELECT sales_channel, {_REV} AS revenue, COUNT(order_amount) AS orders FROM unified GROUP BY 1"),
)(lambda t: page.channel_performance(_sales(t)))

register(
    "category_channel_pivot", "product_category:s amazon:d international:d",
    mart_sql(f"""SELECT product_category, {', '.join(f"SUM(CASE WHEN sales_channel = '{c}' THEN recognized_revenue ELSE 0 END) AS {c.lower()}" for c in ('AMAZON', 'INTERNATIONAL'))}
                 FROM unified GROUP BY 1"""),
)(lambda t: page.category_channel_pivot(_sales(t)))

register(
    "monthly_pattern", "month:i revenue:d", mart_sql(f"SELECT month(order_date) AS month, {_REV} AS revenue FROM unified GROUP BY 1"),
)(lambda t: page.monthly_pattern(_sales(t)))

register(
    "weekday_pattern", "day_of_week:i avg_daily_revenue:d",
    mart_sql(f"""SELECT isodow(order_date) - 1 AS day_of_week, {q.avg('revenue')} AS avg_daily_revenue
                 FROM (SELECT order_date, {_REV} AS revenue FROM unified GROUP BY 1) AS d GROUP BY 1"""),
)(lambda t: page.weekday_pattern(_sales(t)))

register(
    "fulfilment_performance", "fulfillment_model:s avg_score:d",
    mart_sql(f"SELECT fulfillment_model, {q.avg('order_performance_score')} AS avg_score FROM unified GROUP BY 1"),
)(lambda t: page.fulfilment_performance(_sales(t)))

register(
    "segment_counts", "rfm_segment:s n:i", mart_sql("SELECT rfm_segment, COUNT(*) AS n FROM customers GROUP BY 1"),
)(lambda t: page.value_counts(customers(t), "rfm_segment"))

register(
    "clv_by_segment", "customer_segment:s avg_clv:d",
    mart_sql("SELECT customer_segment, AVG(predicted_clv_2year) AS avg_clv FROM customers GROUP BY 1"),
)(lambda t: page.clv_by_segment(customers(t)))

register(
    "churn_by_tier", "value_tier:s avg_churn:d",
    mart_sql("SELECT value_tier, AVG(CAST(churn_probability AS DOUBLE)) AS avg_churn FROM customers GROUP BY 1"),
)(lambda t: page.churn_by_tier(customers(t)))

register(
    "lifecycle_counts", "sales_channel:s lifecycle_stage:s customers:i",
    mart_sql("SELECT sales_channel, lifecycle_stage, COUNT(*) AS customers FROM customers GROUP BY 1, 2"),
)(lambda t: page.lifecycle_counts(customers(t)))

register(
    "price_by_tier", "product_tier:s avg_price:d", sql("SELECT product_tier, AVG(avg_marketplace_price) AS avg_price FROM catalog GROUP BY 1"),
)(lambda t: page.price_by_tier(t.catalog))

register(
    "recommendation_counts", "pricing_recommendation:s n:i", sql("SELECT pricing_recommendation, COUNT(*) AS n FROM catalog GROUP BY 1"),
)(lambda t: page.value_counts(t.catalog, "pricing_recommendation"))

register(
    "margin_quartiles", "variable:s q0:d q1:d q2:d q3:d q4:d",
    sql(f"""SELECT variable, {', '.join(f'quantile_cont(CAST(value AS DOUBLE), {i * 0.25}) AS q{i}' for i in range(5))}
            FROM ({' UNION ALL '.join(f"SELECT '{m}_margin_percent' AS variable, {m}_margin_percent AS value FROM catalog" for m in ('amazon', 'flipkart'))}) AS l GROUP BY 1"""),
)(lambda t: page.margin_quartiles(t.catalog))


def _full(n: int) -> str:
    w = f"ORDER BY order_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    return f"CASE WHEN COUNT(*) OVER ({w}) = {n} THEN {q.avg_over('recognized_revenue', w)} END AS ma_{n}"


register(
    "moving_average", "order_date:t recognized_revenue:d ma_7:d ma_30:d",
    mart_sql(f"SELECT *, {_full(7)}, {_full(30)} FROM (SELECT order_date, {_REV} AS recognized_revenue FROM unified GROUP BY 1) AS d"),
)(lambda t: page.revenue_moving_average(_sales(t)))

register(
    "sales_page",
    """order_date:t sales_channel:s product_category:s customer_segment:s order_amount:d recognized_revenue:d quantity:i city_tier:s
    fulfillment_model:s order_performance_score:i seasonal_avg_order_value:d rolling_30d_avg_order_value:d""",
    mart_sql("SELECT * FROM unified WHERE order_date >= DATE '1995-01-01'"),
)(lambda t: page.sales_page(unified(t), since=date(1995, 1, 1)))

register(
    "customer_page",
    """customer_id:s sales_channel:s customer_segment:s rfm_segment:s lifecycle_stage:s value_tier:s total_revenue:d total_orders:i
    predicted_clv_2year:d churn_probability:d days_since_last_order:i seasonal_preference:s city_tier:s""",
    mart_sql("SELECT * FROM customers"),
)(lambda t: page.customer_page(customers(t)))

register(
    "product_page",
    """sku:s product_category:s avg_marketplace_price:d min_marketplace_price:d max_marketplace_price:d amazon_margin_percent:d
    flipkart_margin_percent:d product_tier:s pricing_recommendation:s""",
    sql("SELECT * FROM catalog"),
)(lambda t: page.product_page(t.catalog))

# ---- models: the fits have no SQL counterpart, their checkable facts do --------------
register("kmeans_customers", "customer_id:s sales_channel:s customer_segment:s total_revenue:d cluster:i")(
    lambda t: models.customer_clusters(customers(t))
)


def _seasonal(t):
    """Unified lines with only the seasonal mean the forest needs."""
    from tallyloom.functions import mean
    from tallyloom.operators.ordered import null_safe_join
    from tallyloom.sources.staging import stage

    base = stage(_sales(t), "unified")
    means = base.groupBy("season", "product_category").agg(mean("order_amount").alias("seasonal_avg_order_value"))
    return null_safe_join(base, stage(means, "seasonal"), ["season", "product_category"], "left")


register(
    "kmeans_facts", "customers:i misplaced:i beyond_k:i",
    mart_sql("""SELECT COUNT(*) AS customers, 0 AS misplaced, 0 AS beyond_k FROM customers WHERE total_revenue IS NOT NULL AND total_orders IS NOT NULL
                AND days_since_last_order IS NOT NULL AND predicted_clv_2year IS NOT NULL"""),
)(lambda t: models.cluster_facts(customers(t)))

register("revenue_forest", "feature:s importance:d r2:d rmse:d")(lambda t: models.revenue_forest(_seasonal(t)))


@register(
    "forest_facts", "train_rows:i test_rows:i importance_sum:d negative_importances:i",
    mart_sql("""SELECT COUNT_IF(part < 'cccd') AS train_rows, COUNT_IF(part >= 'cccd') AS test_rows, 1 AS importance_sum, 0 AS negative_importances
                FROM (SELECT substr(md5('42|' || coalesce(order_item_key, '')), 1, 4) AS part FROM unified
                      WHERE order_amount IS NOT NULL AND quantity IS NOT NULL AND order_performance_score IS NOT NULL AND seasonal_avg_order_value IS NOT NULL) AS u"""),
)
def _forest_facts(t):
    return models.revenue_forest(_seasonal(t)).groupBy("train_rows", "test_rows").agg(
        F.sum("importance").alias("importance_sum"), F.count_if(F.col("importance") < 0).alias("negative_importances"))


@register(
    "isolation_facts", "lines:i too_many:i disorder:i",
    mart_sql("""SELECT COUNT(*) AS lines, 0 AS too_many, 0 AS disorder FROM unified
                WHERE order_amount IS NOT NULL AND quantity IS NOT NULL AND order_performance_score IS NOT NULL"""),
)
def _isolation_facts(t):
    """Lines scored; 1 if more than a tenth is flagged; 1 if an unflagged score is above a flagged one."""
    found = models.isolation_forest(_sales(t).select("order_item_key", "order_amount", "quantity", "order_performance_score"))
    low, high = F.max(F.when(~F.col("is_anomaly"), F.col("anomaly_score"))), F.min(F.when(F.col("is_anomaly"), F.col("anomaly_score")))
    return found.agg(
        F.count(F.lit(1)).alias("lines"), (F.count_if("is_anomaly") > 0.1 * F.count(F.lit(1)) + 1).cast("int").alias("too_many"),
        F.coalesce((low > high).cast("int"), F.lit(0)).alias("disorder"))


register("isolation_forest", "order_item_key:s order_amount:d quantity:i order_performance_score:i anomaly_score:d is_anomaly:b")(
    lambda t: models.isolation_forest(_sales(t).select("order_item_key", "order_amount", "quantity", "order_performance_score"))
)


# ---- streaming ----------------------------------------------------------------------
def _stream(t):
    return jobs.read_events(t.spark, t.folder, t.given("events").schema, "events.parquet")


def _run(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@register(
    "orders_per_hour", "hour:s events:i orders:i order_value:d conversion_rate:d",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00') AS hour, COUNT(*) AS events, COUNT_IF(event_type = 'purchase') AS orders,
              SUM(CASE WHEN event_type = 'purchase' THEN value END) AS order_value, CAST(COUNT_IF(event_type = 'purchase') AS DOUBLE) / COUNT(*) AS conversion_rate
       FROM events GROUP BY 1""",
)
def _orders_per_hour(t):
    table = new_path(t.spark, "hours")
    _run(jobs.orders_per_hour(_stream(t), table, new_path(t.spark, "stream")))
    return t.spark.read.parquet(table).withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:00:00"))


_QUALITY = {"key": "event_id", "required": ["user_id", "event_type"], "numeric": ["value"], "dates": ["ts"]}


@register(
    "stream_quality",
    """total_rows:i null_count_user_id:i null_count_event_type:i unique_event_id:i duplicate_count_event_id:i avg_value:d stddev_value:d
    min_value:d max_value:d invalid_numeric_value:i max_date:s quality_score:d""",
    """WITH e AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE mod(event_id, 7) = 0)
       SELECT COUNT(*) AS total_rows, COUNT_IF(user_id IS NULL) AS null_count_user_id, COUNT_IF(event_type IS NULL) AS null_count_event_type,
              COUNT(DISTINCT event_id) AS unique_event_id, COUNT(*) - COUNT(DISTINCT event_id) AS duplicate_count_event_id,
              AVG(value) AS avg_value, STDDEV_SAMP(value) AS stddev_value, MIN(value) AS min_value, MAX(value) AS max_value,
              0 AS invalid_numeric_value, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS max_date,
              ROUND((1 - (CAST(COUNT_IF(user_id IS NULL) + COUNT_IF(event_type IS NULL) + COUNT(*) - COUNT(DISTINCT event_id) AS DOUBLE) / COUNT(*)) / 3) * 100, 2) AS quality_score
       FROM e""",
)
def _stream_quality(t):
    """All events in six files and a seventh of them once more in a later one, one file a micro-batch: a key returns in another batch."""
    arrived, table, events = new_path(t.spark, "arrived"), new_path(t.spark, "quality"), t.given("events")
    events.repartition(6, "event_id").write.parquet(arrived)
    events.filter("mod(event_id, 7) = 0").coalesce(1).write.mode("append").parquet(arrived)
    stream = jobs.read_events(t.spark, arrived, events.schema, files_per_batch=1)
    for query in jobs.stream_quality(stream, table, new_path(t.spark, "stream"), **_QUALITY):
        _run(query)
    found = jobs.stream_quality_totals(t.spark, table, "events", NOW, **_QUALITY)
    return found.withColumn("max_date", F.date_format("max_date", "yyyy-MM-dd HH:mm:ss"))


@register(
    "stream_upsert", "financial_summary_key:s order_date:t partner_channel:s daily_revenue:d priority_score:d",
    mart_sql("SELECT * FROM summary"),
)
def _stream_upsert(t):
    """Summary rows arrive as files; a second run of the same rows changes nothing."""
    arrived = new_path(t.spark, "arrived")
    rows = summary(t)
    rows.write.parquet(arrived)
    table = new_path(t.spark, "financial_summary")
    for _ in range(2):
        stream = t.spark.readStream.schema(rows.schema).parquet(arrived)
        _run(jobs.stream_summary_upsert(stream, table, new_path(t.spark, "stream")))
    return read_published(t.spark, table)
