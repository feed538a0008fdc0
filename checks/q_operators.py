"""Parameterised operators on the derived sales lines, events and given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import fixed_values as V
from tallyloom.functions import business_days, cents_to_dollars, concat_skip_nulls, hours_between, month_diff, safe_divide, safe_int
from tallyloom.operators import attribution, cohorts, customers, ordered, partners, recommend, reshape, series
from tallyloom.sources.staging import stage

from . import sqlgen as q

from .q_staging import sql
from .spec import register
from .tables import PARAMS, TODAY

_LTV_BASE = f"""
SELECT customer_id, COUNT(DISTINCT order_date) AS days, {q.avg('revenue')} AS avg_order_value, SUM(revenue) AS total_revenue,
       MIN(order_date) AS first_day, MAX(order_date) AS last_day, date_diff('day', MIN(order_date), MAX(order_date)) AS customer_lifespan_days
FROM lines GROUP BY 1
"""
register(
    "customer_ltv",
    """customer_id:i purchase_frequency:i avg_order_value:d total_revenue:d first_purchase:t last_purchase:t customer_lifespan_days:i
    predicted_ltv:d ltv_segment:s""",
    sql(
        f"""SELECT *, {q.bands('predicted_ltv', V.Bands('>', ((5000, 'High Value'), (2500.0, 'Medium Value')), 'Low Value'))} AS ltv_segment
        FROM (SELECT *, days AS purchase_frequency, first_day AS first_purchase, last_day AS last_purchase,
                     CASE WHEN customer_lifespan_days > 0 THEN {q.div('total_revenue', 'customer_lifespan_days')} * 365 * 1.0::DOUBLE
                          ELSE avg_order_value * days END AS predicted_ltv FROM per_customer) AS l""",
        per_customer=_LTV_BASE,
    ),
)(lambda t: customers.customer_ltv(t.lines, "customer_id", "revenue", "order_date", PARAMS))

register(
    "customer_lifetime_value",
    "customer_id:i frequency:i avg_order_value:d total_revenue:d first_order_date:t last_order_date:t customer_lifespan_days:i estimated_clv:d",
    sql(
        f"""SELECT *, days AS frequency, first_day AS first_order_date, last_day AS last_order_date,
                   CASE WHEN customer_lifespan_days > 0 THEN days * avg_order_value * 12 / (customer_lifespan_days / 30.0::DOUBLE)
                        ELSE avg_order_value END AS estimated_clv FROM per_customer""",
        per_customer=_LTV_BASE,
    ),
)(lambda t: customers.customer_lifetime_value(t.lines, "customer_id", "revenue", "order_date"))

register(
    "rfm",
    "customer_id:i last_purchase_date:t frequency:i monetary_value:d recency_days:i recency_score:i frequency_score:i monetary_score:i rfm_segment:s",
    sql(
        f"""SELECT *, {q.rules(V.RFM_SEGMENT)} AS rfm_segment
        FROM (SELECT *, NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS recency_score,
                     NTILE(5) OVER (ORDER BY frequency, customer_id) AS frequency_score,
                     NTILE(5) OVER (ORDER BY monetary_value, customer_id) AS monetary_score
              FROM (SELECT customer_id, last_day AS last_purchase_date, days AS frequency, total_revenue AS monetary_value,
                           date_diff('day', last_day, {TODAY}) AS recency_days FROM per_customer) AS a) AS b""",
        per_customer=_LTV_BASE,
    ),
)(lambda t: customers.rfm(t.lines, "customer_id", "order_date", "revenue", PARAMS))

register(
    "cohort_retention",
    "cohort_month:t period_number:i customers:i revenue:d cohort_size:i retention_rate:d revenue_per_cohort_user:d",
    sql(
        f"""SELECT c.*, s.customers AS cohort_size, {q.div('c.customers', 's.customers')} AS retention_rate,
                   {q.div('c.revenue', 's.customers')} AS revenue_per_cohort_user
        FROM cells c LEFT JOIN (SELECT * FROM cells WHERE period_number = 0) AS s USING (cohort_month)""",
        cells="""SELECT CAST(date_trunc('month', first_day) AS DATE) AS cohort_month, date_diff('month', first_day, order_date) AS period_number,
                        COUNT(DISTINCT customer_id) AS customers, SUM(revenue) AS revenue
                 FROM lines JOIN (SELECT customer_id, MIN(order_date) AS first_day FROM lines GROUP BY 1) AS f USING (customer_id) GROUP BY 1, 2""",
    ),
)(lambda t: cohorts.cohort_retention(t.lines, "customer_id", "order_date", "revenue"))

register(
    "monthly_activity",
    "cohort_month:t period_number:i users:i total_revenue:d cohort_size:i retention_rate:d revenue_per_user:d",
    sql("""SELECT CAST(date_trunc('month', order_date) AS DATE) AS cohort_month, 0 AS period_number, COUNT(DISTINCT customer_id) AS users,
                  SUM(revenue) AS total_revenue, COUNT(DISTINCT customer_id) AS cohort_size, 100.0 AS retention_rate,
                  ROUND(CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT customer_id) + 1e-9, 2) AS revenue_per_user FROM lines GROUP BY 1"""),
)(lambda t: cohorts.monthly_activity(t.lines, "customer_id", "order_date", "revenue"))

_DAY = "ORDER BY order_date"
register(
    "ts_features",
    """order_date:t revenue:d row_num:i lag_1:d lag_7:d lag_30:d rolling_avg_7:d rolling_avg_30:d rolling_avg_90:d day_of_week:i
    day_of_month:i week_of_year:i month_of_year:i quarter_of_year:i trend:i trend_squared:i""",
    sql(f"""SELECT *, row_num AS trend, row_num * row_num AS trend_squared
            FROM (SELECT *, ROW_NUMBER() OVER ({_DAY}) AS row_num, {', '.join(f'LAG(revenue, {n}) OVER ({_DAY}) AS lag_{n}' for n in (1, 7, 30))},
                         {', '.join(f"{q.avg_over('revenue', f'{_DAY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW')} AS rolling_avg_{n}" for n in (7, 30, 90))},
                         dayofweek(order_date) AS day_of_week, day(order_date) AS day_of_month, weekofyear(order_date) AS week_of_year,
                         month(order_date) AS month_of_year, quarter(order_date) AS quarter_of_year
                  FROM (SELECT order_date, SUM(revenue) AS revenue FROM lines GROUP BY 1) AS d) AS f"""),
)(lambda t: series.time_series_features(t.lines, "order_date", "revenue"))

register(
    "anomaly_zscore",
    "line_key:s revenue:d z_score:d is_anomaly:b",
    sql("""SELECT line_key, revenue, z AS z_score, ROUND(z, 9) > 3 AS is_anomaly
           FROM (SELECT line_key, revenue, ABS((CAST(revenue AS DOUBLE) - m) / NULLIF(s, 0)) AS z
                 FROM lines, (SELECT AVG(CAST(revenue AS DOUBLE)) AS m, STDDEV_SAMP(CAST(revenue AS DOUBLE)) AS s FROM lines) AS st) AS x"""),
)(lambda t: series.zscore_anomalies(t.lines.select("line_key", "revenue"), "revenue", PARAMS))

register(
    "anomaly_iqr",
    "line_key:s revenue:d iqr:d is_anomaly:b",
    sql("""SELECT line_key, revenue, q3 - q1 AS iqr, CAST(revenue AS DOUBLE) < q1 - 1.5 * (q3 - q1) OR CAST(revenue AS DOUBLE) > q3 + 1.5 * (q3 - q1) AS is_anomaly
           FROM lines, (SELECT quantile_cont(CAST(revenue AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(revenue AS DOUBLE), 0.75) AS q3 FROM lines) AS st"""),
)(lambda t: series.iqr_anomalies(t.lines.select("line_key", "revenue"), "revenue", PARAMS))

_MATRIX = "SELECT customer_id, product_sku, COUNT(*) AS interaction_count, AVG(CAST(quantity AS DOUBLE)) AS avg_rating FROM lines GROUP BY 1, 2"
register(
    "recommend_features",
    """customer_id:i product_sku:s interaction_count:i avg_rating:d user_count:i avg_product_rating:d total_interactions:i
    user_product_rank:i""",
    sql(
        """SELECT m.*, p.user_count, p.avg_product_rating, p.total_interactions, RANK() OVER (PARTITION BY customer_id ORDER BY avg_rating DESC) AS user_product_rank
        FROM matrix m JOIN (SELECT product_sku, COUNT(DISTINCT customer_id) AS user_count, AVG(avg_rating) AS avg_product_rating,
                                   SUM(interaction_count) AS total_interactions FROM matrix GROUP BY 1) AS p USING (product_sku)""",
        matrix=_MATRIX,
    ),
)(lambda t: recommend.recommendation_features(t.lines, "customer_id", "product_sku", "quantity"))

_SCORES = ("revenue_score", "volume_score", "aov_score", "satisfaction_score")
register(
    "partner_score",
    """total_revenue:d total_orders:i avg_order_value:d avg_satisfaction:d revenue_score:d volume_score:d aov_score:d satisfaction_score:d
    total_performance_score:d performance_grade:s""",
    sql(f"""SELECT *, {q.bands('total_performance_score', V.PARTNER_GRADE)} AS performance_grade
            FROM (SELECT *, {' + '.join(_SCORES)} AS total_performance_score
                  FROM (SELECT *, LEAST(40, CAST(total_revenue AS DOUBLE) / 2000000 * 40) AS revenue_score, LEAST(30, CAST(total_orders AS DOUBLE) / 1000 * 30) AS volume_score,
                               LEAST(20, avg_order_value / 1000 * 20) AS aov_score, avg_satisfaction / 5.0 * 10 AS satisfaction_score
                        FROM (SELECT SUM(revenue) AS total_revenue, SUM(quantity) AS total_orders, {q.avg('revenue')} AS avg_order_value,
                                     5.0::DOUBLE AS avg_satisfaction FROM lines) AS a) AS b) AS c"""),
)(lambda t: partners.partner_performance_score(t.lines, "revenue", "quantity", PARAMS))

register(
    "seasonal_adjustment",
    "line_key:s order_date:t revenue:d quarter:i seasonal_factor:d seasonally_adjusted_value:d",
    sql(f"""SELECT line_key, order_date, revenue, quarter(order_date) AS quarter, f AS seasonal_factor, CAST(revenue AS DOUBLE) / f AS seasonally_adjusted_value
            FROM lines JOIN (SELECT quarter(order_date) AS qu, {q.avg('revenue')} / (SELECT {q.avg('revenue')} FROM lines) AS f FROM lines GROUP BY 1) AS s
                 ON quarter(order_date) = qu"""),
)(lambda t: series.seasonal_adjustment(t.lines.select("line_key", "order_date", "revenue"), "order_date", "revenue"))

for _name, _model, _dir in (("attr_first", "first_touch", ""), ("attr_last", "last_touch", "DESC")):
    register(
        _name,
        "user_id:i event_type:s touch_rank:i",
        f"""SELECT * FROM (SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts {_dir}, event_id {_dir}) AS touch_rank
                           FROM events) AS r WHERE touch_rank = 1""",
    )(lambda t, m=_model: attribution.attribution(t.given("events"), "event_type", "user_id", ["ts", "event_id"], m))
register(
    "attr_linear",
    "user_id:i event_type:s total_touches:i attribution_weight:d",
    "SELECT user_id, event_type, COUNT(*) OVER (PARTITION BY user_id) AS total_touches, 1.0 / COUNT(*) OVER (PARTITION BY user_id) AS attribution_weight FROM events",
)(lambda t: attribution.attribution(t.given("events"), "event_type", "user_id", ["ts"], "linear"))

register(
    "pivot_table",
    "product_category:s amazon:d international:d merchant_website:d",
    sql(f"""SELECT product_category, {', '.join(f"SUM(CASE WHEN partner_channel = '{c}' THEN revenue ELSE 0 END) AS {c}" for c in V.CHANNELS)}
            FROM lines GROUP BY 1"""),
)(lambda t: reshape.pivot_table(t.lines, ["product_category"], "partner_channel", "revenue", values=V.CHANNELS))


register(
    "business_days",
    "order_date:t ship_date:t business_days:i n:i",
    sql(
        """SELECT p.order_date, p.ship_date, CASE WHEN ship_date >= order_date THEN (SELECT COUNT(*) FROM cal WHERE d >= order_date AND d < ship_date AND wd)
                  ELSE -(SELECT COUNT(*) FROM cal WHERE d >= ship_date AND d < order_date AND wd) END AS business_days, n
           FROM (SELECT order_date, ship_date, COUNT(*) AS n FROM lines GROUP BY 1, 2) AS p""",
        cal="""SELECT CAST(d AS DATE) AS d, dayofweek(d) NOT IN (0, 6) AS wd
               FROM (SELECT unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2002-12-31', INTERVAL 1 DAY)) AS d) AS s""",
    ),
)(lambda t: t.lines.groupBy("order_date", "ship_date").agg(F.count(F.lit(1)).alias("n")).withColumn(
    "business_days", business_days("order_date", "ship_date")
))

_COMBO = "product_category, product_style, product_asin"
register(
    "duplicate_keys",
    "product_sku:s combinations:i",
    sql(f"""SELECT product_sku, COUNT(*) AS combinations FROM (SELECT DISTINCT product_sku, {_COMBO} FROM base) AS c
            GROUP BY 1 HAVING COUNT(*) > 1"""),
)(lambda t: reshape.duplicate_keys(t.base, "product_sku", _COMBO.split(", "), t.rows))

register(
    "row_hash_changes",
    "order_id:i old_hash:s new_hash:s change_type:s",
    """SELECT *, CASE WHEN old_hash IS NULL THEN 'added' WHEN new_hash IS NULL THEN 'removed' ELSE 'changed' END AS change_type
       FROM (SELECT o_orderkey AS order_id, md5(o_orderstatus) AS old_hash FROM orders) AS a
       FULL JOIN (SELECT l_orderkey AS order_id, md5(CASE WHEN COUNT(DISTINCT l_linestatus) > 1 THEN 'P' ELSE MIN(l_linestatus) END) AS new_hash
                  FROM lineitem GROUP BY 1) AS b USING (order_id)
       WHERE old_hash IS DISTINCT FROM new_hash""",
)(lambda t: _versions(t))


def _versions(t):
    """Order states as stored, against the states that follow from all their lines."""
    stored = t.given("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("state"))
    mixed = F.min("l_linestatus") != F.max("l_linestatus")
    derived = t.given("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.when(mixed, "P").otherwise(F.min("l_linestatus")).alias("state"))
    return reshape.row_hash_changes(stored, derived, ["order_id"], ["state"])


register(
    "exact_percentiles",
    "partner_channel:s p25:d p50:d p90:d",
    sql(f"""SELECT partner_channel, {', '.join(f'quantile_cont(CAST(revenue AS DOUBLE), {p}) AS p{int(p * 100)}' for p in (0.25, 0.5, 0.9))}
            FROM lines GROUP BY 1"""),
)(lambda t: ordered.exact_percentiles(t.lines.select("partner_channel", "revenue"), ["partner_channel"], "revenue", {"p25": 0.25, "p50": 0.5, "p90": 0.9}))

register(
    "most_frequent",
    "partner_channel:s top_style:s",
    sql("""SELECT partner_channel, product_style AS top_style
           FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY partner_channel ORDER BY n DESC, product_style) AS rn
                 FROM (SELECT partner_channel, product_style, COUNT(*) AS n FROM lines GROUP BY 1, 2) AS c) AS r WHERE rn = 1"""),
)(lambda t: ordered.most_frequent(t.lines, ["partner_channel"], "product_style", "top_style"))

register(
    "split_windows",
    "line_key:s position:i running_revenue:d previous_revenue:d mean_30:d tenth:i",
    sql(f"""SELECT line_key, ROW_NUMBER() OVER (w) AS position, SUM(revenue) OVER (w ROWS UNBOUNDED PRECEDING) AS running_revenue,
                   LAG(revenue) OVER (w) AS previous_revenue,
                   CAST(SUM(revenue) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / COUNT(*) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS mean_30,
                   NTILE(10) OVER (ORDER BY revenue, line_key) AS tenth
            FROM lines WINDOW w AS (PARTITION BY partner_channel ORDER BY order_date, line_key)"""),
)(lambda t: _split_windows(t))


def _split_windows(t):
    """The ordered operators on few large groups."""
    from tallyloom.functions import mean_over

    lines = stage(t.lines.select("line_key", "partner_channel", "order_date", "revenue"), "lines")
    order, keys, rows = ordered.by("order_date", "line_key"), ["partner_channel"], lines.count()
    df = ordered.running_sums(lines, keys, order, {"running_revenue": F.col("revenue"), "position": F.lit(1)}, at_most=rows)
    df = ordered.with_frames(stage(df, "sums"), keys, order, lambda w: {
        "previous_revenue": F.lag("revenue", 1).over(w), "mean_30": mean_over("revenue", w.rowsBetween(-29, 0)),
    }, reach=29, at_most=rows)
    return ordered.ntile_scores(df, 10, {"tenth": ordered.by("revenue", "line_key")})


register(
    "scalar_semantics",
    "line_key:s months:i hours:i ratio:d dollars:d units:i text:s",
    sql("""SELECT line_key, date_diff('month', order_date, ship_date) AS months,
                  date_diff('hour', CAST(order_date AS TIMESTAMP) + INTERVAL (quantity) MINUTE, CAST(ship_date AS TIMESTAMP)) AS hours,
                  CAST(revenue AS DOUBLE) / NULLIF(CAST(discount AS DOUBLE), 0) AS ratio, quantity / 100.0 AS dollars,
                  TRY_CAST(CAST(revenue AS VARCHAR) AS INTEGER) AS units, concat(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END, product_style) AS text
           FROM lines"""),
)(lambda t: t.lines.select(
    "line_key",
    month_diff("order_date", "ship_date").alias("months"),
    hours_between(F.expr("cast(order_date as timestamp) + make_interval(0, 0, 0, 0, 0, quantity)"), F.col("ship_date").cast("timestamp")).alias("hours"),
    safe_divide("revenue", "discount").alias("ratio"),
    cents_to_dollars("quantity").alias("dollars"),
    safe_int(F.col("revenue").cast("string")).alias("units"),
    concat_skip_nulls(F.when(F.col("l_linenumber") != 1, F.col("l_returnflag")), "product_style").alias("text"),
))


