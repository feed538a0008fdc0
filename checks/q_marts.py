"""Partner, finance, customer, product and cohort marts, and unified sales."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from tallyloom import fixed_values as V
from tallyloom.plans import cohort, customer, finance, partner, product, sales
from tallyloom.sources.staging import new_path, stage
from tallyloom.sources.versions import read_published

from . import sqlgen as q
from .q_staging import sql
from .spec import register
from .tables import PARAMS, TODAY

# ---- daily partner metrics ---------------------------------------------------------
_BY_DAY = "PARTITION BY partner_channel, customer_segment ORDER BY order_date"
_WEEK = f"{_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
_MONTH = f"{_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
DAILY = f"""
SELECT *, CASE WHEN previous_day_revenue > 0 THEN {q.div('daily_revenue - previous_day_revenue', 'previous_day_revenue')} END AS daily_revenue_growth_rate,
       CASE WHEN rolling_7_day_avg_revenue > 0 THEN {q.div('daily_revenue', 'rolling_7_day_avg_revenue')} ELSE 1.0 END AS performance_vs_7_day_avg,
       {q.rules(V.DAILY_TREND)} AS revenue_trend_indicator
FROM (SELECT *, {q.key('partner_channel', 'order_date', 'customer_segment')} AS daily_metrics_key,
             {q.div('valid_records', 'total_records')} AS data_quality_score,
             CAST(daily_revenue AS DOUBLE) * business_day_multiplier AS business_day_adjusted_revenue,
             {q.div('daily_revenue', 'daily_orders')} AS revenue_per_order, {q.div('daily_units_sold', 'daily_orders')} AS units_per_order,
             {q.bands('daily_orders', V.DAILY_VOLUME)} AS volume_tier, {q.div('high_value_orders', 'daily_orders')} AS high_value_order_rate,
             {q.mapped('day_of_week', dict(enumerate(V.DAY_NAMES)))} AS day_name,
             LAG(daily_revenue) OVER ({_BY_DAY}) AS previous_day_revenue,
             {q.avg_over('daily_revenue', _WEEK)} AS rolling_7_day_avg_revenue,
             {q.avg_over('daily_orders', _MONTH)} AS rolling_30_day_avg_orders
      FROM (SELECT partner_channel, order_date, channel_group, customer_segment, quarter, month, day_of_week,
                   COUNT(DISTINCT order_id) AS daily_orders, SUM(quantity) AS daily_units_sold,
                   COUNT(DISTINCT product_sku) AS daily_unique_products, SUM(revenue) AS daily_revenue,
                   {q.avg('revenue')} AS daily_avg_order_value, SUM(revenue_per_unit * quantity) AS daily_revenue_per_unit,
                   {q.avg('fulfilment_efficiency_score')} AS avg_fulfilment_efficiency,
                   {q.avg('estimated_processing_days')} AS avg_processing_days, COUNT(*) AS total_records,
                   COUNT_IF(data_quality_flag = 'valid') AS valid_records,
                   CASE WHEN is_business_day THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS business_day_multiplier,
                   {', '.join(f"COUNT_IF(order_value_tier = '{t}') AS {t.split('_')[0]}_value_orders" for t in V.LINE_VALUE_LABELS)}
            FROM base GROUP BY partner_channel, order_date, channel_group, customer_segment, quarter, month, day_of_week, is_business_day) AS d) AS e
"""

# ---- financial performance and summary ---------------------------------------------
_FIN = "partner_channel, order_date, product_category, product_sku, customer_segment"
FINANCIAL = f"""
SELECT *, total_revenue AS gross_profit, 1.0::DOUBLE AS gross_margin_rate, {q.div('total_revenue', 'total_units_sold')} AS gross_profit_per_unit,
       {q.key(*_FIN.split(', '))} AS financial_performance_key, 'profitable' AS profitability_tier,
       {q.bands('total_revenue', V.REVENUE_SIZE)} AS revenue_size_tier,
       {q.clamp("LEAST(20, CAST(total_revenue AS DOUBLE) / 1000) + LEAST(10, total_orders)")} AS performance_score,
       'green_flag' AS margin_health_flag, 'efficient' AS channel_efficiency_flag
FROM (SELECT {_FIN}, SUM(revenue) AS total_revenue, SUM(quantity) AS total_units_sold, COUNT(DISTINCT order_id) AS total_orders,
             SUM(revenue_per_unit * quantity) AS total_revenue_per_unit_calc, AVG(revenue_per_unit) AS avg_revenue_per_unit
      FROM base GROUP BY {_FIN}) AS f
"""
_GROUP = "PARTITION BY partner_channel, product_category, customer_segment ORDER BY order_date"
_GROUP_WEEK = f"{_GROUP} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"


def _growth(now: str, before: str) -> str:
    return f"CASE WHEN {before} > 0 THEN {q.div(f'{now} - {before}', before)} END"


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {q.div(n, d)} ELSE 0 END"


_DAY_TARGET = PARAMS.revenue_target_monthly / 30
SUMMARY = f"""
SELECT *, {q.key('order_date', 'partner_channel', 'product_category', 'customer_segment')} AS financial_summary_key,
       {q.rules(V.EXECUTIVE_ALERT)} AS executive_alert_level, {q.rules(V.FINANCE_ACTION)} AS recommended_action,
       {q.clamp(f"CAST(daily_revenue AS DOUBLE) / {_DAY_TARGET!r} * 30 + daily_gross_margin_rate * 25 + efficient_sku_rate * 20 + CASE WHEN revenue_trend_indicator IN ('strong_growth', 'moderate_growth') THEN 25 ELSE 0 END")} AS priority_score
FROM (SELECT *, {q.bands('red_flag_sku_rate', V.RED_FLAG_RISK)} AS financial_risk_level,
             {q.bands('efficient_sku_rate', V.EFFICIENCY_LEVEL)} AS channel_efficiency_level
      FROM (SELECT *, {_growth('daily_revenue', 'prev_day_revenue')} AS daily_revenue_growth_rate,
                   {_growth('daily_gross_profit', 'prev_day_gross_profit')} AS daily_gross_profit_growth_rate,
                   {_growth('daily_revenue', 'revenue_30_days_ago')} AS revenue_growth_30d,
                   {_growth('daily_revenue', 'revenue_1_year_ago')} AS revenue_growth_yoy,
                   {q.rules(V.REVENUE_TREND)} AS revenue_trend_indicator, {q.rules(V.MARGIN_TREND)} AS margin_trend_indicator,
                   {q.bands('daily_avg_performance_score', V.PERFORMANCE_CLASS)} AS performance_classification,
                   {', '.join(f"{_ratio(f'{n}_skus', 'total_skus')} AS {n}_sku_rate" for n in ('highly_profitable', 'loss_making', 'red_flag', 'efficient'))},
                   {q.bands('daily_revenue', V.Bands('>=', ((_DAY_TARGET, 'on_target'), (_DAY_TARGET * 0.8, 'near_target')), 'below_target'))} AS daily_target_status
            FROM (SELECT *, {q.avg_over('daily_revenue', _GROUP_WEEK)} AS revenue_7_day_ma,
                         {q.avg_over('daily_gross_margin_rate', _GROUP_WEEK)} AS gross_margin_7_day_ma,
                         LAG(daily_revenue) OVER ({_GROUP}) AS prev_day_revenue, LAG(daily_gross_profit) OVER ({_GROUP}) AS prev_day_gross_profit,
                         LAG(daily_revenue, 30) OVER ({_GROUP}) AS revenue_30_days_ago, LAG(daily_revenue, 365) OVER ({_GROUP}) AS revenue_1_year_ago
                  FROM (SELECT *, {_ratio('daily_gross_profit', 'daily_revenue')} AS daily_gross_margin_rate,
                               {_ratio('daily_gross_profit', 'daily_units_sold')} AS daily_gross_profit_per_unit
                        FROM (SELECT order_date, partner_channel, product_category, customer_segment, SUM(total_revenue) AS daily_revenue,
                                     SUM(total_units_sold) AS daily_units_sold, SUM(total_orders) AS daily_orders, SUM(gross_profit) AS daily_gross_profit,
                                     AVG(performance_score) AS daily_avg_performance_score, 0 AS highly_profitable_skus, 0 AS loss_making_skus,
                                     0 AS red_flag_skus, COUNT(*) AS efficient_skus, COUNT(*) AS total_skus
                              FROM financial GROUP BY 1, 2, 3, 4) AS a) AS b) AS c) AS d) AS e
"""

# ---- partner dashboard and optimisation --------------------------------------------
_RECENT = f"order_date >= {TODAY} - 30"
_SPANS = {
    "30d": _RECENT,
    "30d_prev": f"order_date BETWEEN {TODAY} - 60 AND {TODAY} - 31",
    "qtd": f"year(order_date) = year({TODAY}) AND quarter(order_date) = quarter({TODAY})",
    "ytd": f"year(order_date) = year({TODAY})",
}


def _sums(prefix: str, col: str) -> str:
    return ", ".join(f"SUM(CASE WHEN {cond} THEN {col} ELSE 0 END) AS {prefix}_{n}" for n, cond in _SPANS.items())


def _recent_avg(col: str, name: str) -> str:
    return f"AVG(CASE WHEN {_RECENT} THEN {col} END) AS {name}"


_T = PARAMS.revenue_target_monthly
DASHBOARD = f"""
SELECT *, {q.key('partner_channel', 'customer_segment')} AS dashboard_key, {q.bands('overall_health_score', V.HEALTH_ACTION)} AS recommended_action,
       ROW_NUMBER() OVER (ORDER BY overall_health_score DESC, revenue_30d DESC, partner_channel, customer_segment) AS partner_priority_rank
FROM (SELECT *, {_growth('revenue_30d', 'revenue_30d_prev')} AS revenue_growth_30d, {_growth('orders_30d', 'orders_30d_prev')} AS order_growth_30d,
             {q.rules(V.TREND_DIRECTION)} AS overall_trend_direction,
             {q.bands('revenue_30d', V.Bands('>=', ((_T, 'achieved'), (_T * 0.8, 'near_target')), 'below_target'))} AS monthly_target_status,
             {q.bands('efficient_days', V.EFFICIENT_DAYS)} AS efficiency_rating,
             {q.clamp(f"LEAST(25, GREATEST(0, CAST(revenue_30d AS DOUBLE)) / {float(_T)} * 25) + GREATEST(0, avg_gross_margin_30d) * 25 + GREATEST(0, COALESCE(avg_data_quality_30d, 0)) * 25 + GREATEST(0, COALESCE(avg_fulfilment_efficiency_30d, 0)) / 100 * 25")} AS overall_health_score
      FROM (SELECT p.*, COALESCE(f.gross_profit_30d, 0) AS gross_profit_30d, COALESCE(f.avg_gross_margin_30d, 0) AS avg_gross_margin_30d,
                   COALESCE(f.avg_gross_profit_per_unit_30d, 0) AS avg_gross_profit_per_unit_30d,
                   COALESCE(f.avg_performance_score_30d, 0) AS avg_performance_score_30d,
                   COALESCE(f.dominant_profitability_tier, 'unknown') AS dominant_profitability_tier,
                   COALESCE(f.red_flag_days, 0) AS red_flag_days, COALESCE(f.efficient_days, 0) AS efficient_days
            FROM (SELECT partner_channel, channel_group, customer_segment, {_sums('revenue', 'daily_revenue')}, {_sums('orders', 'daily_orders')},
                         SUM(CASE WHEN {_RECENT} THEN daily_units_sold ELSE 0 END) AS units_30d,
                         {_recent_avg('daily_avg_order_value', 'avg_order_value_30d')},
                         {_recent_avg('avg_fulfilment_efficiency', 'avg_fulfilment_efficiency_30d')},
                         {_recent_avg('data_quality_score', 'avg_data_quality_30d')},
                         COUNT_IF({_RECENT} AND revenue_trend_indicator = 'above_trend') AS above_trend_days,
                         COUNT_IF({_RECENT} AND revenue_trend_indicator = 'below_trend') AS below_trend_days,
                         {_recent_avg('high_value_order_rate', 'high_value_order_rate_30d')},
                         {_recent_avg('avg_processing_days', 'avg_processing_days_30d')}
                  FROM daily GROUP BY 1, 2, 3) AS p
            LEFT JOIN (SELECT partner_channel, customer_segment, SUM(CASE WHEN {_RECENT} THEN gross_profit ELSE 0 END) AS gross_profit_30d,
                              {_recent_avg('gross_margin_rate', 'avg_gross_margin_30d')},
                              {_recent_avg('gross_profit_per_unit', 'avg_gross_profit_per_unit_30d')},
                              {_recent_avg('performance_score', 'avg_performance_score_30d')},
                              mode(CASE WHEN {_RECENT} THEN profitability_tier END) AS dominant_profitability_tier,
                              COUNT_IF({_RECENT} AND margin_health_flag = 'red_flag') AS red_flag_days,
                              COUNT_IF({_RECENT} AND channel_efficiency_flag = 'efficient') AS efficient_days
                       FROM financial GROUP BY 1, 2) AS f USING (partner_channel, customer_segment)) AS j) AS h
"""

_MEASURES = {
    "revenue": "revenue_30d", "orders": "orders_30d", "aov": "avg_order_value_30d", "margin": "avg_gross_margin_30d",
    "efficiency": "avg_fulfilment_efficiency_30d", "health": "overall_health_score",
}
_BENCH = {m: "avg_health_score_benchmark" if m == "health" else f"avg_{m}_benchmark" for m in _MEASURES}
_RANKED = ("revenue", "aov", "margin", "health")


def _opportunity(m: str) -> str:
    bounds = (f"low_{m}_threshold", _BENCH[m], f"top_{m}_benchmark")
    chain = q.case(((f"CAST({_MEASURES[m]} AS DOUBLE) < {b}", label) for b, label in zip(bounds, V.OPPORTUNITY_LABELS)), V.OPPORTUNITY_LABELS[3])
    return f"{chain} AS {m}_opportunity_level"


def _points(col: str, table) -> str:
    return q.mapped(col, *table)


OPTIMISATION = f"""
SELECT *, {q.key('partner_channel', 'customer_segment')} AS optimization_key, {q.rules(V.PARTNER_TIMELINE)} AS implementation_timeline,
       {q.clamp(' + '.join([_points('expected_impact', V.IMPACT_POINTS), _points('implementation_complexity', V.COMPLEXITY_POINTS), _points('strategic_classification', V.CLASS_POINTS), _points('risk_level', V.RISK_POINTS)]))} AS optimization_priority_score,
       {q.rules(V.EXECUTIVE_TEXT)} AS executive_summary, {q.rules(V.INSIGHT_TEXT)} AS business_insight
FROM (SELECT *, {q.rules(V.PARTNER_RECOMMENDATION)} AS specific_recommendation,
             {q.mapped('primary_optimization_focus', V.FOCUS_COMPLEXITY, V.FOCUS_COMPLEXITY_OTHER)} AS implementation_complexity,
             {q.mapped('investment_priority', V.INVESTMENT_RESOURCES, V.INVESTMENT_RESOURCES_OTHER)} AS resource_requirements,
             {q.mapped('primary_optimization_focus', V.FOCUS_SUCCESS, V.FOCUS_SUCCESS_OTHER)} AS success_metrics,
             {q.rules(V.PARTNER_RISK)} AS risk_level
      FROM (SELECT *, {q.rules(V.PARTNER_CLASS)} AS strategic_classification, {q.rules(V.PARTNER_INVESTMENT)} AS investment_priority,
                   {q.rules(V.OPTIMISATION_FOCUS)} AS primary_optimization_focus, {q.bands('revenue_upside_potential', V.PARTNER_IMPACT)} AS expected_impact
            FROM (SELECT *, {', '.join(f'CAST({_MEASURES[m]} AS DOUBLE) - {_BENCH[m]} AS {m}_gap_vs_avg' for m in _RANKED)},
                         {', '.join(f'top_{m}_benchmark - CAST({_MEASURES[m]} AS DOUBLE) AS {m}_upside_potential' for m in _RANKED)},
                         {', '.join(f'PERCENT_RANK() OVER (PARTITION BY customer_segment ORDER BY {_MEASURES[m]} NULLS LAST) AS {m}_percentile' for m in _RANKED)},
                         {', '.join(_opportunity(m) for m in ('revenue', 'margin', 'health'))}
                  FROM dashboard LEFT JOIN (
                       SELECT customer_segment, {', '.join(f'AVG(CAST({c} AS DOUBLE)) AS {_BENCH[m]}' for m, c in _MEASURES.items())},
                              {', '.join(f'quantile_cont(CAST({_MEASURES[m]} AS DOUBLE), 0.75) AS top_{m}_benchmark' for m in _RANKED)},
                              {', '.join(f'quantile_cont(CAST({_MEASURES[m]} AS DOUBLE), 0.25) AS low_{m}_threshold' for m in _RANKED if m != 'aov')}
                       FROM dashboard GROUP BY 1) AS b USING (customer_segment)) AS g) AS c) AS r
"""

# ---- unified sales -----------------------------------------------------------------
_TIE = "order_item_key NULLS LAST, order_amount NULLS LAST, quantity NULLS LAST, unit_price NULLS LAST"
_ORDER = f"ORDER BY order_date NULLS LAST, {_TIE}"
_UCOLS = (
    "order_item_key, sales_channel, order_date, order_year, order_month, season, sku, product_category, product_size, "
    "customer_segment, is_b2b, city_tier, order_amount, quantity, unit_price, recognized_revenue, estimated_gst_amount, "
    "net_order_amount, order_performance_score, composite_performance_score, shipping_city, shipping_state, "
    "shipping_country, fulfillment_model, order_status_category, has_promotion"
)
_I = "'INTERNATIONAL'"
UNIFIED = f"""
SELECT *, CASE WHEN prev_order_amount IS NOT NULL THEN ROUND({q.div('order_amount - prev_order_amount', 'prev_order_amount')} * 100, 2) END AS order_value_growth_rate
FROM (SELECT *, strftime(order_date, '%Y-%m') AS order_cohort,
       DENSE_RANK() OVER (PARTITION BY product_category ORDER BY composite_performance_score DESC) AS category_performance_rank,
       PERCENT_RANK() OVER (PARTITION BY sales_channel ORDER BY composite_performance_score) AS channel_performance_percentile,
       {q.avg_over('order_amount', 'PARTITION BY season, product_category')} AS seasonal_avg_order_value,
       RANK() OVER (PARTITION BY sales_channel, order_date ORDER BY order_amount DESC NULLS LAST) AS daily_order_rank,
       LAG(order_amount) OVER (PARTITION BY sales_channel, sku {_ORDER}) AS prev_order_amount,
       SUM(recognized_revenue) OVER (PARTITION BY sales_channel, sku {_ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_revenue,
       {q.avg_over('order_amount', f'PARTITION BY sales_channel {_ORDER} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW')} AS rolling_30d_avg_order_value,
       ROW_NUMBER() OVER (PARTITION BY sku {_ORDER}) AS product_order_sequence,
       ROW_NUMBER() OVER (PARTITION BY sales_channel, customer_segment {_ORDER}) AS customer_segment_order_count
FROM (SELECT order_id, {_UCOLS.replace('sales_channel', "'AMAZON' AS sales_channel", 1)}
      FROM orders_staged WHERE business_validation_status = 'VALID'
      UNION ALL
      SELECT 'INTL-' || CAST(ROW_NUMBER() OVER ({_ORDER}) AS VARCHAR), {_UCOLS}
      FROM (SELECT md5(concat_ws('-', sku, CAST(order_date AS VARCHAR), customer_name)) AS order_item_key, {_I} AS sales_channel, order_date, order_year,
                   order_month, season, sku, product_category, product_size, customer_segment, FALSE AS is_b2b, {_I} AS city_tier,
                   gross_amount AS order_amount, quantity, unit_rate AS unit_price, gross_amount AS recognized_revenue,
                   ROUND(gross_amount * CAST(0.18 AS DECIMAL(3,2)), 2) AS estimated_gst_amount, ROUND(gross_amount * CAST(0.82 AS DECIMAL(3,2)), 2) AS net_order_amount,
                   85 AS order_performance_score, 90 AS composite_performance_score, {_I} AS shipping_city, {_I} AS shipping_state,
                   {_I} AS shipping_country, 'DIRECT' AS fulfillment_model, 'DELIVERED' AS order_status_category, FALSE AS has_promotion
            FROM international WHERE data_quality_flag = 'VALID') AS i) AS u) AS w
"""

# ---- customers ---------------------------------------------------------------------
_CUST = "customer_id, sales_channel, customer_segment, city_tier, is_b2b, shipping_city, shipping_state, shipping_country"
_CHURN = q.case(((f"days_since_last_order > {d}", p) for d, p in V.CHURN_STEPS), V.CHURN_OTHER)
CUSTOMERS = f"""
SELECT *, {q.rules(V.UPSELL)} AS upsell_potential
FROM (SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR) AS rfm_score,
             {q.rules(V.RFM_SEGMENT)} AS rfm_segment, {q.rules(V.LIFECYCLE)} AS lifecycle_stage, {q.bands('total_revenue', V.CUSTOMER_VALUE)} AS value_tier,
             {q.rules(V.ENGAGEMENT)} AS engagement_level, {q.argmax(V.SEASON_SHOPPERS, 'All Season')} AS seasonal_preference,
             CASE WHEN customer_lifespan_days > 0 THEN {q.div('total_revenue', 'customer_lifespan_days')} * 365 * 2
                  ELSE avg_order_value * annual_order_frequency * 2 END AS predicted_clv_2year, {_CHURN} AS churn_probability,
             CASE WHEN annual_order_frequency > 0 THEN ROUND(365.0 / annual_order_frequency) ELSE 365 END AS predicted_days_to_next_order
      FROM (SELECT *, NTILE(5) OVER (ORDER BY days_since_last_order DESC, {_CUST}) AS recency_score,
                   NTILE(5) OVER (ORDER BY total_orders, {_CUST}) AS frequency_score, NTILE(5) OVER (ORDER BY total_revenue, {_CUST}) AS monetary_score
            FROM (SELECT *, date_diff('day', first_order_date, last_order_date) AS customer_lifespan_days,
                         date_diff('day', last_order_date, {TODAY}) AS days_since_last_order, 'kurta' AS favorite_category,
                         CASE WHEN last_order_date > first_order_date THEN {q.div('total_orders', "date_diff('day', first_order_date, last_order_date)")} * 365
                              ELSE 0 END AS annual_order_frequency
                  FROM (SELECT {_CUST}, COUNT(DISTINCT order_date) AS total_orders, COUNT(DISTINCT sku) AS unique_products_purchased,
                               COUNT(DISTINCT product_category) AS unique_categories_purchased, SUM(recognized_revenue) AS total_revenue,
                               {q.avg('recognized_revenue')} AS avg_order_value, MIN(recognized_revenue) AS min_order_value,
                               MAX(recognized_revenue) AS max_order_value, STDDEV_SAMP(CAST(recognized_revenue AS DOUBLE)) AS order_value_stddev,
                               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
                               {', '.join(f"COUNT_IF(month(order_date) IN {m}) AS {s.lower()}_orders" for s, m in V.SEASON_MONTHS.items())}
                        FROM (SELECT *, CASE WHEN sales_channel = 'AMAZON' THEN md5(shipping_city || shipping_state || customer_segment || sku)
                                             ELSE md5(sales_channel || city_tier || customer_segment) END AS customer_id
                              FROM unified WHERE recognized_revenue > 0) AS l
                        GROUP BY {_CUST}) AS a) AS b) AS c) AS d
"""
_SILENT = f"date_diff('day', last_order_date, {TODAY})"
SEGMENTS = f"""
SELECT *, {q.key('customer_segment', 'partner_channel')} AS customer_segment_key, recency_score + frequency_score + monetary_score AS rfm_total_score,
       {q.rules(V.SEGMENT_ACTION)} AS recommended_action, {q.rules(V.SEGMENT_PRIORITY)} AS investment_priority
FROM (SELECT *, {q.rules(V.PERSONA)} AS marketing_persona
      FROM (SELECT *, {q.bands('total_orders', V.LOYALTY)} AS loyalty_tier, {q.bands('total_revenue', V.SEGMENT_VALUE)} AS value_tier,
                   {q.bands('active_days', V.ACTIVE_DAYS)} AS engagement_level, {q.rules(V.CHANNEL_PREFERENCE)} AS channel_preference,
                   {q.argmax(V.QUARTER_SEASONAL, 'no_seasonal_pattern')} AS seasonal_pattern, {q.bands(_SILENT, V.SILENT_DAYS_CHURN)} AS churn_risk_level,
                   {q.rules(V.BUSINESS_SHARE)} AS business_customer_type, {q.bands(q.div('revenue_volatility', 'avg_order_value'), V.SPENDING)} AS spending_pattern,
                   {q.bands(q.div('high_value_orders', 'total_orders'), V.HIGH_VALUE_SHARE)} AS high_value_propensity,
                   {q.bands(_SILENT, V.SILENT_DAYS_SCORE)} AS recency_score, {q.bands('orders_per_month', V.ORDERS_PER_MONTH_SCORE)} AS frequency_score,
                   {q.bands('total_revenue', V.REVENUE_SCORE)} AS monetary_score, {q.rules(V.STRATEGIC_SEGMENT)} AS strategic_segment,
                   {q.bands('estimated_annual_value', V.CLV_TIER)} AS clv_tier
            FROM (SELECT *, CASE WHEN customer_lifespan_days > 0 THEN {q.div('total_revenue', 'customer_lifespan_days')} * 365 ELSE CAST(total_revenue AS DOUBLE) END AS estimated_annual_value,
                         CASE WHEN customer_lifespan_days > 0 THEN total_orders / (customer_lifespan_days / 30.0::DOUBLE) ELSE total_orders END AS orders_per_month,
                         {q.div('b2b_orders', 'total_orders')} AS b2b_share
                  FROM (SELECT customer_segment, partner_channel, COUNT(DISTINCT order_id) AS total_orders, SUM(revenue) AS total_revenue,
                               SUM(quantity) AS total_units_purchased, COUNT(DISTINCT product_sku) AS unique_products_purchased,
                               COUNT(DISTINCT order_date) AS active_days, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
                               date_diff('day', MIN(order_date), MAX(order_date)) AS customer_lifespan_days, {q.avg('revenue')} AS avg_order_value,
                               {q.avg('quantity')} AS avg_units_per_order, STDDEV_SAMP(CAST(revenue AS DOUBLE)) AS revenue_volatility,
                               COUNT_IF(order_value_tier = 'high_value') AS high_value_orders, COUNT_IF(is_b2b) AS b2b_orders,
                               COUNT_IF(is_business_day) AS business_day_orders,
                               COUNT(DISTINCT CASE WHEN partner_channel = 'amazon' THEN order_date END) AS amazon_active_days,
                               COUNT(DISTINCT CASE WHEN partner_channel = 'merchant_website' THEN order_date END) AS merchant_active_days,
                               COUNT(DISTINCT CASE WHEN partner_channel = 'international' THEN order_date END) AS international_active_days,
                               {', '.join(f'COUNT_IF(quarter = {n}) AS q{n}_orders' for n in (1, 2, 3, 4))}
                        FROM base GROUP BY 1, 2) AS a) AS b) AS c) AS d
"""

# ---- products ----------------------------------------------------------------------
_Q = [f"CAST(q{n}_revenue AS DOUBLE)" for n in (1, 2, 3, 4)]
_QM = "(CAST(q1_revenue + q2_revenue + q3_revenue + q4_revenue AS DOUBLE) / 4)"
_SALES_NAMES = {"amazon": "amazon", "merchant_website": "merchant", "international": "international"}
PRODUCT = f"""
SELECT *, {q.mapped('strategic_classification', V.PRODUCT_ACTION, V.PRODUCT_ACTION_OTHER)} AS recommended_action
FROM (SELECT *, {q.key('product_sku')} AS product_intelligence_key, {q.rules(V.PRODUCT_INVESTMENT)} AS investment_recommendation,
       {q.rules(V.PRODUCT_MARKETING)} AS marketing_strategy, {q.rules(V.PRODUCT_CLASS)} AS strategic_classification,
       {q.clamp("GREATEST(gross_margin_rate, 0) * 30 + LEAST(25, GREATEST(daily_sales_velocity, 0) * 2.5) + LEAST(25, GREATEST(CAST(total_revenue AS DOUBLE), 0) / 2000) + CASE WHEN channel_presence >= 2 THEN 10 ELSE channel_presence * 5 END + CASE WHEN lifecycle_stage IN ('growth', 'stable') THEN 10 ELSE 0 END")} AS product_score
FROM (SELECT *, {q.bands('gross_margin_rate', V.MARGIN_CATEGORY)} AS margin_category, {q.bands('daily_sales_velocity', V.VELOCITY)} AS velocity_category,
             {q.bands('total_revenue', V.PRODUCT_REVENUE)} AS revenue_tier, {q.rules(V.CHANNEL_STRATEGY)} AS channel_strategy,
             {q.bands('b2b_order_rate', V.CUSTOMER_FOCUS)} AS customer_focus, {q.bands('seasonal_variability', V.SEASONALITY)} AS seasonality_level,
             {q.rules(V.PRODUCT_LIFECYCLE)} AS lifecycle_stage
      FROM (SELECT *, {_ratio('gross_profit', 'total_revenue')} AS gross_margin_rate, {_ratio('net_profit', 'total_revenue')} AS net_margin_rate,
                   {_ratio('gross_profit', 'total_units_sold')} AS gross_profit_per_unit, {_ratio('total_revenue', 'product_lifespan_days')} AS daily_revenue_rate,
                   {_ratio('total_units_sold', 'product_lifespan_days')} AS daily_sales_velocity,
                   {', '.join(f"{_ratio(f'{n}_revenue', 'total_revenue')} AS {n}_revenue_share" for n in _SALES_NAMES.values())},
                   {_ratio('b2b_orders', 'total_orders')} AS b2b_order_rate, {_ratio('business_orders', 'total_orders')} AS business_order_rate,
                   {q.argmax(V.QUARTER_PEAK, 'no_clear_seasonality')} AS seasonal_peak,
                   CASE WHEN {_QM} > 0 THEN sqrt({' + '.join(f'pow({x} - {_QM}, 2)' for x in _Q)}) / {_QM} ELSE 0 END AS seasonal_variability
            FROM (SELECT *, CAST(total_revenue AS DOUBLE) - unit_cost * total_units_sold AS gross_profit,
                         CAST(total_revenue AS DOUBLE) - unit_cost * total_units_sold - total_allocated_expenses AS net_profit
                  FROM (SELECT s.*, COALESCE(c.cost, 0) AS unit_cost, COALESCE(c.cost_alt, c.cost, 0) AS unit_cost_alternative,
                               COALESCE(c.cost_tier, 'unknown') AS cost_tier, COALESCE(c.cost_stability, 'unknown') AS cost_stability,
                               COALESCE(CAST(e.spent AS DOUBLE), 0) AS total_allocated_expenses, COALESCE(e.mean_expense, 0) AS avg_expense_per_transaction,
                               COALESCE(e.expense_tier, 'unknown') AS expense_tier
                        FROM (SELECT product_sku, MAX(product_category) AS product_category, MAX(product_style) AS product_style, MAX(product_asin) AS product_asin,
                                     COUNT(DISTINCT order_id) AS total_orders, SUM(quantity) AS total_units_sold, SUM(revenue) AS total_revenue,
                                     COUNT(DISTINCT order_date) AS active_sales_days, COUNT(DISTINCT partner_channel) AS channel_presence,
                                     MIN(order_date) AS first_sale_date, MAX(order_date) AS last_sale_date,
                                     date_diff('day', MIN(order_date), MAX(order_date)) AS product_lifespan_days, {_SILENT.replace('last_order_date', 'MAX(order_date)')} AS silent_days,
                                     COUNT(DISTINCT CASE WHEN customer_segment = 'b2b' THEN order_id END) AS b2b_orders,
                                     COUNT(DISTINCT CASE WHEN customer_segment = 'b2c' THEN order_id END) AS b2c_orders,
                                     COUNT(DISTINCT CASE WHEN is_b2b THEN order_id END) AS business_orders,
                                     {', '.join(f"SUM(CASE WHEN partner_channel = '{c}' THEN revenue ELSE 0 END) AS {n}_revenue" for c, n in _SALES_NAMES.items())},
                                     {', '.join(f"COUNT_IF(order_value_tier = '{t}') AS {t}_orders" for t in V.LINE_VALUE_LABELS)},
                                     {', '.join(f"SUM(CASE WHEN quarter = {n} THEN revenue ELSE 0 END) AS q{n}_revenue" for n in (1, 2, 3, 4))},
                                     {q.avg('revenue')} AS avg_order_value, {q.avg('quantity')} AS avg_units_per_order,
                                     STDDEV_SAMP(CAST(revenue AS DOUBLE)) AS revenue_volatility, {q.avg('fulfilment_efficiency_score')} AS avg_fulfilment_score,
                                     {q.avg('estimated_processing_days')} AS avg_processing_days
                              FROM base GROUP BY 1) AS s
                        LEFT JOIN (SELECT product_sku, {q.avg('cost_price_tp1')} AS cost, {q.avg('cost_price_tp2')} AS cost_alt,
                                          {q.bands(q.avg('cost_price_tp1'), V.UNIT_COST)} AS cost_tier,
                                          {q.bands(q.div('STDDEV_SAMP(CAST(cost_price_tp1 AS DOUBLE))', q.avg('cost_price_tp1')), V.COST_STABILITY)} AS cost_stability
                                   FROM prices WHERE cost_price_tp1 > 0 GROUP BY 1) AS c USING (product_sku)
                        LEFT JOIN (SELECT product_sku, SUM(expense_amount) AS spent, {q.avg('expense_amount')} AS mean_expense,
                                          {q.bands(q.avg('expense_amount'), V.EXPENSE_TIER)} AS expense_tier
                                   FROM expenses GROUP BY 1) AS e USING (product_sku)) AS a) AS b) AS c2) AS d) AS f
"""

# ---- cohorts -----------------------------------------------------------------------
_WHO = "customer_id, customer_segment, partner_channel"
_CELL = "cohort_month, customer_segment, partner_channel, period_number"
_LINE_ORDER = f"PARTITION BY {_WHO} ORDER BY order_date, line_key ROWS UNBOUNDED PRECEDING"
COHORT = f"""
SELECT *, {q.key('cohort_month', 'customer_segment', 'partner_channel', 'period_number')} AS cohort_analysis_key, {q.rules(V.COHORT_INVESTMENT)} AS investment_priority,
       {q.mapped('optimization_recommendation', V.COHORT_OUTCOME, V.COHORT_OUTCOME_OTHER)} AS expected_outcome
FROM (SELECT *, {q.rules(V.COHORT_ADVICE)} AS optimization_recommendation, {q.rules(V.COHORT_STRATEGY)} AS strategic_classification
FROM (SELECT *, CASE period_number WHEN 0 THEN CAST(cohort_size AS DOUBLE) WHEN 1 THEN retention_rate END AS month_1_retention_rate,
       CASE period_number WHEN 0 THEN CAST(cohort_initial_revenue AS DOUBLE) WHEN 1 THEN revenue_retention_rate END AS month_1_revenue_retention_rate,
       CASE WHEN prev_period_customers > 0 THEN {q.div('prev_period_customers - active_customers', 'prev_period_customers')} ELSE 0 END AS churn_rate,
       CASE WHEN prev_period_revenue > 0 THEN {q.div('period_revenue - prev_period_revenue', 'prev_period_revenue')} ELSE 0 END AS revenue_growth_rate,
       {q.bands('retention_rate', V.RETENTION_CLASS)} AS retention_classification, {q.bands('revenue_retention_rate', V.REVENUE_CLASS)} AS revenue_classification,
       ltv_at_period * {q.bands('period_number', V.LTV_MULTIPLIER)} AS predicted_ltv,
       {q.clamp(' + '.join(f'{c} * {w}' for c, w in V.COHORT_WEIGHTS))} AS cohort_quality_score,
       {q.bands(f"date_diff('month', cohort_month, {TODAY})", V.COHORT_AGE)} AS cohort_maturity, {q.rules(V.COHORT_VALUE)} AS business_value_assessment
FROM (SELECT c.*, s.cohort_size, s.cohort_initial_revenue, s.cohort_initial_avg_revenue, {q.div('active_customers', 'cohort_size')} AS retention_rate,
             {q.div('period_revenue', 'cohort_initial_revenue')} AS revenue_retention_rate,
             {q.div('avg_revenue_per_customer', 'cohort_initial_avg_revenue')} AS revenue_per_customer_ratio,
             {q.div('high_value_customers', 'active_customers')} AS high_value_customer_rate, {q.div('repeat_customers', 'active_customers')} AS repeat_customer_rate,
             LAG(active_customers) OVER (PARTITION BY cohort_month, customer_segment, partner_channel ORDER BY period_number) AS prev_period_customers,
             LAG(period_revenue) OVER (PARTITION BY cohort_month, customer_segment, partner_channel ORDER BY period_number) AS prev_period_revenue,
             avg_cumulative_revenue AS ltv_at_period, {q.bands('period_number', V.COHORT_STAGE)} AS lifecycle_stage
      FROM cohort_cells c JOIN (SELECT cohort_month, customer_segment, partner_channel, active_customers AS cohort_size, period_revenue AS cohort_initial_revenue,
                                       avg_revenue_per_customer AS cohort_initial_avg_revenue FROM cohort_cells WHERE period_number = 0) AS s
                        USING (cohort_month, customer_segment, partner_channel)) AS a) AS b) AS d
"""
COHORT_CELLS = f"""
SELECT {_CELL}, COUNT(DISTINCT customer_id) AS active_customers, SUM(revenue) AS period_revenue, SUM(quantity) AS period_quantity,
       {q.avg('revenue')} AS avg_revenue_per_customer, median(CAST(revenue AS DOUBLE)) AS median_revenue_per_customer,
       COUNT(DISTINCT CASE WHEN order_value_tier = 'high_value' THEN customer_id END) AS high_value_customers,
       COUNT(DISTINCT CASE WHEN order_sequence > 1 THEN customer_id END) AS repeat_customers,
       COUNT(DISTINCT product_category) AS unique_categories_purchased, {q.avg('cumulative_revenue')} AS avg_cumulative_revenue
FROM (SELECT base.*, CAST(date_trunc('month', first_order_date) AS DATE) AS cohort_month, date_diff('month', first_order_date, order_date) AS period_number,
             SUM(revenue) OVER ({_LINE_ORDER}) AS cumulative_revenue, ROW_NUMBER() OVER ({_LINE_ORDER.replace(' ROWS UNBOUNDED PRECEDING', '')}) AS order_sequence
      FROM base JOIN (SELECT {_WHO}, MIN(order_date) AS first_order_date FROM base GROUP BY {_WHO}) AS f USING ({_WHO})) AS h
WHERE cohort_month >= DATE '1993-08-01'
GROUP BY {_CELL}
"""

CTES = {
    "daily": DAILY, "financial": FINANCIAL, "summary": SUMMARY, "dashboard": DASHBOARD, "optimisation": OPTIMISATION,
    "unified": UNIFIED, "customers": CUSTOMERS, "segments": SEGMENTS, "product_insight": PRODUCT, "cohort_cells": COHORT_CELLS, "cohorts": COHORT,
}


def mart_sql(text: str, **more: str) -> str:
    return sql(text, **{**CTES, **more})


def unified(t):
    return sales.unified_sales(t.orders, t.international)


def customers(t):
    return customer.customer_analytics(sales.union_sales(t.orders, t.international, order_ids=False), PARAMS)


def daily(t):
    return partner.daily_partner_metrics(t.base)


def financial(t):
    return finance.financial_performance(t.base, rows=t.rows)


def summary(t):
    return finance.financial_summary(financial(t), PARAMS)


def dashboard(t):
    lines = t.base_once
    return partner.partner_dashboard(partner.daily_partner_metrics(lines, staged=True), finance.financial_performance(lines, rows=t.rows), PARAMS)


DAILY_OUT = """daily_metrics_key:s partner_channel:s order_date:t channel_group:s customer_segment:s daily_orders:i daily_units_sold:i
    daily_unique_products:i daily_revenue:d daily_avg_order_value:d daily_revenue_per_unit:d avg_fulfilment_efficiency:d
    avg_processing_days:d total_records:i valid_records:i business_day_multiplier:d quarter:i month:i day_of_week:i
    high_value_orders:i medium_value_orders:i low_value_orders:i data_quality_score:d business_day_adjusted_revenue:d
    revenue_per_order:d units_per_order:d volume_tier:s high_value_order_rate:d day_name:s previous_day_revenue:d
    rolling_7_day_avg_revenue:d rolling_30_day_avg_orders:d daily_revenue_growth_rate:d performance_vs_7_day_avg:d
    revenue_trend_indicator:s"""
register("partner_daily_metrics", DAILY_OUT, mart_sql("SELECT * FROM daily"))(daily)
register("partner_daily_recent", DAILY_OUT, mart_sql(f"SELECT * FROM daily WHERE {_RECENT}"))(
    lambda t: partner.daily_partner_metrics(t.base, PARAMS)
)

register(
    "financial_performance",
    """financial_performance_key:s partner_channel:s order_date:t product_category:s product_sku:s customer_segment:s total_revenue:d
    total_units_sold:i total_orders:i total_revenue_per_unit_calc:d avg_revenue_per_unit:d gross_profit:d gross_margin_rate:d
    gross_profit_per_unit:d profitability_tier:s revenue_size_tier:s performance_score:d margin_health_flag:s channel_efficiency_flag:s""",
    mart_sql("SELECT * FROM financial"),
)(financial)

SUMMARY_OUT = """financial_summary_key:s order_date:t partner_channel:s product_category:s customer_segment:s daily_revenue:d daily_units_sold:i
    daily_orders:i daily_gross_profit:d daily_gross_margin_rate:d daily_gross_profit_per_unit:d daily_avg_performance_score:d
    highly_profitable_skus:i loss_making_skus:i red_flag_skus:i efficient_skus:i total_skus:i revenue_7_day_ma:d gross_margin_7_day_ma:d
    prev_day_revenue:d prev_day_gross_profit:d revenue_30_days_ago:d revenue_1_year_ago:d daily_revenue_growth_rate:d
    daily_gross_profit_growth_rate:d revenue_growth_30d:d revenue_growth_yoy:d revenue_trend_indicator:s margin_trend_indicator:s
    performance_classification:s highly_profitable_sku_rate:d loss_making_sku_rate:d red_flag_sku_rate:d efficient_sku_rate:d
    daily_target_status:s financial_risk_level:s channel_efficiency_level:s executive_alert_level:s recommended_action:s priority_score:d"""
register("financial_summary", SUMMARY_OUT, mart_sql("SELECT * FROM summary"))(summary)


@register("incremental_upsert", SUMMARY_OUT, mart_sql("SELECT * FROM summary"))
def _incremental(t):
    """Load up to a day, then load again from an earlier day: overlapping keys are replaced."""
    rows = stage(summary(t), "summary")
    path = new_path(t.spark, "financial_summary")
    finance.save_financial_summary(t.spark, rows.filter("order_date < '2001-06-15'"), path)
    finance.save_financial_summary(t.spark, rows.filter("order_date >= '2001-05-20'"), path)
    return read_published(t.spark, path)


@register("incremental_refresh", SUMMARY_OUT, mart_sql("SELECT * FROM summary"))
def _refresh(t):
    """Lines of four days are missing in the first load, wholly or in part; the refresh from those days alone gives the whole summary."""
    days = [date(1996, 2, 29), date(1999, 1, 10), date(2001, 6, 14), date(2001, 6, 15)]
    path, late = new_path(t.spark, "financial_summary"), F.col("order_date").isin(days)
    lines = stage(t.base.select(*finance.LINE_COLUMNS), "base")
    first = lines.filter(~late | (F.col("order_date") == days[1]) & (F.col("order_id") % 2 == 0))
    finance.save_financial_summary(t.spark, finance.financial_summary(finance.financial_performance(first, rows=t.rows), PARAMS), path)
    finance.refresh_financial_summary(t.spark, path, lines, days, PARAMS)
    return read_published(t.spark, path)


@register(
    "upsert_versions", "o_orderkey:i o_orderdate:t o_totalprice:d version:i",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice * 2 AS o_totalprice, 2 AS version FROM orders""",
)
def _upsert_versions(t):
    """Batches that hold two versions of every order: the later version of each key is left, once."""
    from tallyloom.sources.sinks import upsert_partitions

    orders = t.given("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date"), F.col("o_totalprice"), F.date_format("o_orderdate", "yyyy").alias("year"))
    first, second = (orders.withColumns({"o_totalprice": F.col("o_totalprice") * n, "version": F.lit(n)}) for n in (1, 2))
    path = new_path(t.spark, "versions")
    for batch in (first, second.unionByName(first)):
        upsert_partitions(t.spark, path, batch, ["o_orderkey"], "year", "version")
    return t.spark.read.parquet(path)


register(
    "partner_dashboard",
    """dashboard_key:s partner_channel:s channel_group:s customer_segment:s revenue_30d:d revenue_30d_prev:d revenue_qtd:d revenue_ytd:d
    revenue_growth_30d:d orders_30d:i orders_30d_prev:i orders_qtd:i orders_ytd:i order_growth_30d:d units_30d:i avg_order_value_30d:d
    gross_profit_30d:d avg_gross_margin_30d:d avg_gross_profit_per_unit_30d:d avg_fulfilment_efficiency_30d:d avg_data_quality_30d:d
    avg_processing_days_30d:d avg_performance_score_30d:d above_trend_days:i below_trend_days:i overall_trend_direction:s
    high_value_order_rate_30d:d dominant_profitability_tier:s red_flag_days:i efficient_days:i monthly_target_status:s
    efficiency_rating:s overall_health_score:d recommended_action:s partner_priority_rank:i""",
    mart_sql("SELECT * FROM dashboard"),
)(dashboard)

register(
    "partner_optimization",
    " ".join([
        "optimization_key:s partner_channel:s customer_segment:s revenue_30d:d overall_health_score:d partner_priority_rank:i",
        *[f"{b}:d" for b in _BENCH.values()], *[f"top_{m}_benchmark:d {m}_gap_vs_avg:d {m}_upside_potential:d {m}_percentile:d" for m in _RANKED],
        "revenue_opportunity_level:s margin_opportunity_level:s health_opportunity_level:s strategic_classification:s investment_priority:s",
        "primary_optimization_focus:s specific_recommendation:s expected_impact:s implementation_complexity:s resource_requirements:s",
        "implementation_timeline:s success_metrics:s risk_level:s optimization_priority_score:i executive_summary:s business_insight:s",
    ]),
    mart_sql("SELECT * FROM optimisation"),
)(lambda t: partner.partner_optimization(dashboard(t), PARAMS))

register(
    "unified_sales",
    """order_item_key:s order_id:s sales_channel:s sku:s order_date:t order_year:i order_month:i season:s order_cohort:s product_category:s
    product_size:s customer_segment:s is_b2b:b city_tier:s order_amount:d quantity:i unit_price:d recognized_revenue:d estimated_gst_amount:d
    net_order_amount:d order_performance_score:i composite_performance_score:i daily_order_rank:i category_performance_rank:i
    channel_performance_percentile:d prev_order_amount:d order_value_growth_rate:d rolling_30d_avg_order_value:d rolling_7d_revenue:d
    seasonal_avg_order_value:d product_order_sequence:i customer_segment_order_count:i shipping_city:s shipping_state:s shipping_country:s
    fulfillment_model:s order_status_category:s has_promotion:b""",
    mart_sql("SELECT * FROM unified"),
)(unified)

register(
    "customer_analytics",
    """customer_id:s sales_channel:s customer_segment:s city_tier:s is_b2b:b shipping_city:s shipping_state:s shipping_country:s total_orders:i
    unique_products_purchased:i unique_categories_purchased:i total_revenue:d avg_order_value:d min_order_value:d max_order_value:d
    order_value_stddev:d first_order_date:t last_order_date:t customer_lifespan_days:i days_since_last_order:i annual_order_frequency:d
    recency_score:i frequency_score:i monetary_score:i rfm_score:s rfm_segment:s lifecycle_stage:s value_tier:s engagement_level:s
    seasonal_preference:s predicted_clv_2year:d churn_probability:d predicted_days_to_next_order:i upsell_potential:s favorite_category:s
    winter_orders:i spring_orders:i summer_orders:i fall_orders:i""",
    mart_sql("SELECT * FROM customers"),
)(customers)

register(
    "customer_segments",
    """customer_segment_key:s customer_segment:s partner_channel:s total_orders:i total_revenue:d total_units_purchased:i
    unique_products_purchased:i active_days:i first_order_date:t last_order_date:t customer_lifespan_days:i avg_order_value:d
    avg_units_per_order:d revenue_volatility:d high_value_orders:i b2b_orders:i business_day_orders:i amazon_active_days:i
    merchant_active_days:i international_active_days:i q1_orders:i q2_orders:i q3_orders:i q4_orders:i estimated_annual_value:d
    orders_per_month:d loyalty_tier:s value_tier:s engagement_level:s channel_preference:s seasonal_pattern:s churn_risk_level:s
    business_customer_type:s spending_pattern:s high_value_propensity:s recency_score:i frequency_score:i monetary_score:i
    strategic_segment:s marketing_persona:s rfm_total_score:i clv_tier:s recommended_action:s investment_priority:s""",
    mart_sql("SELECT * FROM segments"),
)(lambda t: customer.customer_segments(t.base, PARAMS))

register(
    "product_intelligence",
    """product_intelligence_key:s product_sku:s product_category:s product_style:s product_asin:s total_orders:i total_units_sold:i
    total_revenue:d active_sales_days:i channel_presence:i first_sale_date:t last_sale_date:t product_lifespan_days:i b2b_orders:i
    b2c_orders:i business_orders:i amazon_revenue:d merchant_revenue:d international_revenue:d high_value_orders:i medium_value_orders:i
    low_value_orders:i q1_revenue:d q2_revenue:d q3_revenue:d q4_revenue:d avg_order_value:d avg_units_per_order:d revenue_volatility:d
    avg_fulfilment_score:d avg_processing_days:d unit_cost:d unit_cost_alternative:d cost_tier:s cost_stability:s
    total_allocated_expenses:d avg_expense_per_transaction:d expense_tier:s gross_profit:d net_profit:d gross_margin_rate:d
    net_margin_rate:d gross_profit_per_unit:d daily_revenue_rate:d daily_sales_velocity:d amazon_revenue_share:d merchant_revenue_share:d
    international_revenue_share:d b2b_order_rate:d business_order_rate:d seasonal_peak:s seasonal_variability:d margin_category:s
    velocity_category:s revenue_tier:s channel_strategy:s customer_focus:s seasonality_level:s lifecycle_stage:s
    investment_recommendation:s marketing_strategy:s product_score:d strategic_classification:s recommended_action:s""",
    mart_sql("SELECT * FROM product_insight"),
)(lambda t: product.product_intelligence(t.base, t.prices, t.expenses, PARAMS))


def cohorts(t):
    # all cohorts of the table, not only those of the last 24 months
    return cohort.cohort_analysis(t.base, replace(PARAMS, cohort_months=96), entity="customer_id", tie_break=("line_key",))


register(
    "cohort_analysis",
    """cohort_analysis_key:s cohort_month:t customer_segment:s partner_channel:s period_number:i active_customers:i period_revenue:d
    period_quantity:i avg_revenue_per_customer:d median_revenue_per_customer:d avg_cumulative_revenue:d high_value_customers:i
    repeat_customers:i unique_categories_purchased:i cohort_size:i cohort_initial_revenue:d cohort_initial_avg_revenue:d retention_rate:d
    revenue_retention_rate:d revenue_per_customer_ratio:d high_value_customer_rate:d repeat_customer_rate:d prev_period_customers:i
    prev_period_revenue:d ltv_at_period:d lifecycle_stage:s month_1_retention_rate:d month_1_revenue_retention_rate:d churn_rate:d
    revenue_growth_rate:d retention_classification:s revenue_classification:s predicted_ltv:d cohort_quality_score:d cohort_maturity:s
    business_value_assessment:s optimization_recommendation:s strategic_classification:s investment_priority:s expected_outcome:s""",
    mart_sql("SELECT * FROM cohorts"),
)(cohorts)
