"""Raw and staged tables, unions, dimensions, fact and daily sales."""

from __future__ import annotations

from tallyloom import fixed_values as V
from tallyloom.functions import surrogate_key
from tallyloom.operators.calendar import date_dimension
from tallyloom.plans import raw, sales, staging

from . import sqlgen as q
from .spec import register
from .tables import PARAMS, TODAY, with_tables

_DAY = "TRY_CAST(order_date_text AS DATE)"
_SEASON = q.member("order_month", V.SEASON_MONTHS)


def _dates(col: str) -> str:
    return (
        f"year({col}) AS order_year, month({col}) AS order_month, day({col}) AS order_day, dayofweek({col}) AS day_of_week"
    )


def _amount(expr: str) -> str:
    return q.case(((f"{expr} > 1000", "HIGH_VALUE"), (f"{expr} > 500", "MEDIUM_VALUE")), "LOW_VALUE")


def _hash(*cols: str) -> str:
    return "md5(" + " || ".join(f"COALESCE({c}, '')" for c in cols) + ")"


MARKET = f"""
SELECT *, {_SEASON} AS season, COALESCE(day_of_week IN (0, 6), FALSE) AS is_weekend,
       ROUND({q.div('order_amount', 'quantity')} + 1e-9, 2) AS unit_price,
       {q.mapped('order_status', V.ORDER_STATUS, 'OTHER')} AS order_status_category, {_amount('order_amount')} AS order_value_segment
FROM (SELECT *, {_DAY} AS order_date, {_dates(_DAY)}, TRY_CAST(amount_text AS DECIMAL(10,2)) AS order_amount,
             TRY_CAST(quantity_text AS INTEGER) AS quantity, CAST(b2b_text AS BOOLEAN) AS is_b2b,
             COALESCE(promotion_ids <> '', FALSE) AS has_promotion, {q.rules(V.ORDER_QUALITY)} AS data_quality_flag,
             {_hash('order_id', 'order_date_text', 'amount_text', 'order_status', 'quantity_text')} AS row_hash
      FROM market_raw WHERE order_id IS NOT NULL) AS m
"""

INTERNATIONAL = f"""
SELECT *, {q.rules(V.PROFITABILITY)} AS profitability_flag
FROM (SELECT *, {_SEASON} AS season, COALESCE(day_of_week IN (0, 6), FALSE) AS is_weekend,
             ROUND({q.div('gross_amount', 'quantity')} + 1e-9, 2) AS calculated_unit_price,
             {_amount('gross_amount')} AS order_value_segment,
             {q.like('customer_name', V.CUSTOMER_PATTERNS, 'STANDARD_CUSTOMER')} AS customer_segment,
             {q.like('sku', V.SKU_PATTERNS, 'UNISEX')} AS product_category,
             {q.mapped('product_size', V.SIZES, 'OTHER')} AS standardized_size
      FROM (SELECT *, {_DAY} AS order_date, {_dates(_DAY)}, CAST(quantity_text AS INTEGER) AS quantity,
                   TRY_CAST(rate_text AS DECIMAL(10,2)) AS unit_rate,
                   TRY_CAST(gross_amount_text AS DECIMAL(10,2)) AS gross_amount,
                   {q.rules(V.INTERNATIONAL_QUALITY)} AS data_quality_flag,
                   {_hash('sku', 'order_date_text', 'gross_amount_text', 'customer_name', 'quantity_text')} AS row_hash
            FROM international_raw) AS a) AS b
"""

STOCK_LEVELS = f"""
SELECT *, {q.rules(V.STOCK_LEVEL)} AS stock_level_category, {q.mapped('product_size', V.SIZES, 'OTHER')} AS standardized_size,
       {q.member('lower(product_color)', V.COLOUR_FAMILIES, 'OTHER_FAMILY')} AS color_family,
       {q.like('product_category', V.CATEGORY_PATTERNS, 'OTHER_CATEGORY')} AS category_group,
       {q.rules(V.STOCK_RISK)} AS inventory_risk_level, {q.rules(V.STOCK_REORDER)} AS reorder_recommendation,
       stock_quantity * 500 AS estimated_stock_value, {q.rules(V.STOCK_DEMAND)} AS demand_inference
FROM (SELECT *, TRY_CAST(stock_text AS INTEGER) AS stock_quantity, {q.rules(V.STOCK_QUALITY)} AS data_quality_flag,
             {_hash('sku_code', 'design_number', 'stock_text', 'product_category')} AS row_hash FROM stock_raw) AS s
"""

_SHOPS = [f"{m}_mrp" for m in V.MARKETPLACES]
_MONEY = ["trade_price_1", "trade_price_2", "mrp_old", "final_mrp_old", *_SHOPS]


def _margin(m: str) -> str:
    return f"ROUND({q.div(f'{m}_mrp - trade_price_1', f'{m}_mrp')} * 100 + 1e-9, 2) AS {m}_margin_percent"


_CHEAPEST = q.case(((f"{m}_mrp = min_marketplace_price", m.upper()) for m in V.CHEAPEST_PRIORITY), V.CHEAPEST_OTHER)
CATALOG = f"""
SELECT *, {q.rules(V.PRICE_VARIANCE)} AS price_variance_category, {_CHEAPEST} AS most_competitive_marketplace,
       {q.rules(V.PRICING_ADVICE)} AS pricing_recommendation, {q.bands('avg_marketplace_price', V.PRODUCT_TIER)} AS product_tier
FROM (SELECT *, {q.div('max_marketplace_price - min_marketplace_price', 'min_marketplace_price')} AS price_spread
      FROM (SELECT *, LEAST({', '.join(_SHOPS)}) AS min_marketplace_price, GREATEST({', '.join(_SHOPS)}) AS max_marketplace_price,
                   CAST({' + '.join(_SHOPS)} AS DOUBLE) / 8.0 AS avg_marketplace_price,
                   {', '.join(_margin(m) for m in V.MARGIN_MARKETPLACES)},
                   {q.mapped('product_category', V.CATALOG_CLASS, 'OTHER')} AS product_classification,
                   {q.suffix('sku', V.SIZE_SUFFIXES, 'UNKNOWN')} AS size_from_sku
            FROM (SELECT *, TRY_CAST(weight_text AS DECIMAL(5,2)) AS weight_kg,
                         {', '.join(f'TRY_CAST({c}_text AS DECIMAL(10,2)) AS {c}' for c in _MONEY)},
                         {q.rules(V.CATALOG_QUALITY)} AS data_quality_flag,
                         {_hash('sku', 'style_id', 'trade_price_1_text', 'amazon_mrp_text', 'flipkart_mrp_text')} AS row_hash
                  FROM prices_raw) AS a) AS b) AS c
"""

_SCORE = q.case(((f"({p})", points) for points, p in V.ORDER_SCORE), V.ORDER_SCORE_OTHER)
ORDERS = f"""
SELECT *, ROUND((order_performance_score * 4 + CASE WHEN fulfillment_model = 'FBA' THEN 240 ELSE 180 END
                 + CASE city_tier WHEN 'TIER_1' THEN 270 WHEN 'TIER_2' THEN 210 ELSE 150 END) / 10.0) AS composite_performance_score,
       CASE WHEN order_status_category = 'DELIVERED' THEN order_amount ELSE 0 END AS recognized_revenue,
       strftime(order_date, '%Y-%m') AS order_cohort, date_diff('day', order_date, {TODAY}) AS days_since_order,
       {q.rules(V.ORDER_VALIDATION)} AS business_validation_status
FROM (SELECT *, {TODAY} AS as_of, ROUND(order_amount * CAST(0.18 AS DECIMAL(3,2)), 2) AS estimated_gst_amount,
             ROUND(order_amount * CAST(0.82 AS DECIMAL(3,2)), 2) AS net_order_amount, {_SCORE} AS order_performance_score,
             {q.rules(V.BUYER_SEGMENT)} AS customer_segment, {q.mapped('fulfillment_type', V.FULFILMENT_MODEL, 'OTHER')} AS fulfillment_model,
             {q.member('upper(shipping_city)', V.CITY_TIERS, 'TIER_3')} AS city_tier,
             {q.mapped('shipping_service_level', V.SHIPPING_SPEED, 'SLOW')} AS shipping_speed_category,
             md5(order_id || '-' || sku) AS order_item_key
      FROM market WHERE data_quality_flag = 'VALID') AS s
"""

STOCK = """
SELECT md5(sku_code || design_number) AS order_item_id, sku_code AS order_id, CAST(NULL AS DATE) AS order_date,
       trim(lower(product_category)) AS product_category, trim(lower(sku_code)) AS product_sku,
       trim(lower(design_number)) AS product_asin, TRY_CAST(stock_text AS INTEGER) AS quantity,
       FALSE AS is_b2b_sale, 'sale_report' AS _source_file_name FROM stock_raw WHERE sku_code IS NOT NULL
"""
REPORT = """
SELECT md5(sku || month_first_text) AS order_id, CAST(strptime(month_first_text, '%m-%d-%y') AS DATE) AS order_date,
       trim(lower(sku)) AS product_sku, CAST(quantity_text AS INTEGER) AS quantity,
       TRY_CAST(gross_amount_text AS DECIMAL(10,2)) AS amount, 'international_sale_report' AS _source_file_name
FROM international_raw WHERE TRY_CAST(gross_amount_text AS DECIMAL(18,3)) IS NOT NULL
"""
PRICES = """
SELECT trim(lower(sku)) AS product_sku, trim(lower(product_category)) AS product_category,
       TRY_CAST(trade_price_1_text AS DECIMAL(10,2)) AS cost_price_tp1, TRY_CAST(trade_price_2_text AS DECIMAL(10,2)) AS cost_price_tp2,
       TRY_CAST(final_mrp_old_text AS DECIMAL(10,2)) AS final_mrp_old, 'pl_march_2021' AS _source_file_name FROM prices_raw
"""
EXPENSES = """
SELECT CAST(try_strptime(column1, '%m-%d-%y') AS DATE) AS expense_date, trim(lower(column2)) AS product_sku,
       trim(lower(column3)) AS expense_description, TRY_CAST(column4 AS DECIMAL(10,2)) AS expense_amount,
       'expense_iigf' AS _source_file_name FROM expenses_raw WHERE TRY_CAST(column4 AS DECIMAL(18,3)) IS NOT NULL
"""
ALL_SALES = """
SELECT order_item_key, order_id, order_date, order_status, fulfillment_type, product_category, style_code AS product_style,
       sku AS product_sku, asin AS product_asin, quantity, order_amount AS amount, currency_code AS currency, is_b2b,
       'amazon_sales' AS _source_file_name FROM orders_staged
UNION ALL
SELECT order_item_id, order_id, order_date, NULL, NULL, product_category, NULL, product_sku, product_asin, quantity,
       NULL, NULL, is_b2b_sale, _source_file_name FROM stock
"""
PRODUCTS = """
SELECT product_sku, product_category, product_style, product_asin, COUNT(DISTINCT order_id) AS total_orders_containing_product,
       SUM(quantity) AS total_quantity_sold_across_all_orders
FROM all_sales WHERE product_sku IS NOT NULL GROUP BY ALL
"""
ITEMS = f"""
SELECT s.order_id, s.order_date, s.order_status, s.fulfillment_type, s.is_b2b, s.product_sku, p.product_category, p.product_style,
       s.quantity, s.amount AS item_revenue_amount, s.currency,
       COALESCE(CAST(s.amount AS DOUBLE) - c.unit_cost * s.quantity, 0) AS item_profit_amount, s._source_file_name
FROM all_sales s
LEFT JOIN (SELECT product_sku, MAX(product_category) AS product_category, MAX(product_style) AS product_style
           FROM products GROUP BY 1) p ON s.product_sku = p.product_sku
LEFT JOIN (SELECT product_sku, {q.avg('cost_price_tp1')} AS unit_cost FROM prices GROUP BY 1) c ON s.product_sku = c.product_sku
WHERE s.product_sku IS NOT NULL
"""

_LINE_VALUE = q.case((("revenue >= 1000", "high_value"), ("revenue >= 100", "medium_value")), "low_value")
BASE = f"""
SELECT *, {q.key('partner_channel', 'order_id', 'product_sku')} AS partner_performance_key, {_LINE_VALUE} AS order_value_tier,
       CASE WHEN is_b2b THEN 'b2b' ELSE 'b2c' END AS customer_segment,
       {q.mapped('lower(fulfillment_type)', V.EFFICIENCY_POINTS, 80)} AS fulfilment_efficiency_score,
       {q.mapped('lower(order_status)', V.PROCESSING_DAYS, 10)} AS estimated_processing_days,
       CASE WHEN quantity > 0 THEN CAST(revenue AS DOUBLE) / quantity ELSE 0 END AS revenue_per_unit,
       quarter(order_date) AS quarter, month(order_date) AS month, dayofweek(order_date) AS day_of_week,
       dayofweek(order_date) NOT IN (0, 6) AS is_business_day,
       CASE WHEN partner_channel IN ('amazon', 'merchant_website') THEN 'primary_channels' ELSE 'secondary_channels' END AS channel_group
FROM (SELECT *, {q.rules(V.LINE_QUALITY)} AS data_quality_flag FROM lines) AS l
WHERE data_quality_flag = 'valid' AND order_date >= DATE '1995-01-01'
"""

CTES = {
    "market": MARKET, "international": INTERNATIONAL, "stock_levels": STOCK_LEVELS, "catalog": CATALOG,
    "orders_staged": ORDERS, "stock": STOCK, "report": REPORT, "prices": PRICES, "expenses": EXPENSES,
    "all_sales": ALL_SALES, "products": PRODUCTS, "items": ITEMS, "base": BASE,
}


def sql(text: str, **more: str) -> str:
    """Oracle text over the staged tables."""
    return with_tables(text, {**CTES, **more})


register(
    "marketplace_orders",
    """order_id:s sku:s asin:s style_code:s order_date:t order_year:i order_month:i order_day:i day_of_week:i
    order_status:s fulfillment_type:s shipping_service_level:s courier_status:s product_category:s product_size:s
    currency_code:s order_amount:d quantity:i unit_price:d shipping_city:s shipping_state:s is_b2b:b has_promotion:b
    data_quality_flag:s row_hash:s order_status_category:s order_value_segment:s season:s is_weekend:b""",
    sql("SELECT * FROM market"),
)(lambda t: raw.marketplace_orders(t.market_raw, PARAMS))

register(
    "international_sales",
    """sku:s style_code:s customer_name:s order_date:t order_month_text:s order_year:i order_month:i day_of_week:i
    product_size:s quantity:i unit_rate:d gross_amount:d calculated_unit_price:d data_quality_flag:s row_hash:s
    order_value_segment:s customer_segment:s product_category:s standardized_size:s season:s is_weekend:b profitability_flag:s""",
    sql("SELECT * FROM international"),
)(lambda t: t.international)

register(
    "stock_levels",
    """sku_code:s design_number:s product_category:s product_size:s product_color:s stock_quantity:i data_quality_flag:s
    row_hash:s stock_level_category:s standardized_size:s color_family:s category_group:s inventory_risk_level:s
    reorder_recommendation:s estimated_stock_value:i demand_inference:s""",
    sql("SELECT * FROM stock_levels"),
)(lambda t: raw.stock_levels(t.stock_raw))

register(
    "price_catalog",
    " ".join([
        "sku:s style_id:s catalog_name:s product_category:s weight_kg:d", *[f"{c}:d" for c in _MONEY],
        "min_marketplace_price:d max_marketplace_price:d avg_marketplace_price:d",
        *[f"{m}_margin_percent:d" for m in V.MARGIN_MARKETPLACES],
        "product_classification:s size_from_sku:s data_quality_flag:s row_hash:s price_variance_category:s",
        "most_competitive_marketplace:s pricing_recommendation:s product_tier:s",
    ]),
    sql("SELECT * FROM catalog"),
)(lambda t: t.catalog)

register(
    "staged_orders",
    """order_item_key:s order_id:s sku:s order_date:t order_amount:d estimated_gst_amount:d net_order_amount:d
    order_performance_score:i customer_segment:s fulfillment_model:s city_tier:s shipping_speed_category:s
    composite_performance_score:i recognized_revenue:d order_cohort:s days_since_order:i business_validation_status:s""",
    sql("SELECT * FROM orders_staged"),
)(lambda t: t.orders)

register(
    "staged_stock",
    """order_item_id:s order_id:s order_date:t product_category:s product_sku:s product_asin:s quantity:i is_b2b_sale:b
    _source_file_name:s""",
    sql("SELECT * FROM stock"),
)(lambda t: t.stock)

register(
    "staged_international_report",
    "order_id:s order_date:t product_sku:s quantity:i amount:d _source_file_name:s",
    sql("SELECT * FROM report"),
)(lambda t: staging.stage_international_report(t.international_report_raw))

register(
    "staged_price_list",
    "product_sku:s product_category:s cost_price_tp1:d cost_price_tp2:d final_mrp_old:d _source_file_name:s",
    sql("SELECT * FROM prices"),
)(lambda t: t.prices)

register(
    "staged_expenses",
    "expense_date:t product_sku:s expense_description:s expense_amount:d _source_file_name:s",
    sql("SELECT * FROM expenses"),
)(lambda t: t.expenses)

register(
    "union_channels",
    """order_item_key:s order_id:s order_date:t order_status:s fulfillment_type:s product_category:s product_style:s
    product_sku:s product_asin:s quantity:i amount:d currency:s is_b2b:b _source_file_name:s""",
    sql("SELECT * FROM all_sales"),
)(lambda t: staging.all_sales(t.orders, t.stock))


@register(
    "channel_lines",
    """partner_channel:s order_id:s order_date:t product_category:s product_sku:s quantity:i revenue:d is_b2b:b
    customer_segment:s channel_group:s order_value_tier:s partner_performance_key:s""",
    sql(f"""
    SELECT *, {_LINE_VALUE} AS order_value_tier, CASE WHEN is_b2b THEN 'b2b' ELSE 'b2c' END AS customer_segment,
           CASE WHEN partner_channel = 'international' THEN 'secondary_channels' ELSE 'primary_channels' END AS channel_group,
           {q.key('partner_channel', 'order_id', 'product_sku')} AS partner_performance_key
    FROM (SELECT 'amazon' AS partner_channel, order_id, order_date, COALESCE(product_category, 'Unknown') AS product_category,
                 sku AS product_sku, quantity, order_amount AS revenue, is_b2b FROM orders_staged
          UNION ALL SELECT 'merchant_website', order_id, order_date, COALESCE(product_category, 'Unknown'), product_sku,
                 quantity, NULL, FALSE FROM stock
          UNION ALL SELECT 'international', order_id, order_date, 'Unknown', product_sku, quantity, amount, FALSE FROM report) AS u
    WHERE order_date >= DATE '1995-01-01' AND {q.rules(V.LINE_QUALITY)} = 'valid'"""),
)
def _channel_lines(t):
    report = staging.stage_international_report(t.international_report_raw)
    return staging.partner_base(staging.channel_lines(t.orders, t.stock, report), PARAMS)


register(
    "partner_base",
    """partner_performance_key:s line_key:s partner_channel:s order_id:s order_date:t product_category:s product_sku:s
    quantity:i revenue:d order_value_tier:s customer_segment:s fulfilment_efficiency_score:i revenue_per_unit:d
    estimated_processing_days:i data_quality_flag:s quarter:i month:i day_of_week:i is_business_day:b channel_group:s""",
    sql("SELECT * FROM base"),
)(lambda t: t.base)

register(
    "surrogate_key",
    "line_key:s row_key:s",
    sql(f"SELECT line_key, {q.key('order_id', 'product_sku', 'order_date', 'is_b2b')} AS row_key FROM lines"),
)(lambda t: t.lines.select("line_key", surrogate_key("order_id", "product_sku", "order_date", "is_b2b").alias("row_key")))

register(
    "dim_dates",
    """date_day:t year:i month:i day_of_month:i day_of_week:i week_of_year:i quarter:i year_month:s is_weekend:s""",
    sql("""SELECT d AS date_day, year(d) AS year, month(d) AS month, day(d) AS day_of_month, dayofweek(d) AS day_of_week,
                  weekofyear(d) AS week_of_year, quarter(d) AS quarter, strftime(d, '%Y-%m') AS year_month,
                  CASE WHEN dayofweek(d) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend
           FROM (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS d
                 FROM all_sales) AS s"""),
)(lambda t: date_dimension(staging.all_sales(t.orders, t.stock), "order_date"))

register(
    "dim_products",
    """product_sku:s product_category:s product_style:s product_asin:s total_orders_containing_product:i
    total_quantity_sold_across_all_orders:i""",
    sql("SELECT * FROM products"),
)(lambda t: sales.product_dimension(staging.all_sales(t.orders, t.stock)))


def _items(t):
    everything = staging.all_sales(t.orders, t.stock)
    return sales.order_items(everything, sales.product_dimension(everything), t.prices)


register(
    "fct_order_items",
    """order_id:s order_date:t order_status:s fulfillment_type:s is_b2b:b product_sku:s product_category:s product_style:s
    quantity:i item_revenue_amount:d currency:s item_profit_amount:d _source_file_name:s""",
    sql("SELECT * FROM items"),
)(_items)

register(
    "agg_daily_sales",
    """order_date:t product_category:s fulfillment_type:s daily_revenue:d daily_quantity_sold:i daily_unique_orders:i
    daily_profit:d""",
    sql("""SELECT order_date, product_category, fulfillment_type, SUM(item_revenue_amount) AS daily_revenue,
                  SUM(quantity) AS daily_quantity_sold, COUNT(DISTINCT order_id) AS daily_unique_orders,
                  SUM(item_profit_amount) AS daily_profit FROM items GROUP BY 1, 2, 3"""),
)(lambda t: sales.daily_sales(_items(t)))
