"""Labels, cut points, name lists and decision tables.

Everything in this module is data that has to be equal to the published business
definitions for results to be right.  ``Bands`` cut one number into labels (first
match wins); a decision table is a list of ``(label, predicate)`` pairs tested top
down, the predicate being plain SQL over columns of the row.
"""

from __future__ import annotations

from typing import NamedTuple


class Bands(NamedTuple):
    op: str
    cuts: tuple  # (bound, label), tested in order
    other: str | None


class Rules(NamedTuple):
    rows: tuple  # (label, predicate)
    other: str | None


# --- fixed values: surrogate keys -------------------------------------------------
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# --- fixed values: cleaning labels ------------------------------------------------
ORDER_QUALITY = Rules((
    ("MISSING_ORDER_ID", "order_id is null"),
    ("MISSING_DATE", "order_date_text is null"),
    ("MISSING_AMOUNT", "amount_text is null"),
    ("MISSING_STATUS", "order_status is null"),
), "VALID")
INTERNATIONAL_QUALITY = Rules((
    ("MISSING_SKU", "sku is null"),
    ("MISSING_DATE", "order_date_text is null"),
    ("MISSING_AMOUNT", "gross_amount_text is null"),
    ("MISSING_CUSTOMER", "customer_name is null"),
), "VALID")
STOCK_QUALITY = Rules((
    ("MISSING_SKU", "sku_code is null"),
    ("MISSING_STOCK", "stock_text is null"),
    ("MISSING_CATEGORY", "product_category is null"),
), "VALID")
CATALOG_QUALITY = Rules((
    ("MISSING_SKU", "sku is null"),
    ("MISSING_STYLE_ID", "style_id is null"),
    ("MISSING_CATEGORY", "product_category is null"),
    ("MISSING_TRADE_PRICE", "trade_price_1_text is null"),
), "VALID")
LINE_QUALITY = Rules((
    ("missing_order_id", "order_id is null"),
    ("invalid_revenue", "revenue <= 0"),
    ("invalid_quantity", "quantity <= 0"),
), "valid")

ORDER_STATUS = {
    "Shipped - Delivered to Buyer": "DELIVERED",
    "Shipped": "SHIPPED",
    "Cancelled": "CANCELLED",
}
SIZES = {
    "S": "SMALL",
    "M": "MEDIUM",
    "L": "LARGE",
    "XL": "EXTRA_LARGE",
    "XXL": "DOUBLE_EXTRA_LARGE",
}
FULFILMENT_MODEL = {"Amazon": "FBA", "Merchant": "FBM"}
SHIPPING_SPEED = {"Expedited": "FAST", "Standard": "STANDARD"}
CATALOG_CLASS = {"Kurta": "ETHNIC_WEAR", "Set": "COMBO_WEAR"}

SEASON_MONTHS = {
    "WINTER": (11, 12, 1),
    "SPRING": (2, 3, 4),
    "SUMMER": (5, 6, 7),
    "FALL": (8, 9, 10),
}
CITY_TIERS = {
    "TIER_1": ("MUMBAI", "DELHI", "BANGALORE", "CHENNAI", "HYDERABAD", "KOLKATA"),
    "TIER_2": ("PUNE", "AHMEDABAD", "JAIPUR", "LUCKNOW", "KANPUR", "NAGPUR"),
}
COLOUR_FAMILIES = {
    "RED_FAMILY": ("red", "maroon", "crimson"),
    "BLUE_FAMILY": ("blue", "navy", "sky"),
    "GREEN_FAMILY": ("green", "olive", "mint"),
    "NEUTRAL_FAMILY": ("black", "grey", "charcoal"),
    "WARM_FAMILY": ("yellow", "orange", "gold"),
    "COOL_FAMILY": ("purple", "violet", "pink"),
}
CUSTOMER_PATTERNS = {"PREMIUM_CUSTOMER": "%LOGANATHAN%", "RETAIL_CUSTOMER": "%RETAIL%"}
SKU_PATTERNS = {"MENS_WEAR": "MEN%", "WOMENS_WEAR": "WOMEN%", "KIDS_WEAR": "KIDS%"}
CATEGORY_PATTERNS = {
    "BOTTOM_WEAR": "%LEGGINGS%",
    "ETHNIC_WEAR": "%KURTA%",
    "WESTERN_WEAR": "%DRESS%",
    "TOP_WEAR": "%TOP%",
}
# the underscore is literal here, hence suffix tests instead of wildcard patterns
SIZE_SUFFIXES = {"S": "_S", "M": "_M", "L": "_L", "XL": "_XL", "2XL": "_2XL", "3XL": "_3XL"}

ORDER_AMOUNT_LABELS = ("HIGH_VALUE", "MEDIUM_VALUE", "LOW_VALUE")
STOCK_LEVEL = Rules((
    ("OUT_OF_STOCK", "stock_quantity = 0"),
    ("LOW_STOCK", "stock_quantity <= 3"),
    ("MEDIUM_STOCK", "stock_quantity <= 10"),
    ("HIGH_STOCK", "stock_quantity <= 20"),
), "OVERSTOCKED")
STOCK_RISK = Rules((
    ("CRITICAL", "stock_quantity = 0"),
    ("HIGH_RISK", "stock_quantity <= 3"),
    ("MEDIUM_RISK", "stock_quantity <= 10"),
), "LOW_RISK")
STOCK_REORDER = Rules((
    ("IMMEDIATE_REORDER", "stock_quantity = 0"),
    ("URGENT_REORDER", "stock_quantity <= 3"),
    ("PLAN_REORDER", "stock_quantity <= 10"),
), "NO_ACTION_NEEDED")
STOCK_DEMAND = Rules((
    ("HIGH_DEMAND", "stock_quantity = 0"),
    ("MEDIUM_DEMAND", "stock_quantity <= 3"),
), "LOW_DEMAND")
STOCK_UNIT_VALUE = 500

MARKETPLACES = ("ajio", "amazon", "amazon_fba", "flipkart", "limeroad", "myntra", "paytm", "snapdeal")
MARGIN_MARKETPLACES = ("ajio", "amazon", "flipkart", "myntra")
CHEAPEST_PRIORITY = ("ajio", "amazon", "flipkart", "myntra", "paytm", "snapdeal", "limeroad")
CHEAPEST_OTHER = "AMAZON_FBA"
PRICE_VARIANCE = Rules((
    ("UNIFORM_PRICING", "min_marketplace_price = max_marketplace_price"),
    ("HIGH_PRICE_VARIANCE", "price_spread > 0.2"),
    ("MEDIUM_PRICE_VARIANCE", "price_spread > 0.1"),
), "LOW_PRICE_VARIANCE")
PRICING_ADVICE = Rules((
    ("REDUCE_PRICE", "avg_marketplace_price > trade_price_1 * 2"),
    ("INCREASE_PRICE", "avg_marketplace_price < trade_price_1 * 1.5"),
), "MAINTAIN_PRICE")
PRODUCT_TIER = Bands(">", ((2000, "PREMIUM"), (1000, "MID_RANGE")), "BUDGET")
PROFITABILITY = Rules((
    ("PROFITABLE", "unit_rate > calculated_unit_price"),
    ("BREAKEVEN", "unit_rate = calculated_unit_price"),
), "LOSS")

# --- fixed values: staged orders --------------------------------------------------
GST_RATE = "0.18"
NET_RATE = "0.82"
ORDER_SCORE = (
    (100, "order_status_category = 'DELIVERED' and order_amount > 500"),
    (80, "order_status_category = 'DELIVERED' and order_amount > 250"),
    (60, "order_status_category = 'DELIVERED'"),
    (40, "order_status_category = 'SHIPPED'"),
    (0, "order_status_category = 'CANCELLED'"),
)
ORDER_SCORE_OTHER = 20
BUYER_SEGMENT = Rules((
    ("B2B_CUSTOMER", "is_b2b"),
    ("HIGH_VALUE_B2C", "order_amount > 1000"),
    ("MEDIUM_VALUE_B2C", "order_amount > 500"),
), "LOW_VALUE_B2C")
FULFILMENT_POINTS = (("FBA", 80), (None, 60))
CITY_POINTS = (("TIER_1", 90), ("TIER_2", 70), (None, 50))
COMPOSITE_WEIGHTS = (0.4, 0.3, 0.3)
ORDER_VALIDATION = Rules((
    ("NEGATIVE_AMOUNT", "order_amount < 0"),
    ("INVALID_QUANTITY", "quantity <= 0"),
    ("FUTURE_DATE", "order_date > as_of"),
), "VALID")

# --- fixed values: partner base ---------------------------------------------------
CHANNELS = ("amazon", "merchant_website", "international")
PRIMARY_CHANNELS = ("amazon", "merchant_website")
LINE_VALUE_LABELS = ("high_value", "medium_value", "low_value")
MEDIUM_VALUE_LINE = 100
EFFICIENCY_POINTS = {"amazon": 95, "merchant": 85}
EFFICIENCY_OTHER = 80
PROCESSING_DAYS = {"shipped": 2, "pending": 5}
PROCESSING_OTHER = 10
DAY_NAMES = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
WEEKDAY_MULTIPLIER = 1.0
WEEKEND_MULTIPLIER = 0.7
DAILY_VOLUME = Bands(">=", ((100, "high_volume"), (50, "medium_volume")), "low_volume")
DAILY_TREND = Rules((
    ("above_trend", "daily_revenue > rolling_7_day_avg_revenue * 1.1"),
    ("below_trend", "daily_revenue < rolling_7_day_avg_revenue * 0.9"),
), "on_trend")

# --- fixed values: financial performance ------------------------------------------
REVENUE_SIZE = Bands(">=", ((10000, "large_revenue"), (5000, "medium_revenue"), (1000, "small_revenue")), "micro_revenue")
PROFITABILITY_TIER = "profitable"
MARGIN_HEALTH = "green_flag"
CHANNEL_EFFICIENCY = "efficient"
REVENUE_TREND = Rules((
    ("strong_growth", "daily_revenue > revenue_7_day_ma * 1.1"),
    ("moderate_growth", "daily_revenue > revenue_7_day_ma * 1.05"),
    ("strong_decline", "daily_revenue < revenue_7_day_ma * 0.9"),
    ("declining", "daily_revenue < revenue_7_day_ma * 0.95"),
), "stable")
MARGIN_TREND = Rules((
    ("improving_margins", "daily_gross_margin_rate > gross_margin_7_day_ma * 1.05"),
    ("declining_margins", "daily_gross_margin_rate < gross_margin_7_day_ma * 0.95"),
), "stable_margins")
PERFORMANCE_CLASS = Bands(">=", ((80, "excellent"), (60, "good"), (40, "needs_improvement")), "poor")
RED_FLAG_RISK = Bands(">", ((0.3, "high_risk"), (0.15, "medium_risk"), (0.05, "low_risk")), "minimal_risk")
EFFICIENCY_LEVEL = Bands(">", ((0.8, "highly_efficient"), (0.6, "efficient"), (0.4, "moderately_efficient")), "inefficient")
EXECUTIVE_ALERT = Rules((
    ("revenue_alert", "revenue_trend_indicator = 'strong_decline' and daily_revenue > 1000"),
    ("margin_alert", "margin_trend_indicator = 'declining_margins' and daily_gross_margin_rate < 0.2"),
    ("quality_alert", "red_flag_sku_rate > 0.25"),
    ("risk_alert", "financial_risk_level = 'high_risk'"),
), "normal")
FINANCE_ACTION = Rules((
    ("immediate_review_required", "performance_classification = 'poor' and daily_revenue > 500"),
    ("product_portfolio_review", "loss_making_sku_rate > 0.2"),
    ("channel_optimization", "channel_efficiency_level = 'inefficient'"),
    ("scale_opportunity", "revenue_trend_indicator = 'strong_growth'"),
), "monitor")

# --- fixed values: partner dashboard ----------------------------------------------
EFFICIENT_DAYS = Bands(">=", ((20, "highly_efficient"), (15, "efficient"), (10, "moderately_efficient")), "needs_improvement")
TREND_DIRECTION = Rules((
    ("positive_trend", "above_trend_days > below_trend_days"),
    ("negative_trend", "below_trend_days > above_trend_days"),
), "neutral_trend")
HEALTH_ACTION = Bands(">=", (
    (80, "maintain_current_strategy"), (60, "optimize_operations"), (40, "strategic_review_needed"),
), "immediate_action_required")

# --- fixed values: partner optimisation -------------------------------------------
OPPORTUNITY_LABELS = ("high_opportunity", "medium_opportunity", "optimization_opportunity", "maintain_performance")
PARTNER_CLASS = Rules((
    ("star_performer", "revenue_percentile >= 0.8 and margin_percentile >= 0.8"),
    ("solid_performer", "revenue_percentile >= 0.6 and health_percentile >= 0.6"),
    ("potential_improver", "revenue_percentile >= 0.4 or health_percentile >= 0.4"),
    ("needs_attention", "revenue_percentile >= 0.2 or health_percentile >= 0.2"),
), "underperformer")
PARTNER_INVESTMENT = Rules((
    ("high_investment", "revenue_upside_potential > 50000 and margin_upside_potential > 0.1"),
    ("medium_investment", "revenue_upside_potential > 20000 and margin_upside_potential > 0.05"),
    ("low_investment", "revenue_upside_potential > 5000"),
), "minimal_investment")
OPTIMISATION_FOCUS = Rules((
    ("aov_optimization", "avg_order_value_30d < avg_aov_benchmark * 0.8"),
    ("margin_optimization", "avg_gross_margin_30d < avg_margin_benchmark * 0.8"),
    ("operational_optimization", "avg_fulfilment_efficiency_30d < avg_efficiency_benchmark * 0.9"),
    ("quality_optimization", "red_flag_days > 5"),
), "growth_optimization")
PARTNER_RECOMMENDATION = Rules((
    ("implement_upselling_cross_selling", "revenue_gap_vs_avg < -10000 and aov_gap_vs_avg < -50"),
    ("increase_marketing_investment", "revenue_gap_vs_avg < -10000 and order_growth_30d < 0.1"),
    ("target_high_value_customers", "revenue_gap_vs_avg < -5000 and high_value_order_rate_30d < 0.3"),
    ("improve_operational_efficiency", "margin_gap_vs_avg < -0.1 and avg_processing_days_30d > 5"),
    ("optimize_amazon_fees", "margin_gap_vs_avg < -0.1 and partner_channel = 'amazon'"),
    ("negotiate_better_supplier_terms", "margin_gap_vs_avg < -0.05"),
    ("upgrade_fulfillment_processes", "avg_fulfilment_efficiency_30d < 85"),
    ("implement_data_quality_controls", "avg_data_quality_30d < 0.95"),
    ("address_quality_issues", "red_flag_days > 3"),
    ("scale_successful_practices", "strategic_classification = 'star_performer'"),
    ("accelerate_growth_initiatives", "overall_trend_direction = 'positive_trend'"),
), "maintain_current_operations")
PARTNER_IMPACT = Bands(">", ((100000, "high_impact"), (50000, "medium_impact"), (10000, "low_impact")), "minimal_impact")
FOCUS_COMPLEXITY = {
    "quality_optimization": "low_complexity",
    "aov_optimization": "medium_complexity",
    "operational_optimization": "high_complexity",
    "margin_optimization": "high_complexity",
}
FOCUS_COMPLEXITY_OTHER = "medium_complexity"
INVESTMENT_RESOURCES = {
    "high_investment": "significant_resources",
    "medium_investment": "moderate_resources",
    "low_investment": "minimal_resources",
}
INVESTMENT_RESOURCES_OTHER = "maintenance_resources"
PARTNER_TIMELINE = Rules((
    ("immediate_action", "strategic_classification = 'underperformer'"),
    ("priority_implementation", "expected_impact = 'high_impact'"),
    ("quick_wins", "implementation_complexity = 'low_complexity'"),
), "standard_timeline")
FOCUS_SUCCESS = {
    "aov_optimization": "increase_avg_order_value_by_20%",
    "margin_optimization": "improve_gross_margin_by_5pp",
    "operational_optimization": "reduce_processing_time_by_2_days",
    "quality_optimization": "achieve_99%_data_quality",
}
FOCUS_SUCCESS_OTHER = "increase_revenue_by_15%"
PARTNER_RISK = Rules((
    ("high_risk", "strategic_classification = 'underperformer' and revenue_30d > 50000"),
    ("medium_risk", "overall_trend_direction = 'negative_trend' and partner_priority_rank <= 3"),
    ("operational_risk", "red_flag_days > 10"),
), "low_risk")
IMPACT_POINTS = ({"high_impact": 30, "medium_impact": 20, "low_impact": 10}, 0)
COMPLEXITY_POINTS = ({"low_complexity": 25, "medium_complexity": 15, "high_complexity": 5}, 10)
CLASS_POINTS = ({"underperformer": 25, "needs_attention": 20, "potential_improver": 15}, 10)
RISK_POINTS = ({"high_risk": 20, "medium_risk": 15, "operational_risk": 10}, 5)
EXECUTIVE_TEXT = Rules((
    ("Maintain excellence and scale best practices", "strategic_classification = 'star_performer'"),
    ("Immediate intervention required", "strategic_classification = 'underperformer'"),
    ("High-value quick win opportunity", "expected_impact = 'high_impact' and implementation_complexity = 'low_complexity'"),
    ("Risk mitigation is priority", "risk_level = 'high_risk'"),
), "Standard optimization opportunity")
INSIGHT_TEXT = Rules((
    ("Review Amazon fee structure and pricing strategy", "partner_channel = 'amazon' and margin_gap_vs_avg < -0.05"),
    ("Implement B2B-specific value propositions", "customer_segment = 'b2b' and aov_gap_vs_avg < -100"),
    ("Investigate competitive pressures and market changes", "overall_trend_direction = 'negative_trend'"),
    ("Leverage shared platform capabilities", "efficiency_rating = 'needs_improvement'"),
), "Continue current optimization initiatives")

# --- fixed values: customers ------------------------------------------------------
RFM_SEGMENT = Rules((
    ("Champions", "recency_score >= 4 and frequency_score >= 4 and monetary_score >= 4"),
    ("Loyal Customers", "recency_score >= 3 and frequency_score >= 3 and monetary_score >= 3"),
    ("Potential Loyalists", "recency_score >= 3 and frequency_score <= 2 and monetary_score >= 3"),
    ("New Customers", "recency_score >= 4 and frequency_score <= 2 and monetary_score <= 2"),
    ("Promising", "recency_score >= 3 and frequency_score <= 2 and monetary_score <= 2"),
    ("Need Attention", "recency_score <= 2 and frequency_score >= 3 and monetary_score >= 3"),
    ("About to Sleep", "recency_score <= 2 and frequency_score <= 2 and monetary_score >= 3"),
    ("At Risk", "recency_score <= 2 and frequency_score >= 3 and monetary_score <= 2"),
    ("Lost", "recency_score <= 2 and frequency_score <= 2 and monetary_score <= 2"),
), "Others")
LIFECYCLE = Rules((
    ("New Customer", "total_orders = 1"),
    ("Active Customer", "total_orders >= 2 and days_since_last_order <= 30"),
    ("Occasional Customer", "total_orders >= 2 and days_since_last_order between 31 and 90"),
    ("Dormant Customer", "total_orders >= 2 and days_since_last_order between 91 and 180"),
    ("Churned Customer", "days_since_last_order > 180"),
), "Undefined")
CUSTOMER_VALUE = Bands(">=", ((5000, "VIP"), (2000, "High Value"), (1000, "Medium Value"), (500, "Low Value")), "Minimal Value")
ENGAGEMENT = Rules((
    ("Highly Engaged", "unique_categories_purchased >= 3 and total_orders >= 5"),
    ("Moderately Engaged", "unique_categories_purchased >= 2 and total_orders >= 3"),
    ("Lightly Engaged", "total_orders >= 2"),
), "Single Purchase")
SEASON_SHOPPERS = (
    ("winter_orders", "Winter Shopper"), ("spring_orders", "Spring Shopper"),
    ("summer_orders", "Summer Shopper"), ("fall_orders", "Fall Shopper"),
)
CHURN_STEPS = ((180, 0.9), (90, 0.7), (60, 0.5), (30, 0.3))
CHURN_OTHER = 0.1
UPSELL = Rules((
    ("High Cross-sell", "unique_categories_purchased = 1 and total_orders >= 3"),
    ("High Upsell", "avg_order_value < total_revenue * 0.8"),
    ("Premium Upsell", "lifecycle_stage = 'Active Customer' and value_tier in ('High Value', 'VIP')"),
), "Standard")
FAVOURITE_CATEGORY = "kurta"
LTV_LABELS = ("High Value", "Medium Value", "Low Value")

# --- fixed values: customer segments ----------------------------------------------
LOYALTY = Bands(">=", ((10, "highly_loyal"), (5, "loyal"), (2, "repeat_customer")), "one_time_buyer")
SEGMENT_VALUE = Bands(">=", ((5000, "high_value"), (2000, "medium_value"), (500, "low_value")), "minimal_value")
ACTIVE_DAYS = Bands(">=", ((30, "highly_engaged"), (15, "engaged"), (7, "moderately_engaged")), "low_engagement")
CHANNEL_PREFERENCE = Rules((
    ("amazon_preferred", "amazon_active_days >= merchant_active_days and amazon_active_days >= international_active_days"),
    ("merchant_preferred", "merchant_active_days >= international_active_days"),
    ("international_preferred", "international_active_days > 0"),
), "no_clear_preference")
QUARTER_SEASONAL = (
    ("q4_orders", "q4_seasonal"), ("q3_orders", "q3_seasonal"),
    ("q2_orders", "q2_seasonal"), ("q1_orders", "q1_seasonal"),
)
SILENT_DAYS_CHURN = Bands(">", ((90, "high_churn_risk"), (60, "medium_churn_risk"), (30, "low_churn_risk")), "active")
BUSINESS_SHARE = Rules((
    ("primarily_b2b", "b2b_share >= 0.8"),
    ("mixed_b2b_b2c", "b2b_share >= 0.5"),
    ("occasional_b2b", "b2b_orders > 0"),
), "b2c_only")
SPENDING = Bands(">", ((1.5, "variable_spender"), (0.8, "moderate_spender")), "consistent_spender")
HIGH_VALUE_SHARE = Bands(">=", ((0.3, "high_value_buyer"), (0.1, "occasional_high_value")), "standard_buyer")
SILENT_DAYS_SCORE = Bands("<=", ((30, 5), (60, 4), (90, 3), (180, 2)), 1)
ORDERS_PER_MONTH_SCORE = Bands(">=", ((5, 5), (3, 4), (1, 3), (0.5, 2)), 1)
REVENUE_SCORE = Bands(">=", ((5000, 5), (2000, 4), (1000, 3), (500, 2)), 1)
STRATEGIC_SEGMENT = Rules((
    ("enterprise_partner", "customer_segment = 'b2b' and total_revenue >= 10000"),
    ("business_partner", "customer_segment = 'b2b' and total_revenue >= 5000"),
    ("small_business", "customer_segment = 'b2b'"),
    ("vip_consumer", "customer_segment = 'b2c' and total_revenue >= 2000"),
    ("loyal_consumer", "customer_segment = 'b2c' and total_orders >= 10"),
    ("repeat_consumer", "customer_segment = 'b2c' and total_orders >= 2"),
), "new_consumer")
PERSONA = Rules((
    ("amazon_premium_shopper", "channel_preference = 'amazon_preferred' and high_value_propensity = 'high_value_buyer'"),
    ("brand_loyalist", "channel_preference = 'merchant_preferred' and loyalty_tier = 'highly_loyal'"),
    ("global_customer", "channel_preference = 'international_preferred'"),
    ("business_procurement", "business_customer_type = 'primarily_b2b'"),
    ("seasonal_buyer", "seasonal_pattern <> 'no_seasonal_pattern'"),
    ("opportunistic_buyer", "spending_pattern = 'variable_spender'"),
), "standard_customer")
CLV_TIER = Bands(">=", ((10000, "platinum"), (5000, "gold"), (2000, "silver"), (500, "bronze")), "basic")
SEGMENT_ACTION = Rules((
    ("retention_campaign", "churn_risk_level = 'high_churn_risk' and value_tier in ('high_value', 'medium_value')"),
    ("repeat_purchase_incentive", "loyalty_tier = 'one_time_buyer' and avg_order_value >= 100"),
    ("account_management", "strategic_segment = 'enterprise_partner'"),
    ("premium_product_recommendation", "marketing_persona = 'amazon_premium_shopper'"),
    ("seasonal_marketing", "seasonal_pattern <> 'no_seasonal_pattern'"),
), "standard_marketing")
SEGMENT_PRIORITY = Rules((
    ("high_priority", "strategic_segment in ('enterprise_partner', 'vip_consumer')"),
    ("medium_priority", "strategic_segment in ('business_partner', 'loyal_consumer')"),
), "low_priority")

# --- fixed values: products -------------------------------------------------------
UNIT_COST = Bands("<=", ((50, "low_cost"), (200, "medium_cost")), "high_cost")
COST_STABILITY = Bands("<", ((0.1, "stable_cost"), (0.3, "moderate_cost_variation")), "volatile_cost")
EXPENSE_TIER = Bands("<=", ((10, "low_expense"), (50, "medium_expense")), "high_expense")
QUARTER_PEAK = (
    ("q4_revenue", "q4_peak"), ("q3_revenue", "q3_peak"),
    ("q2_revenue", "q2_peak"), ("q1_revenue", "q1_peak"),
)
MARGIN_CATEGORY = Bands(">=", ((0.4, "high_margin"), (0.25, "medium_margin"), (0.1, "low_margin")), "negative_margin")
VELOCITY = Bands(">=", ((10, "fast_moving"), (5, "medium_velocity"), (1, "slow_moving")), "very_slow_moving")
PRODUCT_REVENUE = Bands(">=", (
    (50000, "star_product"), (20000, "key_product"), (5000, "supporting_product"), (1000, "niche_product"),
), "low_performer")
CHANNEL_STRATEGY = Rules((
    ("amazon_focused", "amazon_revenue_share >= 0.7"),
    ("merchant_focused", "merchant_revenue_share >= 0.7"),
    ("international_opportunity", "international_revenue_share >= 0.3"),
), "multi_channel")
CUSTOMER_FOCUS = Bands(">=", ((0.7, "b2b_focused"), (0.3, "mixed_segment")), "b2c_focused")
SEASONALITY = Bands(">=", ((0.8, "highly_seasonal"), (0.4, "moderately_seasonal"), (0.2, "slightly_seasonal")), "non_seasonal")
PRODUCT_LIFECYCLE = Rules((
    ("declining", "silent_days > 90"),
    ("mature", "silent_days > 30"),
    ("new_product", "product_lifespan_days <= 30"),
    ("growth", "daily_revenue_rate > 100"),
), "stable")
PRODUCT_INVESTMENT = Rules((
    ("invest_heavily", "revenue_tier = 'star_product' and margin_category = 'high_margin'"),
    ("maintain_investment", "revenue_tier in ('star_product', 'key_product') and margin_category <> 'negative_margin'"),
    ("divest", "margin_category = 'negative_margin' and revenue_tier not in ('star_product', 'key_product')"),
    ("review_for_discontinuation", "velocity_category = 'very_slow_moving' and margin_category = 'low_margin'"),
), "standard_investment")
PRODUCT_MARKETING = Rules((
    ("seasonal_marketing", "seasonality_level = 'highly_seasonal'"),
    ("amazon_optimization", "channel_strategy = 'amazon_focused'"),
    ("b2b_marketing", "customer_focus = 'b2b_focused'"),
    ("scale_marketing", "velocity_category = 'fast_moving'"),
    ("awareness_building", "lifecycle_stage = 'new_product'"),
), "standard_marketing")
PRODUCT_CLASS = Rules((
    ("cash_cow", "revenue_tier = 'star_product' and margin_category = 'high_margin'"),
    ("rising_star", "revenue_tier in ('star_product', 'key_product') and lifecycle_stage = 'growth'"),
    ("sunset_product", "margin_category = 'negative_margin' or lifecycle_stage = 'declining'"),
    ("question_mark", "velocity_category = 'very_slow_moving' and revenue_tier = 'low_performer'"),
), "core_product")
PRODUCT_ACTION = {
    "cash_cow": "maximize_profitability",
    "rising_star": "invest_for_growth",
    "sunset_product": "phase_out_planning",
    "question_mark": "evaluate_potential",
}
PRODUCT_ACTION_OTHER = "optimize_operations"

# --- fixed values: cohorts --------------------------------------------------------
COHORT_STAGE = Bands("<=", ((0, "initial"), (3, "early_lifecycle"), (12, "mature_lifecycle")), "extended_lifecycle")
RETENTION_CLASS = Bands(">=", ((0.8, "high_retention"), (0.6, "medium_retention"), (0.4, "low_retention")), "high_churn")
REVENUE_CLASS = Bands(">=", ((1.2, "expansion_revenue"), (0.8, "stable_revenue"), (0.5, "declining_revenue")), "significant_decline")
LTV_MULTIPLIER = Bands(">=", ((12, 1.0), (6, 1.5), (3, 2.0)), 3.0)
COHORT_WEIGHTS = (("retention_rate", 40), ("revenue_retention_rate", 30), ("high_value_customer_rate", 20), ("repeat_customer_rate", 10))
COHORT_AGE = Bands("<=", ((3, "recent_cohort"), (12, "mature_cohort")), "historical_cohort")
COHORT_VALUE = Rules((
    ("high_value_cohort", "cohort_size >= 100 and retention_rate >= 0.7"),
    ("medium_value_cohort", "cohort_size >= 50 and retention_rate >= 0.5"),
    ("low_value_cohort", "cohort_size >= 20 and retention_rate >= 0.3"),
), "monitor_cohort")
COHORT_ADVICE = Rules((
    ("improve_onboarding", "retention_classification = 'high_churn' and period_number <= 3"),
    ("implement_retention_campaigns", "revenue_classification = 'declining_revenue'"),
    ("focus_on_upselling", "high_value_customer_rate < 0.2"),
    ("improve_customer_experience", "repeat_customer_rate < 0.5"),
), "maintain_current_strategy")
COHORT_STRATEGY = Rules((
    ("star_cohort", "business_value_assessment = 'high_value_cohort' and retention_classification = 'high_retention'"),
    ("optimize_cohort", "business_value_assessment = 'high_value_cohort' and retention_classification = 'medium_retention'"),
    ("scale_cohort", "business_value_assessment = 'medium_value_cohort' and retention_classification = 'high_retention'"),
    ("at_risk_cohort", "retention_classification = 'high_churn'"),
), "standard_cohort")
COHORT_INVESTMENT = Rules((
    ("maintain_excellence", "strategic_classification = 'star_cohort'"),
    ("immediate_intervention", "strategic_classification = 'at_risk_cohort' and cohort_size >= 50"),
    ("targeted_optimization", "strategic_classification = 'optimize_cohort'"),
    ("growth_investment", "strategic_classification = 'scale_cohort'"),
), "standard_management")
COHORT_OUTCOME = {
    "improve_onboarding": "increase_month_1_retention_by_15%",
    "implement_retention_campaigns": "reduce_churn_by_20%",
    "focus_on_upselling": "increase_ltv_by_25%",
    "improve_customer_experience": "increase_repeat_rate_by_30%",
}
COHORT_OUTCOME_OTHER = "maintain_current_metrics"

# --- fixed values: international rows of the unified sales table -------------------
INTERNATIONAL_FIELDS = {
    "sales_channel": "INTERNATIONAL",
    "city_tier": "INTERNATIONAL",
    "shipping_city": "INTERNATIONAL",
    "shipping_state": "INTERNATIONAL",
    "shipping_country": "INTERNATIONAL",
    "fulfillment_model": "DIRECT",
    "order_status_category": "DELIVERED",
}
INTERNATIONAL_ORDER_SCORE = 85
INTERNATIONAL_COMPOSITE = 90

# --- fixed values: scores and grades ----------------------------------------------
PARTNER_GRADE = Bands(">=", ((90, "A+"), (80, "A"), (70, "B"), (60, "C")), "D")
QUALITY_STATUS = Bands(">=", ((95, "EXCELLENT"), (90, "GOOD"), (80, "FAIR")), "POOR")
DRIFT_SEVERITY = Bands(">", ((2, "HIGH"), (1, "MEDIUM")), "LOW")
VOLUME_SEVERITY = Bands(">", ((20, "HIGH"), (10, "MEDIUM")), "LOW")

# --- fixed values: monitoring -----------------------------------------------------
COMPLETENESS_SEVERITY = Bands("<", ((0.8, "HIGH"), (0.95, "MEDIUM")), "LOW")
FRESHNESS_SEVERITY = Bands(">", ((48, "CRITICAL"), (24, "HIGH")), "LOW")
UNIQUENESS_SEVERITY = Bands("<", ((0.9, "HIGH"),), "MEDIUM")
VALIDITY_SEVERITY = Bands("<", ((0.95, "HIGH"),), "MEDIUM")
COMPLIANCE_SEVERITY = Bands("<", ((0.9, "MEDIUM"),), "LOW")
COMPLIANCE_PASS = 0.95
EXTRA_COMPLETENESS_COLUMNS = ("revenue_30d", "overall_health_score", "order_date")
TIMESTAMP_COLUMNS = (
    "dashboard_updated_at", "summary_created_at", "insights_generated_at",
    "analysis_created_at", "segment_created_at", "intelligence_updated_at",
)
RECENT_DAYS = 30
MIN_GROUP_ROWS = 7
LAST_ROWS = 3
Z_LIMIT = 2.0
EXPECTED_MARGIN = 0.2
DIGEST_ROWS = 5
CONTRADICTION = (
    "(revenue_30d > 0 and overall_health_score < 20)"
    " or (revenue_30d < 1000 and overall_health_score > 80)"
    " or (revenue_growth_30d < -0.5 and recommended_action = 'maintain_current_strategy')"
)
RECONCILE_TOLERANCE = 1000
