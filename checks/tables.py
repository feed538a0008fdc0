"""The given Parquet tables seen as sales reports.

The mapping is portable SQL, run by Spark here and put in front of every oracle query as
common table expressions, so both sides start from the same lines.  ``{name}`` is a table.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyloom import Params
from tallyloom.plans import finance, partner, raw, staging
from tallyloom.sources.staging import spread, stage

AS_OF = date(2001, 8, 1)
NOW = datetime(2001, 8, 1)
PARAMS = Params(as_of=AS_OF, min_date=date(1995, 1, 1))
TODAY = "DATE '2001-08-01'"

PARTS = """
SELECT p_partkey, p_brand, p_type, p_size, p_name,
       CAST(p_retailprice AS DECIMAL(10,2)) AS retail,
       CASE mod(p_size, 4) WHEN 0 THEN 'MEN' WHEN 1 THEN 'WOMEN' WHEN 2 THEN 'KIDS' ELSE 'SET' END
         || CAST(p_partkey AS STRING) || '_'
         || CASE mod(p_size, 7) WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'L' WHEN 3 THEN 'XL'
                                WHEN 4 THEN '2XL' WHEN 5 THEN '3XL' ELSE 'FREE' END AS sku,
       CASE mod(p_size, 6) WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'L' WHEN 3 THEN 'XL'
                           WHEN 4 THEN 'XXL' ELSE 'FREE' END AS size_text
FROM {part}
"""

BUYERS = """
SELECT o_orderkey, c_custkey, c_name, c_mktsegment, n_nationkey, n_name, r_name, o_orderpriority,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE o_orderstatus WHEN 'F' THEN 'Shipped - Delivered to Buyer' WHEN 'O' THEN 'Shipped'
                          ELSE 'Cancelled' END AS order_status,
       CASE WHEN r_name IN ('AFRICA', 'AMERICA') THEN 'amazon' WHEN r_name = 'ASIA' THEN 'merchant_website'
            ELSE 'international' END AS partner_channel
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
     JOIN {region} ON n_regionkey = r_regionkey
"""

LINES = """
SELECT md5(CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)
           || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING)
           || '-' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)
           || '-' || CAST(CAST(l_quantity AS INT) AS STRING)) AS line_key,
       l_orderkey AS order_id, c_custkey AS customer_id, lower(sku) AS product_sku, sku, order_date, order_status,
       CASE l_linestatus WHEN 'F' THEN 'Amazon' ELSE 'Merchant' END AS fulfillment_type,
       p_type AS product_category, p_brand AS product_style, 'A' || CAST(l_suppkey AS STRING) AS product_asin,
       CAST(l_quantity AS INT) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS revenue,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
            * CAST(0.002 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS expense,
       'INR' AS currency, c_mktsegment IN ('MACHINERY', 'BUILDING') AS is_b2b, partner_channel,
       'lineitem' AS _source_file_name,
       CAST(l_shipdate AS DATE) AS ship_date, l_linenumber, l_returnflag, CAST(l_discount AS DECIMAL(4,2)) AS discount,
       size_text, c_name, c_mktsegment, n_nationkey, n_name, r_name, o_orderpriority
FROM {lineitem} JOIN {buyers} ON l_orderkey = o_orderkey JOIN {parts} ON l_partkey = p_partkey
"""

MARKET_RAW = """
SELECT CAST(order_id AS STRING) AS order_id, CAST(order_date AS STRING) AS order_date_text,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE order_status END AS order_status, fulfillment_type,
       'Amazon.in' AS sales_channel,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Expedited' WHEN '2-HIGH' THEN 'Standard'
                            WHEN '3-MEDIUM' THEN 'Standard' ELSE 'Economy' END AS shipping_service_level,
       product_style AS style_code, product_sku AS sku, product_category, size_text AS product_size,
       product_asin AS asin, l_returnflag AS courier_status, CAST(CAST(quantity AS DECIMAL(6,1)) AS STRING) AS quantity_text,
       currency AS currency_code, CASE WHEN discount > 0.09 THEN NULL ELSE CAST(revenue AS STRING) END AS amount_text,
       CASE mod(n_nationkey, 14) WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'DELHI' WHEN 2 THEN 'bangalore' WHEN 3 THEN 'CHENNAI'
            WHEN 4 THEN 'Hyderabad' WHEN 5 THEN 'KOLKATA' WHEN 6 THEN 'Pune' WHEN 7 THEN 'AHMEDABAD' WHEN 8 THEN 'JAIPUR'
            WHEN 9 THEN 'Lucknow' WHEN 10 THEN 'KANPUR' WHEN 11 THEN 'NAGPUR' WHEN 12 THEN 'Goa' ELSE 'Surat' END AS shipping_city,
       n_name AS shipping_state, CAST(n_nationkey AS STRING) AS shipping_postal_code, r_name AS shipping_country,
       CASE WHEN discount > 0.05 THEN 'PROMO' WHEN discount > 0.02 THEN '' ELSE NULL END AS promotion_ids,
       CASE WHEN is_b2b THEN 'true' ELSE 'false' END AS b2b_text, 'Easy Ship' AS fulfilled_by
FROM {lines} WHERE partner_channel = 'amazon'
"""

INTERNATIONAL_RAW = """
SELECT sku, product_style AS style_code,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'LOGANATHAN ' || c_name WHEN 'HOUSEHOLD' THEN c_name || ' RETAIL'
                         ELSE c_name END AS customer_name,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(order_date AS STRING) END AS order_date_text,
       substr(CAST(order_date AS STRING), 6, 2) || '-' || substr(CAST(order_date AS STRING), 9, 2) || '-'
         || substr(CAST(order_date AS STRING), 3, 2) AS month_first_text,
       substr(CAST(order_date AS STRING), 1, 7) AS order_month_text, size_text AS product_size,
       CAST(quantity AS STRING) AS quantity_text,
       CAST(CASE WHEN quantity = 1 THEN CAST(revenue AS DECIMAL(10,2))
                 ELSE CAST(floor(CAST(revenue AS DOUBLE) / quantity) AS DECIMAL(10,2)) END
            + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE -1 END AS STRING) AS rate_text,
       CASE WHEN discount > 0.09 THEN 'n/a' ELSE CAST(revenue AS STRING) END AS gross_amount_text
FROM {lines} WHERE partner_channel = 'international'
"""

STOCK_RAW = """
SELECT sku AS sku_code, p_brand || '-' || CAST(p_partkey AS STRING) AS design_number,
       CASE p_type WHEN 'MEDIUM' THEN 'LEGGINGS' WHEN 'STANDARD' THEN 'KURTA' WHEN 'LARGE' THEN 'DRESS'
                   WHEN 'PROMO' THEN 'CROP TOP' WHEN 'SMALL' THEN 'KURTA SET' ELSE 'SAREE' END AS product_category,
       size_text AS product_size, split_part(p_name, ' ', 1) AS product_color,
       CASE WHEN p_size = 50 THEN NULL ELSE CAST(mod(p_size, 26) AS STRING) END AS stock_text
FROM {parts}
"""

_PRICE = "CAST(CAST(retail * CAST({f} AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS STRING) AS {name}"
# base price level by size, then a spread between shops that also depends on the size
_LEVEL = "CAST(0.06 + mod(p_size, 5) * 0.60 AS DECIMAL(4,2))"
_SHOPS = {"ajio": 2, "amazon": 0, "amazon_fba": 1, "flipkart": 1, "limeroad": 3, "myntra": 2, "paytm": 0, "snapdeal": 1}


def _shop_price(shop: str, step: int) -> str:
    bump = f"CAST(1 + mod(p_size, 4) * {step} * 0.03 AS DECIMAL(4,2))"
    price = f"CAST(CAST(retail * {_LEVEL} AS DECIMAL(10,2)) * {bump} AS DECIMAL(10,2))"
    text = f"CAST({price} AS STRING)"
    if shop == "paytm":
        text = f"CASE WHEN p_size = 49 THEN NULL ELSE {text} END"
    return f"{text} AS {shop}_mrp_text"


PRICES_RAW = f"""
SELECT sku, p_brand AS style_id, 'Catalog ' || p_type AS catalog_name,
       CASE p_type WHEN 'MEDIUM' THEN 'Kurta' WHEN 'STANDARD' THEN 'Set' ELSE p_type END AS product_category,
       CAST(CAST(p_size * 0.1 AS DECIMAL(5,2)) AS STRING) AS weight_text,
       {_PRICE.format(f=0.03, name="trade_price_1_text")}, {_PRICE.format(f=0.04, name="trade_price_2_text")},
       {_PRICE.format(f=0.05, name="mrp_old_text")}, {_PRICE.format(f=0.06, name="final_mrp_old_text")},
       {", ".join(_shop_price(s, k) for s, k in _SHOPS.items())}
FROM {{parts}}
"""

EXPENSES_RAW = """
SELECT 'x' AS column0,
       substr(CAST(ship_date AS STRING), 6, 2) || '-' || substr(CAST(ship_date AS STRING), 9, 2) || '-'
         || CASE l_returnflag WHEN 'A' THEN substr(CAST(ship_date AS STRING), 1, 4)
                              ELSE substr(CAST(ship_date AS STRING), 3, 2) END AS column1,
       ' ' || sku AS column2, 'Freight ' || n_name AS column3,
       CASE WHEN l_linenumber = 6 THEN 'total' ELSE CAST(expense AS STRING) END AS column4
FROM {lines}
"""

TEXTS = {
    "parts": PARTS, "buyers": BUYERS, "lines": LINES, "market_raw": MARKET_RAW, "international_raw": INTERNATIONAL_RAW,
    "stock_raw": STOCK_RAW, "prices_raw": PRICES_RAW, "expenses_raw": EXPENSES_RAW,
}
_GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def with_tables(sql: str, ctes: dict[str, str]) -> str:
    """Oracle text: the mapping and further CTEs (in order of definition) before a SELECT."""
    names = {n: n for n in (*_GIVEN, *TEXTS)}
    parts = {**{n: t.format(**names) for n, t in TEXTS.items()}, **ctes}
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in parts.items()) + f" {sql}"


MARKET_HEADERS = {
    "order_id": "Order ID", "order_date_text": "Date", "order_status": "Status", "fulfillment_type": "Fulfilment",
    "sales_channel": "Sales Channel", "shipping_service_level": "ship-service-level", "style_code": "Style",
    "sku": "SKU", "product_category": "Category", "product_size": "Size", "asin": "ASIN",
    "courier_status": "Courier Status", "quantity_text": "Qty", "currency_code": "currency", "amount_text": "Amount",
    "shipping_city": "ship-city", "shipping_state": "ship-state", "shipping_postal_code": "ship-postal-code",
    "shipping_country": "ship-country", "promotion_ids": "promotion-ids", "b2b_text": "B2B", "fulfilled_by": "fulfilled-by",
}
INTERNATIONAL_HEADERS = {
    "sku": "SKU", "style_code": "Style", "customer_name": "CUSTOMER", "order_date_text": "DATE",
    "order_month_text": "Months", "product_size": "Size", "quantity_text": "PCS", "rate_text": "RATE",
    "gross_amount_text": "GROSS AMT",
}
STOCK_HEADERS = {
    "sku_code": "SKU Code", "design_number": "Design No.", "product_category": "Category", "product_size": "Size",
    "product_color": "Color", "stock_text": "Stock",
}
PRICE_HEADERS = {
    "sku": "Sku", "style_id": "Style Id", "catalog_name": "Catalog", "product_category": "Category",
    "weight_text": "Weight", "trade_price_1_text": "TP 1", "trade_price_2_text": "TP 2", "mrp_old_text": "MRP Old",
    "final_mrp_old_text": "Final MRP Old",
    **{f"{s}_mrp_text": f"{'Amazon FBA' if s == 'amazon_fba' else s.capitalize()} MRP" for s in _SHOPS},
}


class Tables:
    """Given tables of one folder and the reports derived from them, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def rows(self) -> int:
        """Rows of the largest table, read from the files' footers; the lines are as many where keys do not repeat."""
        return self.given("lineitem").count()

    def _sql(self, name: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(TEXTS[name], **frames)

    def _headers(self, df: DataFrame, names: dict[str, str]) -> DataFrame:
        return df.select(*[df[c].alias(h) for c, h in names.items()])

    @cached_property
    def parts(self) -> DataFrame:
        return self._sql("parts", part=self.given("part"))

    @cached_property
    def lines(self) -> DataFrame:
        buyers = self._sql("buyers", **{n: self.given(n) for n in ("orders", "customer", "nation", "region")})
        # both joins in tasks that do not grow with the tables
        lineitem, parts = spread(self.given("lineitem"), ["l_orderkey"], self.rows), spread(self.parts, ["p_partkey"], self.rows)
        return self._sql("lines", lineitem=lineitem, buyers=buyers, parts=parts)

    @cached_property
    def market_raw(self) -> DataFrame:
        return self._headers(self._sql("market_raw", lines=self.lines), MARKET_HEADERS)

    @cached_property
    def international_raw(self) -> DataFrame:
        return self._headers(self._sql("international_raw", lines=self.lines), INTERNATIONAL_HEADERS)

    @cached_property
    def international_report_raw(self) -> DataFrame:
        """The same report with month-first dates."""
        names = {("month_first_text" if c == "order_date_text" else c): h for c, h in INTERNATIONAL_HEADERS.items()}
        return self._headers(self._sql("international_raw", lines=self.lines), names)

    @cached_property
    def stock_raw(self) -> DataFrame:
        return self._headers(self._sql("stock_raw", parts=self.parts), STOCK_HEADERS)

    @cached_property
    def prices_raw(self) -> DataFrame:
        return self._headers(self._sql("prices_raw", parts=self.parts), PRICE_HEADERS)

    @cached_property
    def expenses_raw(self) -> DataFrame:
        return self._sql("expenses_raw", lines=self.lines)

    # ---- staged -----------------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return staging.staged_orders(raw.marketplace_orders(self.market_raw, PARAMS), PARAMS)

    @cached_property
    def international(self) -> DataFrame:
        return raw.international_sales(self.international_raw)

    @cached_property
    def stock(self) -> DataFrame:
        return staging.stage_stock_report(self.stock_raw)

    @cached_property
    def prices(self) -> DataFrame:
        return staging.stage_price_list(self.prices_raw)

    @cached_property
    def expenses(self) -> DataFrame:
        return staging.stage_expenses(self.expenses_raw)

    @cached_property
    def catalog(self) -> DataFrame:
        return raw.price_catalog(self.prices_raw)

    @cached_property
    def base(self) -> DataFrame:
        """Partner base over all lines of the three channels."""
        return staging.partner_base(self.lines, PARAMS)

    @cached_property
    def base_once(self) -> DataFrame:
        """The columns of the partner base that daily metrics, financial performance and costs read, staged for queries that read them
        more than once."""
        return stage(self.base.select(*dict.fromkeys((*partner.LINE_COLUMNS, *finance.LINE_COLUMNS, "fulfillment_type"))), "base")
