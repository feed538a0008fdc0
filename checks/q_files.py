"""External files: derived reports written as CSV and read back by name, and the sinks read back."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import functions as F

from tallyloom.plans import raw
from tallyloom.sources import catalog, sinks
from tallyloom.sources.staging import new_path

from .q_staging import sql
from .spec import register
from .tables import INTERNATIONAL_HEADERS, MARKET_HEADERS, NOW, PARAMS, PRICE_HEADERS, STOCK_HEADERS

#: lines of a file under titles, about
FILE_ROWS = 1_000_000


def _csv(t, name: str, report):
    """The report as CSV with its columns in reverse and one more in front, read back as a source."""
    folder, source = new_path(t.spark, "files"), catalog.SOURCES[name]
    columns = list(source.columns)
    if source.header:
        report = report.select(F.lit("x").alias("index"), *[F.col(f"`{c}`") for c in reversed(columns)])
    report.write.csv(
        f"{folder}/{source.file}", header=source.header, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return catalog.read_source(t.spark, name, folder)


#: a CSV file has no empty text beside NULL
def _register(query: str, name: str, headers: dict[str, str], view: str, report) -> None:
    out = " ".join(f"{c}:s" for c in headers)

    def run(t):
        return _csv(t, name, report(t)).select(*[F.col(f"`{h}`").alias(c) for c, h in headers.items()])

    register(query, out, sql(f"SELECT {', '.join(f"NULLIF({c}, '') AS {c}" for c in headers)} FROM {view}"))(run)


_register("csv_orders", "marketplace_orders", MARKET_HEADERS, "market_raw", lambda t: t.market_raw)
_register(
    "csv_international", "international_sales", INTERNATIONAL_HEADERS, "international_raw", lambda t: t.international_raw)
_register("csv_stock", "stock_report", STOCK_HEADERS, "stock_raw", lambda t: t.stock_raw)
_register("csv_prices", "price_list", PRICE_HEADERS, "prices_raw", lambda t: t.prices_raw)
_register("csv_expenses", "expenses", {f"column{i}": f"column{i}" for i in range(5)}, "expenses_raw", lambda t: t.expenses_raw)


@register(
    "csv_skip", " ".join(f"column{i}:s" for i in range(5)),
    sql(f"SELECT {', '.join(f"NULLIF(column{i}, '') AS column{i}" for i in range(5))} FROM expenses_raw"))
def _skip(t):
    """Expense lines in three files or more, one per million lines, each under two title lines that are skipped again."""
    folder, source, columns = new_path(t.spark, "files"), catalog.SOURCES["expenses"], [f"column{i}" for i in range(5)]
    files = max(3, math.ceil(t.rows / FILE_ROWS))
    lines = t.expenses_raw.select(*columns, F.lit(2).alias("place"), F.pmod(F.xxhash64(*columns), F.lit(files)).cast("int").alias("file"))
    titles = t.spark.createDataFrame([(*["title", "2024", None, None, None], 0), (*["a", "b", "c", "d", "e"], 1)], ", ".join([*[f"{c} string" for c in columns], "place int"]))
    lines = lines.unionByName(titles.crossJoin(t.spark.range(files).select(F.col("id").cast("int").alias("file"))))
    lines.repartitionById(files, "file").sortWithinPartitions("file", "place").drop("place").write.partitionBy("file").csv(
        f"{folder}/{source.file}", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return catalog.skip_rows(catalog.read_source(t.spark, "expenses", folder), 2).select(*columns)


@register("sink_append", "o_orderkey:i o_custkey:i", "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders")
def _append(t):
    path, rows = new_path(t.spark, "append"), t.given("orders").select("o_orderkey", "o_custkey")
    sinks.write_table(rows, path)
    sinks.append_table(rows, path)
    return t.spark.read.parquet(path)


@register("sink_json", "c_custkey:i c_name:s c_mktsegment:s", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _json(t):
    path, rows = new_path(t.spark, "json"), t.given("customer").select("c_custkey", "c_name", "c_mktsegment")
    sinks.write_json(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@register("sink_view", "p_brand:s parts:i", "SELECT p_brand, COUNT(*) AS parts FROM part GROUP BY 1")
def _view(t):
    sinks.write_view(t.given("part"), "sink_parts")
    return t.spark.sql("SELECT p_brand, COUNT(*) AS parts FROM sink_parts GROUP BY 1")


@register(
    "sink_failures", "check_name:s o_orderkey:i",
    """SELECT 'no_line' AS check_name, o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
       UNION ALL SELECT 'open' AS check_name, o_orderkey FROM orders WHERE o_orderstatus = 'P'""",
)
def _failures(t):
    folder, orders = new_path(t.spark, "failures"), t.given("orders")
    sinks.write_failures({
        "no_line": orders.join(t.given("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"),
        "open": orders.filter("o_orderstatus = 'P'"),
    }, folder)
    parts = [t.spark.read.parquet(f"{folder}/{n}").select(F.lit(n).alias("check_name"), "o_orderkey") for n in ("no_line", "open")]
    return parts[0].unionByName(parts[1])


@register(
    "raw_audit", "table_name:s key:s ingested_at:s ingestion_run_id:s",
    sql("""SELECT *, '2001-08-01 00:00:00' AS ingested_at, 'run-7' AS ingestion_run_id FROM (
             SELECT 'orders' AS table_name, order_id AS key FROM market_raw WHERE order_id IS NOT NULL
             UNION ALL SELECT 'international', sku FROM international_raw WHERE sku IS NOT NULL
             UNION ALL SELECT 'stock', sku_code FROM stock_raw WHERE sku_code IS NOT NULL
             UNION ALL SELECT 'prices', sku FROM prices_raw WHERE sku IS NOT NULL) AS u"""),
)
def _audit(t):
    loads = {
        "orders": (raw.marketplace_orders(t.market_raw, PARAMS), "order_id"), "international": (t.international, "sku"),
        "stock": (raw.stock_levels(t.stock_raw), "sku_code"), "prices": (t.catalog, "sku"),
    }
    parts = [
        raw.with_audit(df, NOW, "run-7").select(
            F.lit(n).alias("table_name"), F.col(key).alias("key"), F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
            "ingestion_run_id")
        for n, (df, key) in loads.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
