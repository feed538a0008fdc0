"""Declared external files: name, file, columns (all text at the boundary) and docs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .staging import stage


@dataclass(frozen=True)
class Source:
    name: str
    file: str
    doc: str
    columns: dict  # column name -> description
    header: bool = True

    @property
    def schema(self) -> StructType:
        # explicit text columns: no inference pass over the data, and bad values become
        # NULL in the cleaning step instead of changing a column's type
        return StructType([StructField(c, StringType(), True, {"comment": d}) for c, d in self.columns.items()])


# fixed values: file names and header texts of the published reports
SOURCES = {
    s.name: s
    for s in (
        Source("marketplace_orders", "Amazon Sale Report.csv", "Marketplace order lines", {
            "Order ID": "order number", "Date": "order date", "Status": "order status",
            "Fulfilment": "who ships", "Sales Channel": "shop", "ship-service-level": "shipping speed",
            "Style": "style code", "SKU": "stock keeping unit", "Category": "product category",
            "Size": "product size", "ASIN": "marketplace item number", "Courier Status": "courier state",
            "Qty": "units", "currency": "currency code", "Amount": "line amount", "ship-city": "city",
            "ship-state": "state", "ship-postal-code": "postal code", "ship-country": "country",
            "promotion-ids": "promotions applied", "B2B": "business buyer flag", "fulfilled-by": "carrier programme",
        }),
        Source("international_sales", "International sale Report.csv", "International sales lines", {
            "DATE": "order date", "Months": "month label", "CUSTOMER": "buyer name", "Style": "style code",
            "SKU": "stock keeping unit", "Size": "product size", "PCS": "units", "RATE": "price per unit",
            "GROSS AMT": "line amount",
        }),
        Source("stock_report", "Sale Report.csv", "Stock by SKU", {
            "SKU Code": "stock keeping unit", "Design No.": "design number", "Stock": "units on hand",
            "Category": "product category", "Size": "product size", "Color": "product colour",
        }),
        Source("price_list", "P  L March 2021.csv", "Costs and marketplace prices by SKU", {
            "Sku": "stock keeping unit", "Style Id": "style", "Catalog": "catalog name",
            "Category": "product category", "Weight": "weight in kg", "TP 1": "trade price 1",
            "TP 2": "trade price 2", "MRP Old": "former list price", "Final MRP Old": "former final price",
            "Ajio MRP": "price", "Amazon MRP": "price", "Amazon FBA MRP": "price", "Flipkart MRP": "price",
            "Limeroad MRP": "price", "Myntra MRP": "price", "Paytm MRP": "price", "Snapdeal MRP": "price",
        }),
        Source("expenses", "Expense IIGF.csv", "Expense lines without header", {
            "column0": "unused", "column1": "expense date, month-day-year", "column2": "stock keeping unit",
            "column3": "description", "column4": "amount",
        }, header=False),
    )
}


def read_source(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Declared columns of a file, all text.

    Columns of a file with a header are found by their header text, wherever they stand; further columns
    are ignored and a missing one is an error.  Several files of one source must have the same header.
    """
    s = SOURCES[name]
    path, how = f"{folder}/{s.file}", {"quote": '"', "escape": '"'}
    if not s.header:
        return spark.read.csv(path, schema=s.schema, **how)
    # reads the first line only: without inference every column is text
    found = spark.read.csv(path, header=True, enforceSchema=False, **how)
    missing = [c for c in s.columns if c not in found.columns]
    if missing:
        raise ValueError(f"{s.file} has no column {missing}")
    return found.select(*[F.col(f"`{c}`").alias(c, metadata={"comment": d}) for c, d in s.columns.items()])


def skip_rows(df: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` rows of every file (title or header lines) of a frame read straight from files.

    A row's place in its file is its place in its split after the rows of the file's earlier splits.  Generated ids follow the
    rows within a split, so a first pass keeps the first id and the number of rows of each split; only splits that hold
    one of the first ``n`` rows, usually one per file, meet the rows again.
    """
    split = ["__file", "__start"]
    placed = df.withColumns({
        "__file": F.col("_metadata.file_path"), "__start": F.col("_metadata.file_block_start"), "__id": F.monotonically_increasing_id()})
    sizes = placed.groupBy(*split).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    heads = stage(sizes.filter(F.col("__before") < n).drop("__rows"), "heads")
    rows = placed.join(heads, split, "left")
    place = F.col("__id") - F.col("__first") + F.col("__before")
    return rows.filter(F.col("__first").isNull() | (place >= n)).select(*[F.col(f"`{c}`") for c in df.columns])


def describe_sources() -> list[tuple[str, str, str]]:
    """(source, column, description) rows of the registry."""
    return [(s.name, c, d) for s in SOURCES.values() for c, d in s.columns.items()]
