from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import raw, staging
from tallyloom.sources import catalog, sinks
from tallyloom.sources.staging import stage

from .conftest import rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")

    def write(name, text):
        (d / catalog.SOURCES[name].file).write_text(text)

    write("marketplace_orders", (
        "Order ID,Date,Status,Fulfilment,Sales Channel,ship-service-level,Style,SKU,Category,Size,ASIN,Courier Status,Qty,"
        "currency,Amount,ship-city,ship-state,ship-postal-code,ship-country,promotion-ids,B2B,fulfilled-by\n"
        "o1,2022-06-05,Shipped - Delivered to Buyer,Amazon,Amazon.in,Expedited,st,SKU1,kurta,M,a1,Shipped,2,INR,1000.00,Mumbai,MH,1,IN,p1,True,Easy\n"
        "o2,2022-11-07,Shipped,Merchant,Amazon.in,Standard,st,SKU2,set,L,a2,Shipped,0,INR,500.00,pune,MH,1,IN,,False,\n"
        "o3,bad,Cancelled,Merchant,Amazon.in,Standard,st,SKU3,set,L,a3,,x,INR,abc,Goa,GA,1,IN,,False,\n"
        "o4,2022-07-02,Shipped,Merchant,Amazon.in,Standard,st,SKU4,set,L,a4,,1,INR,-5,Goa,GA,1,IN,,False,\n"
        "o5,2022-06-05,,Merchant,Amazon.in,Standard,st,SKU5,set,L,a5,,1,INR,5,Goa,GA,1,IN,,False,\n"
        ",2022-06-05,Shipped,Merchant,Amazon.in,Standard,st,SKU6,set,L,a6,,1,INR,5,Goa,GA,1,IN,,False,\n"
    ))
    write("international_sales", (
        "DATE,Months,CUSTOMER,Style,SKU,Size,PCS,RATE,GROSS AMT\n"
        "2022-06-05,Jun-22,MR LOGANATHAN,s,MEN-1,XL,2,300.00,600.00\n"
        "06-05-21,Jun-21,SHOP RETAIL,s,WOMEN-2,7XL,1,10.00,10.00\n"
        ",Jun-21,X,s,KIDS-3,S,1,1.00,n/a\n"
    ))
    write("stock_report", (
        "SKU Code,Design No.,Stock,Category,Size,Color\n"
        "AB_S,D1,0,LEGGINGS,S,Navy\nAB_M,D2,3,KURTA SET,M,Teal\nAB_L,D3,,CROP TOP,L,GOLD\nAB_X,D4,-1,X,XXL,pink\n"
    ))
    head = "Sku,Style Id,Catalog,Category,Weight,TP 1,TP 2,MRP Old,Final MRP Old,Ajio MRP,Amazon MRP,Amazon FBA MRP,Flipkart MRP,Limeroad MRP,Myntra MRP,Paytm MRP,Snapdeal MRP\n"
    write("price_list", head + (
        "Os206_L,s1,c,Kurta,0.3,500,540,2000,2000,2100,2000,2000,2000,2000,2000,2000,2000\n"
        "Os206_XL,s1,c,Set,0.3,500,540,2000,2000,600,600,600,600,600,600,600,600\n"
        "Os207_3XL,,c,Top,x,,540,2000,2000,0,600,600,600,600,600,,600\n"
    ))
    write("expenses", '"dummy","01-01-2024"," SKU001","Test Expense 1",100.50\n"dummy","01-02-24","SKU002","Test Expense 2",200.75\n"t","d","s","x",Amount\n')
    return str(d)


def test_registry_documents_columns():
    docs = catalog.describe_sources()
    assert ("expenses", "column4", "amount") in docs and len(catalog.SOURCES) == 5


def test_marketplace_orders(spark, folder, params):
    df = raw.marketplace_orders(catalog.read_source(spark, "marketplace_orders", folder), params)
    got = {r.order_id: r for r in df.collect()}
    assert set(got) == {"o1", "o2", "o3", "o4", "o5"}  # the row without a key is dropped
    o1, o2, o3 = got["o1"], got["o2"], got["o3"]
    assert (o1.order_status_category, o1.order_value_segment, o1.season, o1.is_weekend) == ("DELIVERED", "MEDIUM_VALUE", "SUMMER", True)
    assert str(o1.unit_price) == "500.00" and o1.has_promotion and o1.is_b2b
    assert (o2.unit_price, o2.order_value_segment, o2.season, o2.has_promotion) == (None, "LOW_VALUE", "WINTER", False)
    assert (o3.order_date, o3.order_amount, o3.quantity, o3.season, o3.is_weekend) == (None, None, None, None, False)
    assert got["o5"].data_quality_flag == "MISSING_STATUS"
    staged = {r.order_id: r for r in staging.staged_orders(df, params).collect()}
    assert set(staged) == {"o1", "o2", "o3", "o4"}
    assert (staged["o1"].order_performance_score, staged["o1"].composite_performance_score) == (100, 91)
    assert staged["o2"].business_validation_status == "INVALID_QUANTITY"
    assert staged["o4"].business_validation_status == "NEGATIVE_AMOUNT"
    assert (staged["o1"].city_tier, staged["o2"].city_tier) == ("TIER_1", "TIER_2")


def test_international(spark, folder):
    src = catalog.read_source(spark, "international_sales", folder)
    got = {r.sku: r for r in raw.international_sales(src).collect()}
    assert (got["MEN-1"].customer_segment, got["MEN-1"].product_category, got["MEN-1"].profitability_flag) == ("PREMIUM_CUSTOMER", "MENS_WEAR", "BREAKEVEN")
    assert (got["WOMEN-2"].order_date, got["WOMEN-2"].standardized_size) == (None, "OTHER")
    assert (got["KIDS-3"].data_quality_flag, got["KIDS-3"].gross_amount) == ("MISSING_DATE", None)
    report = staging.stage_international_report(src)
    assert rows(report, "product_sku", "order_date") == [("men-1", None), ("women-2", date(2021, 6, 5))]


def test_stock_levels(spark, folder):
    got = {r.sku_code: r for r in raw.stock_levels(catalog.read_source(spark, "stock_report", folder)).collect()}
    assert (got["AB_S"].stock_level_category, got["AB_S"].color_family, got["AB_S"].reorder_recommendation) == ("OUT_OF_STOCK", "BLUE_FAMILY", "IMMEDIATE_REORDER")
    assert (got["AB_M"].stock_level_category, got["AB_M"].category_group, got["AB_M"].estimated_stock_value) == ("LOW_STOCK", "ETHNIC_WEAR", 1500)
    assert (got["AB_L"].data_quality_flag, got["AB_L"].stock_level_category) == ("MISSING_STOCK", "OVERSTOCKED")
    assert got["AB_X"].stock_level_category == "LOW_STOCK"


def test_price_catalog(spark, folder):
    got = {r.sku: r for r in raw.price_catalog(catalog.read_source(spark, "price_list", folder)).collect()}
    a, b, c = got["Os206_L"], got["Os206_XL"], got["Os207_3XL"]
    assert (a.size_from_sku, b.size_from_sku, c.size_from_sku) == ("L", "XL", "3XL")  # the underscore is literal
    assert (a.price_variance_category, a.most_competitive_marketplace, a.pricing_recommendation, a.product_tier) == ("LOW_PRICE_VARIANCE", "AMAZON", "REDUCE_PRICE", "PREMIUM")
    assert (b.price_variance_category, b.most_competitive_marketplace, b.pricing_recommendation) == ("UNIFORM_PRICING", "AJIO", "INCREASE_PRICE")
    assert (c.avg_marketplace_price, c.price_variance_category, c.ajio_margin_percent, c.data_quality_flag) == (None, "LOW_PRICE_VARIANCE", None, "MISSING_STYLE_ID")
    assert str(a.ajio_margin_percent).startswith("76.19")


def test_expenses_and_skip(spark, folder):
    src = catalog.read_source(spark, "expenses", folder)
    assert rows(staging.stage_expenses(src), "product_sku", "expense_date") == [("sku001", None), ("sku002", date(2024, 1, 2))]
    assert catalog.skip_rows(src, 2).count() == 1


def test_skip_counts_rows_of_each_file_over_its_splits(spark, tmp_path):
    """Three files of uneven length, cut into many small splits; the first rows reach over several of them."""
    lengths = (400, 3, 57)
    for f, n in enumerate(lengths):
        (tmp_path / f"f{f}.csv").write_text("".join(f"{f},{i}\n" for i in range(n)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "120")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        src = spark.read.schema("f int, i int").csv(str(tmp_path))
        assert src.rdd.getNumPartitions() > 10
        for n in (0, 1, 5, 60, 1000):
            want = sorted(((f, i) for f, size in enumerate(lengths) for i in range(n, size)), key=repr)
            assert rows(catalog.skip_rows(src, n), "f", "i") == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stock_lines_have_no_date_and_drop_out(spark, folder, params):
    orders = staging.staged_orders(raw.marketplace_orders(catalog.read_source(spark, "marketplace_orders", folder), params), params)
    stock = staging.stage_stock_report(catalog.read_source(spark, "stock_report", folder))
    report = staging.stage_international_report(catalog.read_source(spark, "international_sales", folder))
    base = staging.partner_base(staging.channel_lines(orders, stock, report), params)
    assert rows(base, "partner_channel", "order_id", "order_value_tier")[0] == ("amazon", "o1", "high_value")
    assert {r[0] for r in rows(base, "partner_channel")} == {"amazon", "international"}
    assert staging.all_sales(orders, stock).count() == 4 + 4


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, p string")
    new = spark.createDataFrame([(2, "B", "y"), (3, "c", "z")], "id int, v string, p string")
    for batch in (old, new, new):  # the second load of the same rows changes nothing
        sinks.upsert_partitions(spark, path, batch, ["id"], "p", "v")
        now = rows(spark.read.parquet(path), "id", "v", "p")
    assert now == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]
    with pytest.raises(ValueError):
        sinks.upsert_partitions(spark, path, new.withColumn("more", F.lit(1)), ["id"], "p", "v")
    with pytest.raises(ValueError):
        sinks.check_schema(old, new.withColumn("id", F.col("id").cast("bigint")).schema)
    sinks.write_table(old, str(tmp_path / "full"))
    sinks.append_table(new, str(tmp_path / "full"))
    assert spark.read.parquet(str(tmp_path / "full")).count() == 4
    sinks.write_json(old, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.write_failures({"check": old.filter("id = 1")}, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f" / "check")).count() == 1
    sinks.write_view(old, "sinks_view")
    assert spark.table("sinks_view").count() == 2


def test_upsert_keeps_the_last_version(spark, tmp_path):
    path = str(tmp_path / "v")
    batch = spark.createDataFrame([(1, 1, "x"), (1, 3, "x"), (1, 2, "x"), (2, None, "y")], "id int, n int, p string")
    sinks.upsert_partitions(spark, path, batch, ["id"], "p", "n")
    assert rows(spark.read.parquet(path), "id", "n", "p") == [(1, 3, "x"), (2, None, "y")]


def test_headers_decide(spark, tmp_path):
    (tmp_path / "Sale Report.csv").write_text("index,Stock,SKU Code,Design No.,Category,Size,Color\n0,7,A_S,D,K,S,Red\n")
    row = catalog.read_source(spark, "stock_report", str(tmp_path)).first()
    assert (row["SKU Code"], row["Stock"], row["Color"]) == ("A_S", "7", "Red")
    (tmp_path / "Sale Report.csv").write_text("SKU Code,Stock\nA_S,7\n")
    with pytest.raises(ValueError, match="Color"):
        catalog.read_source(spark, "stock_report", str(tmp_path))


def test_stage_reads_session_folder(spark):
    df = stage(spark.range(3), "x")
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0] and df.count() == 3


def test_staged_writes_leave_no_method_too_long_to_compile(spark):
    from tallyloom.sources import staging

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with staging._writing(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name) == before
