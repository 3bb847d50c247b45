import os

import pytest
from pyspark.sql import functions as F

from shopledger.plans import marts
from shopledger.plans.pipeline import Pipeline
from shopledger.sources.tables import read_table, replace_table

NOW = "2025-01-01 00:00:00"
ORDERS = "country,customer_id,order_date,order_id,order_status,payment_method,product_id,quantity,shipping_city,unit_price"
CUSTOMERS = "city,customer_id,customer_name,email,is_active,signup_date,tier"
PRODUCTS = "brand,category,cdc_timestamp,is_active,operation,product_id,product_name,stock_quantity,unit_price"


def drop(landing, folder, name, header, *lines):
    os.makedirs(f"{landing}/{folder}", exist_ok=True)
    with open(f"{landing}/{folder}/{name}", "w") as file:
        file.write("\n".join([header, *lines]) + "\n")


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, str(tmp_path / "landing"), str(tmp_path / "base"), buckets=4, now=NOW)


def first_drops(landing):
    drop(
        landing, "orders", "o1.csv", ORDERS,
        "DE,CUST-1,2024-08-01,ORD-1,completed,upi,PROD-1,2,Pune,600.0",
        "DE,CUST-2,2024-05-01,ORD-2,shipped,cod,PROD-1,1,Pune,100.0",
        "DE,CUST-1,2024-08-01,ORD-3,completed,upi,PROD-2,0,Pune,10.0",
    )
    drop(
        landing, "customers", "c1.csv", CUSTOMERS,
        "Pune,CUST-1,Ann,ann@example.com,true,2023-01-01,gold",
        "Delhi,CUST-2,Bo,bo@example.com,false,2024-04-20,silver",
    )
    drop(
        landing, "products", "p1.csv", PRODUCTS,
        "A,Toys,2024-07-01 10:00:00,true,INSERT,PROD-1,Robot,50,600.0",
        "B,Books,2024-07-01 10:00:00,true,INSERT,PROD-2,Novel,5,10.0",
    )


def test_two_runs_with_late_and_changed_rows(spark, pipeline):
    first_drops(pipeline.landing)
    pipeline.run()
    pit = {r.order_id: r for r in pipeline.read("gold.gold_order_customer_product_pit_fact").collect()}
    assert set(pit) == {"ORD-1", "ORD-2"}  # the order without quantity was dropped
    assert (pit["ORD-1"].catalog_unit_price, pit["ORD-2"].product_sk) == (600.0, None)
    assert pipeline.quality["orders"] == {
        "rows": 3, "valid_order_id": 0, "valid_date": 0, "positive_quantity": 1, "positive_price": 0,
    }
    assert pipeline.quality["customers"] == {"rows": 2, "valid_email": 0, "customer_id_not_null": 0}
    assert pipeline.quality["gold.gold_order_customer_product_pit_fact"] == {
        "rows": 2, "has_order_id": 0, "has_customer_dim": 0, "has_product_dim": 1,
    }
    assert pipeline.quality["gold.gold_daily_revenue"]["rows"] == 2

    drop(
        pipeline.landing, "products", "p2.csv", PRODUCTS,
        "A,Toys,2024-02-01 00:00:00,true,INSERT,PROD-1,Robot,1,100.0",  # arrives late
        "A,Toys,2024-09-01 00:00:00,false,DELETE,PROD-1,Robot,0,600.0",
    )
    drop(
        pipeline.landing, "orders", "o2.csv", ORDERS,
        "DE,CUST-1,2024-08-03,ORD-1,returned,upi,PROD-1,2,Pune,600.0",
    )
    pipeline.run()
    pipeline.run()  # nothing new: nothing changes

    versions = pipeline.versions("silver_products").filter("product_id = 'PROD-1'")
    spans = versions.select("unit_price", "__START_AT._event_ts", "__END_AT._event_ts")
    got = sorted((r[0], str(r[1]), str(r[2])) for r in spans.collect())
    assert got == [
        (100.0, "2024-02-01 00:00:00", "2024-07-01 10:00:00"),
        (600.0, "2024-07-01 10:00:00", "2024-09-01 00:00:00"),
    ]
    pit = pipeline.read("gold.gold_order_customer_product_pit_fact").collect()
    assert [(r.order_id, r.catalog_unit_price, r.stock_risk_flag) for r in pit] == [
        ("ORD-2", 100.0, "LOW")
    ]
    wide = {r.order_id: r for r in pipeline.read("silver.silver_order_customer_product_fact").collect()}
    assert wide["ORD-1"].order_status == "returned" and wide["ORD-1"].product_sk is None
    daily = pipeline.read("gold.gold_daily_revenue").collect()
    assert [(r.daily_revenue, r.order_count) for r in daily] == [(100.0, 1)]
    segments = {r.customer_id: r.customer_segment for r in pipeline.read("gold.gold_customer_360").collect()}
    assert segments == {"CUST-1": "no_purchases", "CUST-2": "no_purchases"}
    top = pipeline.read("gold.gold_top_products").first()
    assert (top.product_id, top.revenue_rank, top.product_name) == ("PROD-1", 1, None)
    assert pipeline.read("gold.gold_executive_kpis").first().orders_count == 1


def test_a_failing_source_does_not_stop_the_others(spark, pipeline):
    first_drops(pipeline.landing)
    drop(pipeline.landing, "customers", "c2.csv", CUSTOMERS, "Pune,,Nobody,x@example.com,true,2024-01-01,gold")
    pipeline.ingest()
    with pytest.raises(RuntimeError, match="failed sources: customers"):
        pipeline.refine()
    assert pipeline.versions("silver_orders").count() == 2
    assert pipeline.versions("silver_products").count() == 2


def test_new_columns_and_history_in_the_pipeline(spark, tmp_path):
    old = f"{tmp_path}/old_orders"
    spark.createDataFrame(
        [("CUST-1", "2023-08-01", "ORD-0", "completed", "PROD-1", 4, 600.0)],
        "customer_id string, order_date string, order_id string, order_status string,"
        " product_id string, quantity int, unit_price double",
    ).write.parquet(old)
    base, landing = str(tmp_path / "base"), str(tmp_path / "landing")
    pipeline = Pipeline(spark, landing, base, buckets=4, now=NOW, history={"orders": old})
    first_drops(landing)
    pipeline.run()
    drop(landing, "orders", "o2.csv", "colour," + ORDERS, "red,DE,CUST-1,2024-08-05,ORD-9,completed,upi,PROD-1,1,Pune,5.0")
    drop(landing, "customers", "c2.csv", CUSTOMERS + ",age", "Pune,CUST-3,Cy,cy@example.com,true,2023-01-01,gold,41")
    pipeline.run()
    assert {r.order_id for r in pipeline.versions("silver_orders").collect()} == {"ORD-0", "ORD-1", "ORD-2", "ORD-9"}
    pipeline.register()
    colours = spark.table("bronze.bronze_order").select("order_id", "colour", "quantity").collect()
    assert sorted((r[0], r[1], r[2]) for r in colours) == [
        ("ORD-0", None, "4"), ("ORD-1", None, "2"), ("ORD-2", None, "1"), ("ORD-3", None, "0"), ("ORD-9", "red", "1"),
    ]
    ages = spark.table("bronze.bronze_customer")
    assert dict(ages.dtypes)["age"] == "int" and ages.agg(F.max("age")).first()[0] == 41
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {layer} CASCADE")


def test_daily_revenue_from_changes(spark, tmp_path):
    """Corrections, returns and late rows, with upkeep in between, give what a recomputation gives."""
    pipeline = Pipeline(spark, str(tmp_path / "landing"), str(tmp_path / "base"), 2, NOW, from_changes=True)
    first_drops(pipeline.landing)
    pipeline.run()
    pipeline.maintain()
    drop(
        pipeline.landing, "orders", "o2.csv", ORDERS,
        "DE,CUST-1,2024-08-01,ORD-1,completed,upi,PROD-1,3,Pune,600.0",  # corrected
        "DE,CUST-2,2024-05-02,ORD-2,returned,cod,PROD-1,1,Pune,100.0",
        "DE,CUST-2,2024-05-01,ORD-7,shipped,cod,PROD-1,2,Pune,50.5",
        "DE,CUST-2,2024-04-01,ORD-7,shipped,cod,PROD-1,9,Pune,50.5",  # an older state of it
    )
    pipeline.run()
    pipeline.run()
    columns = ["order_date", "shipping_city", "payment_method", "daily_revenue", "order_count", "total_items_sold"]
    got = pipeline.read("gold.gold_daily_revenue").select(*columns)
    full = marts.daily_revenue(pipeline.read("silver.silver_order_customer_fact")).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    assert sorted(r.daily_revenue for r in got.collect()) == [101.0, 1800.0]


def test_failed_publish_keeps_the_old_mart(spark, tmp_path):
    path = f"{tmp_path}/mart"
    assert replace_table(spark.range(3), path).count() == 3
    broken = spark.range(5).select((F.col("id") + F.raise_error(F.lit("no")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, path)
    assert read_table(spark, path).count() == 3
    assert replace_table(spark.range(7), path).count() == 7


def test_catalog_entries(spark, pipeline):
    first_drops(pipeline.landing)
    gone = "A,Toys,2024-09-01 00:00:00,false,DELETE,PROD-2,Novel,0,10.0"
    drop(pipeline.landing, "products", "p2.csv", PRODUCTS, gone)
    pipeline.run()
    pipeline.register({"team": "it's us"})
    products = spark.table("silver.silver_products")
    assert [r.product_id for r in products.filter("__END_AT IS NULL").collect()] == ["PROD-1"]
    assert not {"_deleted", "_bucket", "_open"} & set(products.columns)
    assert spark.table("gold.gold_daily_revenue").count() == 2
    assert spark.table("bronze.bronze_order").count() == 3
    assert spark.table("silver.silver_orders").count() == 2
    shown = spark.sql("SHOW TBLPROPERTIES gold.gold_daily_revenue").collect()
    properties = {r.key: r.value for r in shown}
    assert (properties["layer"], properties["team"]) == ("gold", "it's us")
    described = spark.sql("DESCRIBE TABLE EXTENDED gold.gold_customer_360")
    comment = described.filter(F.col("col_name") == "Comment").first().data_type
    assert comment == "Customer profile, purchases and value segment"
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {layer} CASCADE")
