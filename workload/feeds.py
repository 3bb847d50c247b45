"""Raw order, customer and product feeds derived from the given tables, over all their rows."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators.skew import hot_keys, lookup_join, merge_hot

# Days after shipping at which an order line changes its product.
PRODUCT_LAG_DAYS = 45


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _hot(spark: SparkSession, sf_dir: str, name: str, expression: str) -> dict:
    """Hot values of one expression over a stored table; found once per session."""
    return hot_keys(table(spark, sf_dir, name).select(F.expr(expression).alias("key")), "key")


def hot_orders(spark: SparkSession, sf_dir: str) -> dict:
    return _hot(spark, sf_dir, "lineitem", "concat('ORD-', l_orderkey, '-', l_linenumber)")


def hot_products(spark: SparkSession, sf_dir: str) -> dict:
    return _hot(spark, sf_dir, "lineitem", "concat('PROD-', l_partkey)")


def hot_customers(spark: SparkSession, sf_dir: str) -> dict:
    return _hot(spark, sf_dir, "orders", "concat('CUST-', o_custkey)")


@cache
def hot_buyers(spark: SparkSession, sf_dir: str) -> dict:
    """Customers hot among order lines, the side that facts join by."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    joined = lines.join(orders, "l_orderkey", "left")
    return hot_keys(joined.select(F.concat(F.lit("CUST-"), "o_custkey").alias("key")), "key")


def hot_dimensions(spark: SparkSession, sf_dir: str) -> dict:
    return {
        "customer_id": hot_buyers(spark, sf_dir),
        "product_id": hot_products(spark, sf_dir),
    }


def hot_pit(spark: SparkSession, sf_dir: str) -> dict:
    """Facts and versions of a key meet in one place, so their rows add up."""
    lines, products = hot_buyers(spark, sf_dir), hot_products(spark, sf_dir)
    return {
        "customer_id": merge_hot(lines, hot_customers(spark, sf_dir)),
        "product_id": merge_hot(products, products),
    }


def _padded(*names: str) -> Column:
    return F.concat_ws("-", *[F.lpad(F.col(n).cast("long").cast("string"), 12, "0") for n in names])


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    named = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    return named.withColumnRenamed("c_custkey", "o_custkey")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's row."""
    hot = _hot(spark, sf_dir, "orders", "o_custkey")
    return lookup_join(table(spark, sf_dir, "orders"), _customers(spark, sf_dir), "o_custkey", hot)


def _lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Order lines with their part's row."""
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    hot = _hot(spark, sf_dir, "lineitem", "l_partkey")
    return lookup_join(lines, part, "l_partkey", hot)


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, all text as in a CSV drop."""
    orders = _orders(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey")
    hot = _hot(spark, sf_dir, "lineitem", "l_orderkey")
    lines = _lines(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    lines = lookup_join(lines, orders, "l_orderkey", hot)
    price = F.col("p_retailprice") / 10
    status = (
        F.when(F.col("l_returnflag") == "N", " Completed ")
        .when(F.col("l_returnflag") == "A", "SHIPPED")
        .otherwise("returned")
    )
    ordered = F.col("o_orderdate").cast("timestamp")
    return lines.select(
        F.concat(F.lit("ORD-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("order_id"),
        F.concat(F.lit("CUST-"), "o_custkey").alias("customer_id"),
        F.concat(F.lit("PROD-"), "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.when(F.col("l_discount") < 0.05, price).otherwise(price - 5).cast("string").alias("unit_price"),
        status.alias("order_status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("order_date"),
        F.concat(F.lit(" "), "o_orderpriority").alias("payment_method"),
        F.col("n_name").alias("shipping_city"),
        ordered.alias("_ingest_ts"),
        ordered.alias("_file_mod_time"),
        _padded("l_partkey", "l_suppkey", "l_quantity").alias("_source_file"),
    )


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer change per order; the change time is the ingest time."""
    ordered = F.col("o_orderdate").cast("timestamp")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("o_custkey") % 730).cast("int"))
    tier = F.when(F.col("o_orderkey") % 2 == 1, F.col("c_mktsegment")).otherwise(F.col("o_orderpriority"))
    return _orders(spark, sf_dir).select(
        F.concat(F.lit("CUST-"), "o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.col("c_name"), F.lit("@Example.com ")).alias("email"),
        signup.cast("string").alias("signup_date"),
        tier.alias("tier"),
        F.concat(F.lit(" "), "n_name").alias("city"),
        (F.col("c_acctbal") >= 0).cast("string").alias("is_active"),
        ordered.alias("_ingest_ts"),
        ordered.alias("_file_mod_time"),
        _padded("o_orderkey").alias("_source_file"),
    )


def dirty_order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order feed with the faults that casts and rules are for; small quantities carry them."""
    quantity = F.col("quantity")
    date, price = F.col("order_date"), F.col("unit_price")
    return order_feed(spark, sf_dir).withColumns(
        {
            "quantity": F.when(quantity == "1", "0").when(quantity == "2", "two").when(quantity != "3", quantity),
            "order_date": F.when(quantity == "4", "2024-13-45").when(quantity != "5", date),
            "unit_price": F.when(quantity == "6", "-1.5").when(quantity == "8", "n/a").otherwise(price),
            "order_id": F.when(quantity != "7", F.col("order_id")),
        }
    )


def dirty_customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer feed with unusable addresses and sign-up dates; the tier tells where."""
    tier, email, signup = F.col("tier"), F.col("email"), F.col("signup_date")
    return customer_feed(spark, sf_dir).withColumns(
        {
            "email": F.when(tier == "1-URGENT", F.replace(email, F.lit("@"), F.lit("."))).when(tier != "BUILDING", email),
            "signup_date": F.when(tier == "2-HIGH", "unknown").when(tier != "3-MEDIUM", signup),
        }
    )


def product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product change per order line, some time after shipping; returns delete the product."""
    price = F.col("p_retailprice") / 10
    changed = F.date_add("l_shipdate", PRODUCT_LAG_DAYS).cast("timestamp")
    operation = (
        F.when(F.col("l_returnflag") == "R", " delete")
        .when(F.col("l_returnflag") == "A", "Update")
        .otherwise("INSERT")
    )
    return _lines(spark, sf_dir, table(spark, sf_dir, "lineitem")).select(
        operation.alias("operation"),
        F.date_format(changed, "yyyy-MM-dd HH:mm:ss").alias("cdc_timestamp"),
        F.concat(F.lit("PROD-"), "l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("l_tax") < 0.04, price).otherwise(price + 5).cast("string").alias("unit_price"),
        (F.col("l_quantity").cast("int") - 5).cast("string").alias("stock_quantity"),
        (F.col("l_returnflag") != "R").cast("string").alias("is_active"),
        changed.alias("_ingest_ts"),
        changed.alias("_file_mod_time"),
        _padded("l_orderkey", "l_linenumber", "l_suppkey").alias("_source_file"),
    )


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as change rows: the event type is the state of the user."""
    happened = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("USER-"), "user_id").alias("user_id"),
        "event_id",
        "event_type",
        "value",
        happened.alias("_event_ts"),
        happened.alias("_ingest_ts"),
        happened.alias("_file_mod_time"),
        _padded("event_id").alias("_source_file"),
    )
