"""Facts built from current versions and from versions valid at order time."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions import business as rule
from shopledger.functions.cleaning import key_from_parts, key_parts, version_key
from shopledger.operators.asof import Changes, asof_join
from shopledger.operators.history import SEQUENCE
from shopledger.operators.skew import Hot, lookup_join
from shopledger.session import COMPRESSION, freeing, moment

# The column contracts.
ORDER_CUSTOMER_COLUMNS = [
    "order_sk", "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
    "order_status", "order_date", "order_year", "order_month", "payment_method", "shipping_city",
    "customer_sk", "customer_name", "email", "signup_date", "tier", "customer_city",
    "customer_is_active", "order_amount_band", "customer_tenure_days", "is_high_value_order",
    "_mv_refreshed_at",
]
ORDER_CUSTOMER_PRODUCT_COLUMNS = [
    "order_sk", "customer_sk", "product_sk", "order_id", "customer_id", "product_id", "order_date",
    "order_status", "quantity", "order_unit_price", "line_amount", "customer_name", "tier",
    "customer_city", "product_name", "category", "brand", "product_unit_price", "stock_quantity",
    "product_stock_status", "is_price_mismatch", "_mv_refreshed_at",
]
PIT_COLUMNS = [
    "order_sk", "order_id", "order_date", "order_event_ts", "customer_id", "product_id",
    "order_status", "payment_method", "shipping_city", "quantity", "order_unit_price",
    "line_amount", "customer_sk", "customer_name", "tier", "customer_city", "signup_date",
    "product_sk", "product_name", "category", "brand", "catalog_unit_price", "stock_quantity",
    "catalog_price_delta", "price_match_flag", "tenure_bucket", "stock_risk_flag", "_gold_load_ts",
]

# Dimension columns that facts take over, and their names there.
CUSTOMER_ATTRIBUTES = {
    "customer_sk": "customer_sk",
    "customer_name": "customer_name",
    "email": "email",
    "signup_date": "signup_date",
    "tier": "tier",
    "city": "customer_city",
    "is_active": "customer_is_active",
}
PRODUCT_ATTRIBUTES = {
    "product_sk": "product_sk",
    "product_name": "product_name",
    "category": "category",
    "brand": "brand",
    "unit_price": "product_unit_price",
    "stock_quantity": "stock_quantity",
}
PIT_CUSTOMER_ATTRIBUTES = {
    "customer_sk": "customer_sk",
    "customer_name": "customer_name",
    "tier": "tier",
    "city": "customer_city",
    "signup_date": "signup_date",
}
PIT_PRODUCT_ATTRIBUTES = {**PRODUCT_ATTRIBUTES, "unit_price": "catalog_unit_price"}

Hots = Mapping[str, Mapping[Any, int]]


def _dimension(rows: DataFrame, key: str, attributes: Mapping[str, str]) -> DataFrame:
    return rows.select(key, *[F.col(c).alias(name) for c, name in attributes.items()])


def _with_keys(joined: DataFrame, staged: Mapping[str, str]) -> DataFrame:
    """Surrogate keys in place of their parts, or of nothing for the fact's own: see ``staged_keys``."""
    return joined.withColumns(
        {
            sk: key_from_parts(key, sk) if sk in joined.columns else version_key(key)
            for sk, key in staged.items()
        }
    )


def order_customer_fact(
    orders: DataFrame,
    customers: DataFrame,
    now: datetime | str | None = None,
    hot: Hots | None = None,
    staged_keys: bool = False,
) -> DataFrame:
    """Current orders with their current customers. ``hot`` holds hot keys per key column.

    With ``staged_keys`` the inputs' surrogate keys are those of the stages, under this session's
    time zone. They then follow from key, event and ingest time and are made after the joins:
    hash text is the widest column of a row and does not compress.
    """
    customer = _dimension(customers, "customer_id", CUSTOMER_ATTRIBUTES)
    if staged_keys:
        orders = orders.drop("order_sk")
    joined = lookup_join(orders, customer, "customer_id", (hot or {}).get("customer_id"))
    if staged_keys:
        joined = _with_keys(joined, {"order_sk": "order_id"})
    amount = F.col("total_amount")
    return joined.withColumns(
        {
            "order_amount_band": rule.amount_band(amount),
            "customer_tenure_days": rule.tenure_days(F.col("order_date"), F.col("signup_date")),
            "is_high_value_order": rule.is_high_value(amount),
            "_mv_refreshed_at": moment(now),
        }
    ).select(*ORDER_CUSTOMER_COLUMNS)


def order_customer_product_fact(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    now: datetime | str | None = None,
    hot: Hots | None = None,
    staged_keys: bool = False,
) -> DataFrame:
    """Current orders with their current customers and products; see ``order_customer_fact``."""
    hot = hot or {}
    if staged_keys:
        orders = orders.drop("order_sk")
        customers = customers.withColumn("customer_sk", key_parts())
    customer = _dimension(customers, "customer_id", CUSTOMER_ATTRIBUTES)
    product = _dimension(products, "product_id", PRODUCT_ATTRIBUTES)
    lines = orders.withColumnRenamed("unit_price", "order_unit_price")
    joined = lookup_join(lines, customer, "customer_id", hot.get("customer_id"))
    joined = lookup_join(joined, product, "product_id", hot.get("product_id"))
    if staged_keys:
        joined = _with_keys(joined, {"order_sk": "order_id", "customer_sk": "customer_id"})
    price, catalog_price = F.col("order_unit_price"), F.col("product_unit_price")
    return joined.withColumns(
        {
            "line_amount": F.col("quantity") * price,
            "product_stock_status": rule.stock_status(F.col("stock_quantity")),
            "is_price_mismatch": rule.is_price_mismatch(price, catalog_price),
            "_mv_refreshed_at": moment(now),
        }
    ).select(*ORDER_CUSTOMER_PRODUCT_COLUMNS)


def revenue_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(rule.earns_revenue(F.col("order_status")))


def pit_fact(
    orders: DataFrame,
    customer_versions: DataFrame | Changes,
    product_versions: DataFrame | Changes,
    now: datetime | str | None = None,
    hot: Hots | None = None,
    event_time_only: bool = False,
    staged_keys: bool = False,
) -> DataFrame:
    """Completed and shipped current orders with the versions valid at order time.

    Positions in time are compared by the whole sequence, or by event time alone. Where no version
    table is stored, the changes themselves will do. For ``staged_keys`` see ``order_customer_fact``;
    here both versions are tables, not changes.
    """
    hot = hot or {}
    at = SEQUENCE[:1] if event_time_only else SEQUENCE
    lines = revenue_orders(orders).select(
        "order_sk",
        "order_id",
        "order_date",
        F.col("_event_ts").alias("order_event_ts"),
        "customer_id",
        "product_id",
        "order_status",
        "payment_method",
        "shipping_city",
        "quantity",
        F.col("unit_price").alias("order_unit_price"),
        *SEQUENCE,
    )
    if staged_keys:
        lines = lines.drop("order_sk")
        customer_versions = customer_versions.withColumn("customer_sk", key_parts())
    dated = asof_join(
        lines, customer_versions, "customer_id", PIT_CUSTOMER_ATTRIBUTES, at, hot.get("customer_id")
    )
    dated = asof_join(
        dated, product_versions, "product_id", PIT_PRODUCT_ATTRIBUTES, at, hot.get("product_id")
    )
    if staged_keys:
        dated = _with_keys(dated, {"order_sk": "order_id", "customer_sk": "customer_id"})
    price, catalog_price = F.col("order_unit_price"), F.col("catalog_unit_price")
    days = rule.tenure_days(F.col("order_date"), F.col("signup_date"))
    return dated.withColumns(
        {
            "line_amount": F.col("quantity") * price,
            "catalog_price_delta": price - catalog_price,
            "price_match_flag": rule.price_match(price, catalog_price),
            "tenure_bucket": rule.tenure_bucket(days),
            "stock_risk_flag": rule.stock_risk(F.col("stock_quantity")),
            "_gold_load_ts": moment(now),
        }
    ).select(*PIT_COLUMNS)


def append_facts(fresh: DataFrame, table: str, run: str) -> None:
    """Appends rows under the id of a run; repeating the run replaces what it wrote before."""
    with freeing(fresh.sparkSession):
        writer = fresh.write.mode("overwrite").option("compression", COMPRESSION)
        writer.parquet(f"{table}/run={run}")


def new_facts(fact: DataFrame, existing: DataFrame) -> DataFrame:
    """Fact rows whose order version is not in ``existing`` yet, for append-only fact tables."""
    return fact.join(existing.select("order_sk"), "order_sk", "left_anti")
