"""Cleaned, typed and keyed rows from raw text. Works on batch and streaming input alike."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.cleaning import (
    as_date,
    as_timestamp,
    as_type,
    lower_text,
    title_text,
    upper_text,
    version_key,
)
from shopledger.session import moment

# The column contracts.
AUDIT_COLUMNS = [
    "_event_ts", "_ingest_ts", "_updated_at", "_inserted_at", "_file_mod_time", "_source_file",
]
ORDER_COLUMNS = [
    "order_sk", "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
    "order_status", "order_date", "order_year", "order_month", "payment_method", "shipping_city",
    *AUDIT_COLUMNS,
]
CUSTOMER_COLUMNS = [
    "customer_sk", "customer_id", "customer_name", "email", "signup_date", "tier", "city",
    "is_active", *AUDIT_COLUMNS,
]
PRODUCT_COLUMNS = [
    "product_sk", "product_id", "product_name", "category", "brand", "unit_price",
    "stock_quantity", "is_active", "operation", "cdc_timestamp", *AUDIT_COLUMNS,
]


def _finish(
    typed: DataFrame,
    event_ts: Column,
    key: str,
    sk: str,
    columns: Sequence[str],
    now: datetime | str | None,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    audited = typed.withColumns(
        {
            **(derived or {}),
            "_event_ts": event_ts,
            "_updated_at": F.col("_ingest_ts"),
            "_inserted_at": moment(now),
        }
    )
    keyed = audited.withColumn(sk, version_key(key))
    return keyed.select(*columns)


def stage_orders(raw: DataFrame, now: datetime | str | None = None) -> DataFrame:
    typed = raw.withColumns(
        {
            "order_date": as_date("order_date"),
            "order_status": lower_text("order_status"),
            "payment_method": lower_text("payment_method"),
            "shipping_city": title_text("shipping_city"),
            "quantity": as_type("quantity", "int"),
            "unit_price": as_type("unit_price", "double"),
        }
    )
    derived = {
        "total_amount": F.col("quantity") * F.col("unit_price"),
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
    }
    event_ts = F.col("order_date").cast("timestamp")
    return _finish(typed, event_ts, "order_id", "order_sk", ORDER_COLUMNS, now, derived)


def stage_customers(
    raw: DataFrame, now: datetime | str | None = None, event_ts: Column | None = None
) -> DataFrame:
    """The event time is the sign-up date, or the ingest time without one.

    Feeds that carry their own change time pass it as ``event_ts``.
    """
    typed = raw.withColumns(
        {
            "customer_name": title_text("customer_name"),
            "email": lower_text("email"),
            "signup_date": as_date("signup_date"),
            "tier": upper_text("tier"),
            "city": title_text("city"),
            "is_active": as_type("is_active", "boolean"),
        }
    )
    if event_ts is None:
        event_ts = F.coalesce(F.col("signup_date").cast("timestamp"), "_ingest_ts")
    return _finish(typed, event_ts, "customer_id", "customer_sk", CUSTOMER_COLUMNS, now)


def stage_products(raw: DataFrame, now: datetime | str | None = None) -> DataFrame:
    typed = raw.withColumns(
        {
            "operation": upper_text("operation"),
            "product_name": title_text("product_name"),
            "category": title_text("category"),
            "brand": upper_text("brand"),
            "unit_price": as_type("unit_price", "double"),
            "stock_quantity": as_type("stock_quantity", "int"),
            "is_active": as_type("is_active", "boolean"),
            "cdc_timestamp": as_timestamp("cdc_timestamp"),
        }
    )
    event_ts = F.col("cdc_timestamp")
    return _finish(typed, event_ts, "product_id", "product_sk", PRODUCT_COLUMNS, now)
