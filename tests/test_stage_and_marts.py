from datetime import date, datetime

import pytest

from shopledger.operators.history import current, versions
from shopledger.plans import checks, facts, marts
from shopledger.plans.stage import (
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PRODUCT_COLUMNS,
    stage_customers,
    stage_orders,
    stage_products,
)

NOW = "2024-12-31 00:00:00"
INGESTED = datetime(2024, 12, 1)
LINEAGE = "_ingest_ts timestamp, _file_mod_time timestamp, _source_file string"


def raw(spark, columns, rows):
    schema = ", ".join(f"{c} string" for c in columns.split()) + ", " + LINEAGE
    return spark.createDataFrame([(*r, INGESTED, INGESTED, "f") for r in rows], schema)


def orders(spark, rows):
    """(order, customer, product, quantity, price, status, date)"""
    columns = (
        "country order_id customer_id product_id quantity unit_price order_status order_date"
        " payment_method shipping_city"
    )
    return raw(spark, columns, [("DE", *r, " UPI", " new delhi ") for r in rows])


def customers(spark, rows):
    """(customer, sign-up)"""
    columns = "customer_id signup_date customer_name email tier city is_active"
    return raw(spark, columns, [(*r, " ann LEE", "A@X.Org ", "gold ", "pune", "true") for r in rows])


def products(spark, rows):
    """(product, operation, time, price, stock)"""
    columns = (
        "product_id operation cdc_timestamp unit_price stock_quantity product_name category brand"
        " is_active"
    )
    return raw(spark, columns, [(*r, "big lamp", "HOME goods", "a", "True") for r in rows])


@pytest.fixture(scope="module")
def tables(spark):
    o = stage_orders(
        orders(
            spark,
            [
                ("O1", "C1", "P1", "2", "600.0", "Completed", "2024-03-01"),
                ("O2", "C1", "P2", "1", "50.0", " shipped", "2024-03-01"),
                ("O3", "C2", "P1", "1", "100.0", "completed", "2024-09-01"),
                ("O4", "C9", "P9", "1", "10.0", "completed", "2024-09-02"),
                ("O5", "C2", "P1", "9", "999.0", "cancelled", "2024-09-02"),
                ("O6", None, "P1", "1", None, "completed", "2024-09-03"),
            ],
        ),
        NOW,
    )
    c = stage_customers(
        customers(spark, [("C1", "2024-02-20"), ("C2", "2023-01-01"), ("C3", "2023-01-01")]), NOW
    )
    p = stage_products(
        products(
            spark,
            [
                ("P1", "insert", "2024-01-01 00:00:00", "600.0", "5"),
                ("P1", "update", "2024-06-01 00:00:00", "100.0", "0"),
                ("P2", "insert", "2024-01-01 00:00:00", "50.0", "500"),
                ("P2", "delete", "2024-12-01 00:00:00", "50.0", "0"),
            ],
        ),
        NOW,
    )
    return (
        current(versions(o, "order_id")),
        versions(c, "customer_id"),
        versions(p, "product_id", "operation = 'DELETE'"),
    )


def test_stage_types_and_contract(spark):
    got = stage_orders(
        orders(spark, [("O1", "C1", "P1", "2", "1.5", " ShIpped ", "2024-05-06"),
                       ("O2", "C1", "P1", "two", "x", None, "2024-13-40")]), NOW,
    )
    assert got.columns == ORDER_COLUMNS and "country" not in got.columns
    good, bad = got.orderBy("order_id").collect()
    assert (good.quantity, good.unit_price, good.total_amount) == (2, 1.5, 3.0)
    assert (good.order_status, good.payment_method, good.shipping_city) == ("shipped", "upi", "New Delhi")
    assert (good.order_date, good.order_year, good.order_month) == (date(2024, 5, 6), 2024, 5)
    assert good._event_ts == datetime(2024, 5, 6) and good._updated_at == INGESTED
    assert (bad.quantity, bad.unit_price, bad.order_date, bad._event_ts) == (None, None, None, None)
    assert len(bad.order_sk) == 64 and bad.order_sk != good.order_sk

    got = stage_customers(customers(spark, [("C1", "2024-02-20"), ("C2", "soon")]), NOW)
    assert got.columns == CUSTOMER_COLUMNS
    first, second = got.orderBy("customer_id").collect()
    assert (first.customer_name, first.email, first.tier, first.city) == ("Ann Lee", "a@x.org", "GOLD", "Pune")
    assert first._event_ts == datetime(2024, 2, 20) and second._event_ts == INGESTED

    got = stage_products(products(spark, [("P1", " update ", "2024-01-01 10:00:00", "1.5", "7")]), NOW)
    assert got.columns == PRODUCT_COLUMNS
    only = got.first()
    assert (only.operation, only.product_name, only.category, only.brand) == (
        "UPDATE", "Big Lamp", "Home Goods", "A",
    )
    assert only.is_active is True and only._event_ts == datetime(2024, 1, 1, 10)


def test_current_facts_keep_orders_without_dimensions(tables):
    o, c, p = tables
    by_customer = facts.order_customer_fact(o, current(c), NOW)
    assert by_customer.columns == facts.ORDER_CUSTOMER_COLUMNS
    rows = {r.order_id: r for r in by_customer.collect()}
    assert len(rows) == 6
    assert rows["O1"].order_amount_band == "HIGH" and rows["O1"].customer_tenure_days == 10
    assert rows["O4"].customer_sk is None and rows["O4"].customer_tenure_days is None
    assert rows["O6"].order_amount_band == "LOW" and rows["O6"].is_high_value_order is None

    by_product = facts.order_customer_product_fact(o, current(c), current(p), NOW)
    assert by_product.columns == facts.ORDER_CUSTOMER_PRODUCT_COLUMNS
    rows = {r.order_id: r for r in by_product.collect()}
    assert rows["O1"].product_unit_price == 100.0 and rows["O1"].is_price_mismatch is True
    assert rows["O1"].product_stock_status == "OUT_OF_STOCK"
    # P2 is deleted, so no current product is left for it.
    assert rows["O2"].product_sk is None and rows["O2"].product_stock_status == "IN_STOCK"
    assert rows["O2"].is_price_mismatch is None


@pytest.mark.parametrize("hot", [None, {"customer_id": {"C1": 2, None: 2}, "product_id": {"P1": 3}}])
def test_pit_fact_takes_versions_of_order_time(tables, hot):
    o, c, p = tables
    pit = facts.pit_fact(o, c, p, NOW, hot)
    assert pit.columns == facts.PIT_COLUMNS
    rows = {r.order_id: r for r in pit.collect()}
    assert set(rows) == {"O1", "O2", "O3", "O4", "O6"}
    assert (rows["O1"].catalog_unit_price, rows["O1"].price_match_flag) == (600.0, "MATCH")
    assert (rows["O1"].tenure_bucket, rows["O1"].stock_risk_flag) == ("NEW", "LOW")
    assert (rows["O2"].catalog_unit_price, rows["O2"].stock_risk_flag) == (50.0, "OK")
    assert (rows["O3"].catalog_unit_price, rows["O3"].stock_risk_flag) == (100.0, "OOS")
    assert rows["O3"].tenure_bucket == "ESTABLISHED"
    nothing = rows["O4"]
    assert (nothing.product_sk, nothing.price_match_flag, nothing.stock_risk_flag) == (None, "MISMATCH", "OK")
    assert nothing.catalog_price_delta is None and nothing.tenure_bucket == "ESTABLISHED"

    missing = checks.missing_dimensions(pit, threshold=0.5).first()
    assert tuple(missing) == (2, 1, 5, True)
    assert checks.missing_dimensions(pit, threshold=0.1).first().within_threshold is False
    assert checks.duplicate_lines(pit).count() == 0
    assert checks.duplicate_lines(pit.union(pit)).count() == 5
    assert checks.negative_values(pit, "quantity", "stock_quantity").count() == 0
    assert checks.freshness(pit, 1, NOW).first().is_fresh is True
    assert checks.freshness(pit, 1, "2025-01-01 00:00:00").first().is_fresh is False


@pytest.mark.parametrize("unique", [False, True])
def test_marts(tables, unique):
    o, c, p = tables
    fact = facts.order_customer_fact(o, current(c), NOW)
    day = {(r.order_date, r.payment_method): r for r in marts.daily_revenue(fact, unique).collect()}
    first = day[date(2024, 3, 1), "upi"]
    assert (first.daily_revenue, first.order_count, first.avg_order_value) == (1250.0, 2, 625.0)
    assert first.total_items_sold == 3 and first.shipping_city == "New Delhi"

    got = {r.customer_id: r for r in marts.customer_360(current(c), fact, NOW, unique).collect()}
    assert set(got) == {"C1", "C2", "C3"}
    # Only completed orders count here, shipped ones do not.
    assert (got["C1"].total_orders, got["C1"].lifetime_value) == (1, 1200.0)
    assert (got["C1"].customer_segment, got["C1"].high_value_order_count) == ("medium_value", 1)
    assert got["C2"].days_since_last_order == 121
    empty = got["C3"]
    assert (empty.total_orders, empty.lifetime_value, empty.customer_segment) == (0, 0.0, "no_purchases")
    assert (empty.days_since_last_order, empty.first_order_date) == (None, None)

    wide = facts.order_customer_product_fact(o, current(c), current(p), NOW)
    top = {r.product_id: r for r in marts.top_products(wide, unique).collect()}
    assert {k: r.revenue_rank for k, r in top.items()} == {"P1": 1, "P2": 2, "P9": 3}
    assert (top["P1"].total_orders, top["P1"].unique_buyers, top["P1"].total_quantity) == (3, 2, 4)
    assert top["P2"].product_name is None and top["P2"].avg_catalog_price is None

    kpi = marts.executive_kpis(wide, NOW, unique).first()
    assert (kpi.orders_count, kpi.gross_revenue, kpi.avg_order_value) == (5, 1360.0, 340.0)
    assert (kpi.active_customers, kpi.active_products, kpi.out_of_stock_order_lines) == (3, 3, 3)


def test_distinct_orders_when_lines_repeat(tables):
    o, c, _ = tables
    fact = facts.order_customer_fact(o, current(c), NOW)
    twice = fact.union(fact)
    counts = {r.order_date: r.order_count for r in marts.daily_revenue(twice).collect()}
    assert counts[date(2024, 3, 1)] == 2
