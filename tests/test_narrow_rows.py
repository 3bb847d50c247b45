"""What passes a shuffle: no row twice, no hash text that can be made afterwards."""

import re

import pytest
from pyspark.sql import functions as F

from shopledger.functions.cleaning import version_key
from shopledger.operators import skew
from shopledger.operators.asof import asof_join
from shopledger.operators.history import current, keep_latest, versions
from shopledger.plans import facts
from shopledger.plans.stage import stage_customers, stage_orders, stage_products

LINEAGE = "_ingest_ts timestamp, _file_mod_time timestamp, _source_file string"


def rows(spark, names, data):
    """All text but for the lineage, from (day of ingestion or None, file, values...)."""
    shape = ", ".join(f"{name} string" for name in names)
    text = f"{shape}, _ts string, _source_file string"
    df = spark.createDataFrame([(*values, day, file) for day, file, *values in data], text)
    at = F.col("_ts").cast("timestamp")
    return df.withColumns({"_ingest_ts": at, "_file_mod_time": at}).drop("_ts")


@pytest.fixture(scope="module")
def staged(spark):
    orders = rows(
        spark,
        ["order_id", "customer_id", "product_id", "quantity", "unit_price", "order_status",
         "order_date", "payment_method", "shipping_city"],
        [
            ("2024-01-05", "f1", "o1", "c1", "p1", "1", "2.5", "completed", "2024-01-05", "card", "x"),
            ("2024-01-06", "f2", "o1", "c1", "p1", "2", "2.5", "shipped", "2024-01-06", "card", "x"),
            ("2024-01-06", "f2", "o2", "c2", None, "1", "9", "completed", "2024-01-06", "cash", "y"),
            ("2024-01-06", "f2", "o2", "c2", None, "1", "9", "completed", "2024-01-06", "cash", "y"),
            (None, "f3", "o3", None, "p2", "1", "1", "completed", None, None, None),
            (None, "f3", "o4", "c3", "p3", "1", "1", "shipped", None, None, "z"),
            ("2024-01-09", None, "o5", "c9", "p9", None, None, "completed", "2024-01-09", "card", "z"),
            ("2024-01-09", "f5", None, "c1", "p1", "1", "1", "completed", "2024-01-09", "card", "z"),
        ],
    )
    customers = rows(
        spark,
        ["customer_id", "customer_name", "email", "signup_date", "tier", "city", "is_active"],
        [
            ("2024-01-01", "f1", "c1", "ann", "a@x", "2024-01-01", "gold", "x", "true"),
            ("2024-01-06", "f1", "c1", "ann", "a@x", "2024-01-06", "iron", "y", "true"),
            ("2024-01-08", "f1", "c2", "bob", "b@x", "2024-01-08", "gold", "x", "true"),
            (None, None, "c3", "cid", "c@x", None, None, None, None),
            ("2024-01-08", "f1", None, "dan", "d@x", "2024-01-08", "gold", "x", "true"),
        ],
    )
    products = rows(
        spark,
        ["product_id", "product_name", "category", "brand", "unit_price", "stock_quantity",
         "is_active", "operation", "cdc_timestamp"],
        [
            ("2024-01-01", "f1", "p1", "pen", "k", "b", "2.5", "5", "true", "INSERT", "2024-01-01 00:00:00"),
            ("2024-01-05", "f2", "p1", "pen", "k", "b", "3.5", "5", "true", "UPDATE", "2024-01-05 12:00:00"),
            ("2024-01-01", "f1", "p2", "cup", "k", "b", "1", "0", "true", "DELETE", "2024-01-01 00:00:00"),
            (None, None, "p3", "pot", "k", "b", "1", "0", "true", "INSERT", None),
        ],
    )
    now = "2024-02-01"
    return stage_orders(orders, now), stage_customers(customers, now), stage_products(products, now)


def histories(staged, **made):
    orders, customers, products = staged

    def later(sk):
        return {f"{sk}_sk": version_key(f"{sk}_id")} if made.get("later") else None

    return (
        versions(orders, "order_id", ties=["order_status", "unit_price"], later=later("order")),
        versions(customers, "customer_id", ties=["customer_id"], later=later("customer")),
        versions(products, "product_id", "operation = 'DELETE'", None, ["unit_price"], later("product")),
    )


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[-1].splitlines()


def hashed_before_a_shuffle(df):
    """The lines of the plan that make hash text below an exchange."""
    found, above = [], []
    for line in plan(df):
        depth = re.search(r"[A-Za-z*]", line)
        if not depth:
            continue
        above = [(at, name) for at, name in above if at < depth.start()]
        above.append((depth.start(), line))
        if "sha2(" in line and any("Exchange" in name for _, name in above[:-1]):
            found.append(line)
    return found


def test_versions_make_hash_text_after_the_shuffle(staged, rows_of):
    for plain, narrow in zip(histories(staged), histories(staged, later=True)):
        assert narrow.columns == plain.columns
        assert rows_of(narrow) == rows_of(plain)
        assert not hashed_before_a_shuffle(narrow)
    hot = {"o1": 2, "o2": 3}
    split = versions(staged[0], "order_id", hot=hot, ties=["order_status", "unit_price"])
    assert rows_of(split) == rows_of(histories(staged, later=True)[0])


def test_keep_latest_makes_hash_text_after_the_shuffle(staged, rows_of):
    by, latest = ["order_id", "_event_ts"], ["_ingest_ts", "_source_file"]
    plain = keep_latest(staged[0], by, latest)
    narrow = keep_latest(staged[0], by, latest, later={"order_sk": version_key("order_id")})
    assert narrow.columns == plain.columns
    assert rows_of(narrow) == rows_of(plain)


@pytest.mark.parametrize("event_time_only", [False, True])
def test_pit_fact_with_staged_keys(staged, rows_of, event_time_only):
    orders, customers, products = histories(staged)
    want = facts.pit_fact(current(orders), customers, products, "2024-02-01", None, event_time_only)
    orders, customers, products = histories(staged, later=True)
    inputs = current(orders), customers, products, "2024-02-01"
    got = facts.pit_fact(*inputs, None, event_time_only, staged_keys=True)
    hot = {"customer_id": {"c1": 2, None: 2}, "product_id": {"p1": 2}}
    split = facts.pit_fact(*inputs, hot, event_time_only, staged_keys=True)
    assert got.columns == want.columns and got.count() == 5
    assert rows_of(got) == rows_of(want) == rows_of(split)
    # A version without any time still has a key; a fact without a version has none.
    keys = {r.order_id: r.customer_sk for r in got.collect()}
    assert keys["o4"] is not None and keys["o3"] is None and keys["o5"] is None
    assert not hashed_before_a_shuffle(got)


def test_facts_over_current_versions_with_staged_keys(staged, rows_of):
    orders, customers, products = map(current, histories(staged))
    kept = map(current, histories(staged, later=True))
    for build, inputs, narrow in (
        (facts.order_customer_product_fact, (orders, customers, products), list(kept)),
        (facts.order_customer_fact, (orders, customers), None),
    ):
        narrow = inputs if narrow is None else narrow
        got = build(*narrow, "2024-02-01", staged_keys=True)
        want = build(*inputs, "2024-02-01")
        split = build(*narrow, "2024-02-01", {"customer_id": {"c1": 2}}, staged_keys=True)
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want) == rows_of(split)


def test_versions_are_not_shuffled_again_by_the_join_in_time(staged):
    orders, customers, _ = histories(staged, later=True)
    joined = asof_join(current(orders), customers, "customer_id", {"tier": "tier"})
    lines = plan(joined)
    union = next(i for i, line in enumerate(lines) if "Union" in line)
    assert not any("Exchange" in line for line in lines[:union])
    # One shuffle each for orders by order, orders by customer, customers by customer.
    assert sum("Exchange" in line for line in lines) == 3


def test_hot_keys_do_not_depend_on_their_buckets(spark, monkeypatch):
    key = F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 5 > 0, F.col("id").cast("string"))
    df = spark.range(900).select(key.alias("k"))
    monkeypatch.setattr(skew, "COUNTED_BUCKETS", 1)
    one = skew.hot_keys(df, "k", group_rows=50, max_share=0)
    monkeypatch.setattr(skew, "COUNTED_BUCKETS", 1 << 15)
    assert skew.hot_keys(df, "k", group_rows=50, max_share=0) == one == {"big": 6, None: 3}
    assert skew.hot_keys(df.limit(0), "k", group_rows=50) == {}
