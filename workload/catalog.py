"""The registered Spark queries, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import business as rule
from shopledger.functions.cleaning import key_from_parts, key_parts, version_key
from shopledger.operators.asof import Changes, asof_join
from shopledger.operators.expectations import apply_expectations, violation_report
from shopledger.operators.history import (
    END,
    SEQUENCE,
    START,
    covered,
    current,
    current_from_changes,
    keep_latest,
    overlaps,
    versions,
)
from shopledger.operators.skew import hot_keys
from shopledger.plans import checks, facts, maintained, marts, rules
from shopledger.plans.gates import GateClosed, publish_table
from shopledger.plans.pipeline import Pipeline
from shopledger.plans.stage import stage_customers, stage_orders, stage_products
from shopledger.session import COMPRESSION, freeing, scratch_path
from shopledger.sources.files import LINEAGE, csv_options, file_schema, write_csv
from shopledger.sources.tables import read_table, register_view
from shopledger.streaming.ingest import (
    append_stream,
    backfill,
    counted_run,
    ingest_csv,
    ingest_csv_evolving,
    read_ingested,
)
from shopledger.streaming.versioned import (
    BUCKET,
    Changed,
    fold_versions,
    gather_log,
    log_changes,
    read_versions,
    rebuild_versions,
    refresh_versions,
    versions_query,
)
from workload import feeds
from workload.oracle import AS_OF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

IS_DELETE = "operation = 'DELETE'"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Stored times carry no zone; surrogate keys hash their text.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


# ---- output in types that compare exactly -------------------------------------------------------


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def spans(df: DataFrame) -> DataFrame:
    """Versions with the ends of their intervals as flat columns."""
    hidden = {START, END, "_event_ts", "_ingest_ts", "_updated_at", "_inserted_at"}
    hidden |= {"_file_mod_time", "_source_file"}
    payload = [name for name in df.columns if name not in hidden]
    return plain(
        df.select(
            *payload,
            F.col(f"{START}._event_ts").alias("start_event_ts"),
            F.col(f"{START}._source_file").alias("start_source_file"),
            F.col(f"{END}._event_ts").alias("end_event_ts"),
            F.col(f"{END}._ingest_ts").alias("end_ingest_ts"),
            F.col(f"{END}._source_file").alias("end_source_file"),
        )
    )


# ---- staged rows, versions, facts ---------------------------------------------------------------


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_orders(feeds.order_feed(spark, sf_dir), AS_OF)


def staged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_customers(feeds.customer_feed(spark, sf_dir), AS_OF)


def changed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.customer_feed(spark, sf_dir)
    return stage_customers(feed, AS_OF, event_ts=F.col("_ingest_ts"))


def staged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_products(feeds.product_feed(spark, sf_dir), AS_OF)


# The columns in which two rows of equal key and sequence can differ; the position in the feed
# already names order, line, part, supplier and quantity.
ORDER_TIES = ["order_status", "unit_price"]
CUSTOMER_TIES = ["customer_id"]
PRODUCT_TIES = ["operation", "unit_price", "stock_quantity"]

# Surrogate keys follow from these columns and are made after the shuffle.
KEYS = {"order_sk": "order_id", "customer_sk": "customer_id", "product_sk": "product_id"}

# Rows per key from which the hot_ queries split a key.
SPLIT_ROWS = 44


def made(sk: str) -> dict[str, Column]:
    return {sk: version_key(KEYS[sk])}


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = feeds.hot_orders(spark, sf_dir)
    return versions(
        staged_orders(spark, sf_dir), "order_id", hot=hot, ties=ORDER_TIES, later=made("order_sk")
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = feeds.hot_customers(spark, sf_dir)
    changes = changed_customers(spark, sf_dir)
    return versions(changes, "customer_id", hot=hot, ties=CUSTOMER_TIES, later=made("customer_sk"))


def signup_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = feeds.hot_customers(spark, sf_dir)
    changes = staged_customers(spark, sf_dir)
    return versions(changes, "customer_id", hot=hot, ties=CUSTOMER_TIES, later=made("customer_sk"))


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = feeds.hot_products(spark, sf_dir)
    changes = staged_products(spark, sf_dir)
    return versions(changes, "product_id", IS_DELETE, hot, PRODUCT_TIES, made("product_sk"))


def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(order_versions(spark, sf_dir))


def current_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(customer_versions(spark, sf_dir))


def current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(product_versions(spark, sf_dir))


def customer_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_customer_fact(
        current_orders(spark, sf_dir),
        current_customers(spark, sf_dir),
        AS_OF,
        feeds.hot_dimensions(spark, sf_dir),
        staged_keys=True,
    )


def product_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_customer_product_fact(
        current_orders(spark, sf_dir),
        current_customers(spark, sf_dir),
        current_products(spark, sf_dir),
        AS_OF,
        feeds.hot_dimensions(spark, sf_dir),
        staged_keys=True,
    )


def point_in_time(spark: SparkSession, sf_dir: str, event_time_only: bool = False) -> DataFrame:
    return facts.pit_fact(
        current_orders(spark, sf_dir),
        customer_versions(spark, sf_dir),
        product_versions(spark, sf_dir),
        AS_OF,
        feeds.hot_pit(spark, sf_dir),
        event_time_only,
        staged_keys=True,
    )


# ---- stage and scalar rules ---------------------------------------------------------------------


@query
def stage_orders_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(staged_orders(spark, sf_dir))


@query
def stage_customers_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(staged_customers(spark, sf_dir))


@query
def stage_products_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(staged_products(spark, sf_dir))


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_orders(spark, sf_dir).select("order_id", "order_sk")


@query
def filter_completed_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.revenue_orders(staged_orders(spark, sf_dir)).select("order_sk", "order_status")


@query
def amount_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = customer_fact(spark, sf_dir)
    return fact.select("order_sk", "order_amount_band", "is_high_value_order")


@query
def stock_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = F.col("stock_quantity")
    staged = staged_products(spark, sf_dir)
    return staged.select("product_sk", stock, rule.stock_status(stock).alias("stock_status"))


@query
def tenure_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.col("customer_tenure_days")
    fact = customer_fact(spark, sf_dir)
    return fact.select("order_sk", days, rule.tenure_bucket(days).alias("tenure_bucket"))


@query
def price_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, catalog_price = F.col("order_unit_price"), F.col("product_unit_price")
    flag = rule.price_match(price, catalog_price).alias("price_match_flag")
    fact = product_fact(spark, sf_dir)
    return fact.select("order_sk", price, catalog_price, "is_price_mismatch", flag)


# ---- versions -----------------------------------------------------------------------------------


@query
def scd2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(order_versions(spark, sf_dir))


@query
def scd2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(customer_versions(spark, sf_dir))


@query
def scd2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(product_versions(spark, sf_dir))


@query
def scd2_current_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = current(customer_versions(spark, sf_dir))
    return plain(now.select(*[c for c in now.columns if not c.startswith("_")]))


@query
def scd2_current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By aggregation alone, without building the history."""
    now = current_from_changes(staged_products(spark, sf_dir), "product_id", IS_DELETE)
    return plain(now.select(*[c for c in now.columns if not c.startswith("_")]))


@query
def dedup_orders_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ["_ingest_ts", "_file_mod_time", "_source_file"]
    staged = staged_orders(spark, sf_dir)
    kept = keep_latest(staged, ["order_id", "_event_ts"], latest, later=made("order_sk"))
    shown = [c for c in kept.columns if not c.startswith("_")]
    return plain(kept.select(*shown, "_record_number"))


@query
def check_scd2_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covered(
        customer_versions(spark, sf_dir), "customer_id", feeds.hot_customers(spark, sf_dir)
    )
    return found.groupBy("customer_id").agg(F.count("*").alias("overlaps"))


@query
def check_overlap_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On versions of which some end a year late, so that they span several later ones."""
    later = F.struct(
        (F.col(f"{END}._event_ts") + F.expr("INTERVAL 400 DAYS")).alias("_event_ts"),
        *[F.col(f"{END}.{name}").alias(name) for name in SEQUENCE[1:]],
    )
    doctored = customer_versions(spark, sf_dir)
    late = (F.col("tier") == "BUILDING") & F.col(END).isNotNull()
    doctored = doctored.withColumn(END, F.when(late, later).otherwise(F.col(END)))
    found = covered(doctored, "customer_id", feeds.hot_customers(spark, sf_dir))
    return found.groupBy("customer_id").agg(F.count("*").alias("overlaps"))


@query
def scd2_customers_by_signup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sign-up date as event time, so that the ingest time decides between a customer's changes."""
    return spans(signup_versions(spark, sf_dir))


@query
def scd2_dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above; without a usable sign-up date the ingest time takes its place."""
    changes = stage_customers(feeds.dirty_customer_feed(spark, sf_dir), AS_OF)
    return spans(versions(changes, "customer_id", hot=feeds.hot_customers(spark, sf_dir)))


@query
def hot_scd2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of more than a few rows split over tasks, as a hot key is."""
    changes = staged_products(spark, sf_dir)
    hot = hot_keys(changes, "product_id", SPLIT_ROWS)
    return spans(versions(changes, "product_id", IS_DELETE, hot, PRODUCT_TIES, made("product_sk")))


@query
def check_overlap_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On versions of which some never end."""
    open_ended = F.when(F.col("tier") != "BUILDING", F.col(END))
    doctored = customer_versions(spark, sf_dir).withColumn(END, open_ended)
    found = overlaps(doctored, "customer_id", feeds.hot_customers(spark, sf_dir))
    return found.groupBy("customer_id").agg(F.count("*").alias("overlaps"))


# ---- facts and joins in time --------------------------------------------------------------------


@query
def fact_order_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(customer_fact(spark, sf_dir).drop("_mv_refreshed_at"))


@query
def fact_order_customer_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(product_fact(spark, sf_dir).drop("_mv_refreshed_at"))


@query
def fact_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older facts first, then, in a run that happens twice, what is new: every fact once."""
    table = scratch_path(spark, "fact_append")
    columns = ["order_sk", "order_id", "customer_sk", "order_amount_band"]
    fact = customer_fact(spark, sf_dir)
    older = fact.filter(F.col("order_date") < "1999-01-01").select(*columns)
    facts.append_facts(older, table, "1")
    for _ in range(2):
        known = spark.read.parquet(table).filter("run < 2")
        facts.append_facts(facts.new_facts(fact, known).select(*columns), table, "2")
    return spark.read.parquet(table).drop("run")


@query
def pit_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(point_in_time(spark, sf_dir).drop("_gold_load_ts"))


@query
def pit_join_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(point_in_time(spark, sf_dir, event_time_only=True).drop("_gold_load_ts"))


@query
def pit_join_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes in place of the versions they make, for where no version table is stored."""
    taken = {"product_sk": "product_sk", "unit_price": "catalog_unit_price"}
    hot = feeds.hot_pit(spark, sf_dir)["product_id"]
    lines = current_orders(spark, sf_dir).select("order_id", "product_id", *SEQUENCE)
    staged = staged_products(spark, sf_dir).withColumn("product_sk", key_parts())
    changes = Changes(staged, IS_DELETE, PRODUCT_TIES)
    joined = asof_join(lines, changes, "product_id", taken, hot=hot).withColumns(made("order_sk"))
    product_sk = key_from_parts("product_id", "product_sk").alias("product_sk")
    return joined.select("order_sk", product_sk, "catalog_unit_price")


@query
def pit_join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = {"customer_sk": "customer_sk", "tier": "tier"}
    hot = feeds.hot_pit(spark, sf_dir)["customer_id"]
    lines = current_orders(spark, sf_dir).drop("order_sk")
    joined = asof_join(lines, customer_versions(spark, sf_dir), "customer_id", taken, hot=hot)
    return joined.withColumns(made("order_sk")).select("order_sk", "customer_sk", "tier")


@query
def pit_join_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = {"product_sk": "product_sk", "unit_price": "catalog_unit_price"}
    hot = feeds.hot_pit(spark, sf_dir)["product_id"]
    lines = current_orders(spark, sf_dir).drop("order_sk")
    joined = asof_join(lines, product_versions(spark, sf_dir), "product_id", taken, hot=hot)
    return joined.withColumns(made("order_sk")).select("order_sk", "product_sk", "catalog_unit_price")


@query
def pit_join_customer_by_signup(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = {"customer_sk": "customer_sk", "tier": "tier"}
    hot = feeds.hot_pit(spark, sf_dir)["customer_id"]
    lines = current_orders(spark, sf_dir).drop("order_sk")
    joined = asof_join(lines, signup_versions(spark, sf_dir), "customer_id", taken, hot=hot)
    return joined.withColumns(made("order_sk")).select("order_sk", "customer_sk", "tier")


@query
def hot_pit_join_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = {"product_sk": "product_sk", "unit_price": "catalog_unit_price"}
    lines = current_orders(spark, sf_dir).select("order_id", "product_id", *SEQUENCE)
    hot = hot_keys(feeds.product_feed(spark, sf_dir), "product_id", SPLIT_ROWS)
    joined = asof_join(lines, product_versions(spark, sf_dir), "product_id", taken, hot=hot)
    return joined.withColumns(made("order_sk")).select("order_sk", "product_sk", "catalog_unit_price")


@query
def hot_fact_order_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = current_orders(spark, sf_dir)
    hot = {"customer_id": hot_keys(lines, "customer_id", SPLIT_ROWS)}
    customers = current_customers(spark, sf_dir)
    fact = facts.order_customer_fact(lines, customers, AS_OF, hot, staged_keys=True)
    return plain(fact.drop("_mv_refreshed_at"))


@query
def check_pit_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a fact in which lines of matching price come twice."""
    times = F.when(F.col("price_match_flag") == "MATCH", 2).otherwise(1)
    copies = F.explode(F.sequence(F.lit(1), times)).alias("copy")
    return checks.duplicate_lines(point_in_time(spark, sf_dir).select("*", copies))


@query
def check_freshness_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = staged_customers(spark, sf_dir).withColumnRenamed("_ingest_ts", "_gold_load_ts")
    return plain(checks.freshness(loads, max_hours=365 * 24, now=AS_OF, by=["customer_id"]))


@query
def pit_revenue_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by(point_in_time(spark, sf_dir), "tier", "category", exact=True)


@query
def check_pit_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_lines(point_in_time(spark, sf_dir))


@query
def check_pit_missing_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_dimensions(point_in_time(spark, sf_dir), threshold=0.5)


@query
def check_negative_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["quantity", "order_unit_price", "stock_quantity"]
    found = checks.negative_values(point_in_time(spark, sf_dir), *columns)
    return found.select("order_sk", "quantity", "stock_quantity")


@query
def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(checks.freshness(point_in_time(spark, sf_dir), max_hours=24, now=AS_OF))


# ---- marts --------------------------------------------------------------------------------------


@query
def mart_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.daily_revenue(customer_fact(spark, sf_dir), unique_orders=True, exact=True)
    return plain(mart)


@query
def agg_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = marts.customer_metrics(customer_fact(spark, sf_dir), exact=True)
    return plain(metrics)


@query
def mart_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.customer_360(
        current_customers(spark, sf_dir),
        customer_fact(spark, sf_dir),
        AS_OF,
        unique_orders=True,
        exact=True,
    )
    return plain(mart)


@query
def mart_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.top_products(product_fact(spark, sf_dir), unique_orders=True, exact=True)
    return mart


@query
def mart_executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.executive_kpis(product_fact(spark, sf_dir), AS_OF, unique_orders=True, exact=True)
    return plain(mart)


@query
def published_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published behind its gate; a later content with taken-back totals is turned away."""
    path = scratch_path(spark, "published")
    gate = rules.daily_revenue_gate()
    fact = customer_fact(spark, sf_dir)
    mart = marts.daily_revenue(fact, unique_orders=True, exact=True)
    table = publish_table(mart, path, "daily_revenue", gate)
    # A first look at the table does not hold it: the folders change in turn.
    bad = table.withColumn("daily_revenue", -F.col("daily_revenue"))
    try:
        publish_table(bad, path, "daily_revenue", gate)
    except GateClosed as closed:
        assert closed.broken == ["non_negative"]
    else:
        raise AssertionError("the gate was open")
    return plain(read_table(spark, path))


@query
def mart_daily_revenue_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept up to date from changes: first values are taken back by corrections, some come late."""
    path = scratch_path(spark, "maintained")
    orders = staged_orders(spark, sf_dir).withColumn("order_sk", key_parts())
    before = {"_ingest_ts": F.col("_ingest_ts") - F.expr("INTERVAL 1 DAY"),
              "quantity": F.col("quantity") + 1, "total_amount": F.col("total_amount") + F.col("unit_price")}
    early = F.col("order_year") < 1997
    first = orders.withColumns(before)
    drops = [first.filter(early), orders, first.filter(~early)]
    changed = maintained.DAILY_REVENUE.record(path)
    for i in range(len(drops)):
        _versions_by_drops(
            spark, drops[i : i + 1], "", "order_id", base=f"{path}/orders", changed=changed, sk="order_sk"
        )
        if i == 1:
            maintained.DAILY_REVENUE.fold(spark, path)
    return plain(maintained.daily_revenue(spark, path))


# ---- data quality -------------------------------------------------------------------------------


@query
def dq_warn_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    warn = {"expect": rules.CUSTOMERS["expect"]}
    return apply_expectations(staged_customers(spark, sf_dir), warn).select("customer_sk", "email")


@query
def dq_drop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = apply_expectations(staged_orders(spark, sf_dir), rules.ORDERS)
    return kept.select("order_sk", "quantity", "unit_price")


@query
def dq_drop_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropping = {"expect_or_drop": {"non_negative_stock": "stock_quantity >= 0"}}
    kept = apply_expectations(staged_products(spark, sf_dir), dropping)
    return kept.select("product_sk", "stock_quantity")


@query
def dq_fail_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = apply_expectations(staged_customers(spark, sf_dir), rules.CUSTOMERS)
    return passed.select("customer_sk", "customer_id")


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts' inputs are made once and stored, as the pipeline does."""
    base = scratch_path(spark, "dq_report")

    def stored(name: str, df: DataFrame) -> DataFrame:
        with freeing(spark):
            df.write.option("compression", COMPRESSION).parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    orders = stored("orders", current_orders(spark, sf_dir))
    customers = stored("customers", customer_versions(spark, sf_dir))
    fact = facts.order_customer_fact(
        orders, current(customers), AS_OF, feeds.hot_dimensions(spark, sf_dir)
    )
    pit = facts.pit_fact(
        orders, customers, product_versions(spark, sf_dir), AS_OF, feeds.hot_pit(spark, sf_dir)
    )
    inputs = {
        "orders": (staged_orders(spark, sf_dir), rules.ORDERS),
        "customers": (staged_customers(spark, sf_dir), rules.CUSTOMERS),
        "daily_revenue": (marts.daily_revenue(fact, unique_orders=True), rules.DAILY_REVENUE),
        "pit_fact": (pit, rules.PIT_FACT),
    }
    reports = [
        violation_report(df, rule_set).withColumn("table_name", F.lit(name))
        for name, (df, rule_set) in inputs.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def dq_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violation_report(staged_products(spark, sf_dir), rules.PRODUCTS)


@query
def stage_dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed dates and numbers become NULL."""
    return plain(stage_orders(feeds.dirty_order_feed(spark, sf_dir), AS_OF))


@query
def stage_dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(stage_customers(feeds.dirty_customer_feed(spark, sf_dir), AS_OF))


@query
def dq_drop_dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_orders(feeds.dirty_order_feed(spark, sf_dir), AS_OF)
    return apply_expectations(staged, rules.ORDERS).select("order_sk", "quantity", "unit_price")


@query
def dq_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stage_orders(feeds.dirty_order_feed(spark, sf_dir), AS_OF)
    customers = stage_customers(feeds.dirty_customer_feed(spark, sf_dir), AS_OF)
    first = violation_report(orders, rules.ORDERS).withColumn("table_name", F.lit("orders"))
    second = violation_report(customers, rules.CUSTOMERS)
    return first.unionByName(second.withColumn("table_name", F.lit("customers")))


@query
def dq_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken while the rows pass, over several micro-batches."""
    base = scratch_path(spark, "dq_stream")
    raw = feeds.dirty_order_feed(spark, sf_dir)
    raw.write.parquet(f"{base}/raw")
    files = max(1, spark.sparkContext.defaultParallelism // 4)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files)
    staged = stage_orders(stream.parquet(f"{base}/raw"), AS_OF)
    checked = apply_expectations(staged, rules.ORDERS, "dirty_orders")
    counts = counted_run(
        spark, "dirty_orders", lambda: append_stream(checked, f"{base}/table", f"{base}/state")
    )
    report = [
        (name, action, counts[name], counts["rows"])
        for action, named in rules.ORDERS.items()
        for name in named
    ]
    return spark.createDataFrame(
        report, "rule string, action string, failed_rows long, total_rows long"
    )


# ---- files and streams --------------------------------------------------------------------------


def _raw_order_columns(raw: DataFrame, *more: Column) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        "order_status",
        "order_date",
        "payment_method",
        "shipping_city",
        *more,
    )


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(feeds.order_feed(spark, sf_dir).drop(*LINEAGE), path)
    schema = file_schema(spark, path, infer=False)
    return _raw_order_columns(spark.read.schema(schema).options(**csv_options(schema)).csv(path))


@query
def stream_ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "ingest_csv")
    write_csv(feeds.order_feed(spark, sf_dir).drop(*LINEAGE), f"{base}/landing")
    ingest_csv(spark, f"{base}/landing", f"{base}/table", f"{base}/state")
    # A second run finds nothing new.
    ingest_csv(spark, f"{base}/landing", f"{base}/table", f"{base}/state")
    table = read_ingested(spark, f"{base}/table")
    complete = F.lit(True)
    for name in LINEAGE:
        complete = complete & F.col(name).isNotNull()
    return _raw_order_columns(table, complete.alias("has_lineage"))


@query
def ingest_infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "ingest_types")
    feed = feeds.customer_feed(spark, sf_dir).withColumnRenamed("_ingest_ts", "change_ts")
    write_csv(feed.drop(*LINEAGE), f"{base}/landing")
    ingest_csv(spark, f"{base}/landing", f"{base}/table", f"{base}/state", infer=True)
    table = read_ingested(spark, f"{base}/table")
    columns = ["customer_id", "customer_name", "email", "signup_date", "tier", "city", "is_active"]
    return plain(table.select(*columns, "change_ts"))


@query
def schema_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first drop without the city, a later drop with it, in another column order."""
    base = scratch_path(spark, "add_columns")
    feed = feeds.customer_feed(spark, sf_dir)
    change_ts = F.date_format("_ingest_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("change_ts")
    early = F.col("_ingest_ts") < F.lit("1999-01-01").cast("timestamp")
    first = feed.filter(early).select("customer_id", "tier", "signup_date", change_ts)
    later = feed.filter(~early).select("city", change_ts, "customer_id", "signup_date", "tier")
    for drop in (first, later):
        drop.write.mode("append").option("header", True).csv(f"{base}/landing")
        ingest_csv_evolving(spark, f"{base}/landing", f"{base}/table", f"{base}/state", infer=True)
    table = read_ingested(spark, f"{base}/table", f"{base}/state")
    return plain(table.select("customer_id", "tier", "city", "signup_date", "change_ts"))


@query
def backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed history from parquet once, everything later from CSV drops with inferred types."""
    base = scratch_path(spark, "backfill")
    feed = feeds.product_feed(spark, sf_dir).withColumnRenamed("_source_file", "feed_position")
    feed = feed.drop("_ingest_ts", "_file_mod_time")
    old = F.col("cdc_timestamp") < "1999-01-01"
    typed = {
        "unit_price": F.col("unit_price").cast("double"),
        "stock_quantity": F.col("stock_quantity").cast("long"),
        "cdc_timestamp": F.col("cdc_timestamp").cast("timestamp"),
    }
    feed.filter(old).withColumns(typed).write.parquet(f"{base}/history")
    write_csv(feed.filter(~old), f"{base}/landing")
    for _ in range(2):
        backfill(spark, f"{base}/history", f"{base}/table", f"{base}/state")
        ingest_csv(spark, f"{base}/landing", f"{base}/table", f"{base}/state", infer=True)
    table = read_ingested(spark, f"{base}/table", f"{base}/state")
    operation = F.trim("operation").alias("operation")
    return plain(
        table.select("product_id", operation, "unit_price", "cdc_timestamp", "feed_position")
    )


@query
def stream_stage_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stage_stream")
    raw = feeds.order_feed(spark, sf_dir)
    raw.write.parquet(f"{base}/raw")
    stream = spark.readStream.schema(raw.schema).parquet(f"{base}/raw")
    append_stream(stage_orders(stream, AS_OF), f"{base}/staged", f"{base}/state")
    return plain(spark.read.parquet(f"{base}/staged"))


def _versions_by_drops(
    spark: SparkSession,
    drops: list[DataFrame],
    label: str,
    key: str,
    delete: str | None = None,
    base: str | None = None,
    changed: Changed | None = None,
    sk: str | None = None,
) -> tuple[str, DataFrame]:
    """Change drops landing one after the other, each followed by an incremental run.

    ``sk`` names a surrogate key that the drops hold as its parts, and the stored versions too.
    """
    base = base or scratch_path(spark, label)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for drop in drops:
        with freeing(spark):
            drop.write.mode("append").option("compression", COMPRESSION).parquet(f"{base}/landing")
        stream = spark.readStream.schema(drop.schema).parquet(f"{base}/landing")
        log_changes(stream, f"{base}/log", f"{base}/state/log", key, buckets)
        refresh_versions(
            spark, f"{base}/log", f"{base}/table", f"{base}/state/table", key, delete, changed=changed,
            ties=_logged_ties(drop.columns, sk),
        )
    return base, read_versions(spark, f"{base}/table", key=key)


def _logged_ties(columns: list[str], sk: str | None) -> list[str | Column] | None:
    """All columns of the log, with the surrogate key itself in place of its parts."""
    if sk is None:
        return None
    return [*[key_from_parts(KEYS[sk], sk) if c == sk else c for c in columns], BUCKET]


def _shuffled(changes: DataFrame, drops: int) -> list[DataFrame]:
    """All rows in drops that follow no order of time."""
    drop = F.pmod(F.xxhash64("_source_file"), F.lit(drops))
    return [changes.filter(drop == i) for i in range(drops)]


@query
def stream_scd2_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = _shuffled(feeds.event_changes(spark, sf_dir), 2)
    return spans(_versions_by_drops(spark, drops, "upsert", "user_id")[1])


@query
def stream_scd2_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = _shuffled(feeds.event_changes(spark, sf_dir), 2)
    delete = "event_type = 'error'"
    return spans(_versions_by_drops(spark, drops, "deletes", "user_id", delete)[1])


@query
def stream_scd2_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops in no order of time; the log is gathered and superseded versions folded in between."""
    drops = _shuffled(feeds.event_changes(spark, sf_dir), 3)
    base = scratch_path(spark, "upkeep")
    for drop in drops:
        _versions_by_drops(spark, [drop], "", "user_id", base=base)
        gather_log(spark, f"{base}/log")
        fold_versions(spark, f"{base}/table", "user_id")
    return spans(read_versions(spark, f"{base}/table"))


@query
def flows_with_one_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three flows of which one has no folder to read: the other two take all their rows."""
    base = scratch_path(spark, "flows")
    write_csv(feeds.order_feed(spark, sf_dir).drop(*LINEAGE), f"{base}/landing/orders")
    write_csv(feeds.product_feed(spark, sf_dir).drop(*LINEAGE), f"{base}/landing/products")
    try:
        Pipeline(spark, f"{base}/landing", f"{base}/tables").ingest()
    except RuntimeError as failed:
        assert "customers" in str(failed)
    else:
        raise AssertionError("the flow without a folder did not fail")
    orders = read_ingested(spark, f"{base}/tables/bronze/bronze_order")
    products = read_ingested(spark, f"{base}/tables/bronze/bronze_product")
    ids = orders.select(F.lit("orders").alias("flow"), F.col("order_id").alias("id"))
    more = products.select(F.lit("products").alias("flow"), F.col("product_id").alias("id"))
    return ids.unionByName(more).groupBy("flow", "id").agg(F.count("*").alias("rows"))


@query
def scd2_late_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent changes arrive first, older ones after them."""
    changes = changed_customers(spark, sf_dir)
    recent = F.col("_event_ts") >= F.lit("1999-01-01").cast("timestamp")
    drops = [changes.filter(recent), changes.filter(~recent)]
    return spans(_versions_by_drops(spark, drops, "late", "customer_id")[1])


@query
def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change delivered twice, then the table rebuilt from the log."""
    changes = staged_products(spark, sf_dir).withColumn("product_sk", key_parts())
    drops = [changes, changes]
    base, _ = _versions_by_drops(spark, drops, "replay", "product_id", IS_DELETE, sk="product_sk")
    ties = _logged_ties(changes.columns, "product_sk")
    rebuild_versions(spark, f"{base}/log", f"{base}/rebuilt", "product_id", IS_DELETE, ties)
    rebuilt = read_versions(spark, f"{base}/rebuilt")
    return spans(rebuilt.withColumn("product_sk", key_from_parts("product_id", "product_sk")))


@query
def stored_current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops in order of time, read as the current state through a catalog view."""
    changes = staged_products(spark, sf_dir).withColumn("product_sk", key_parts())
    year = F.year("_event_ts")
    drops = [changes.filter(year < 1997), changes.filter(year == 1997), changes.filter(year > 1997)]
    base, _ = _versions_by_drops(spark, drops, "stored", "product_id", IS_DELETE, sk="product_sk")
    # A name of its own, so that two runs in one catalog do not overwrite each other's view.
    name = f"silver.stored_products_{base.rsplit('-', 1)[-1]}"
    register_view(spark, name, versions_query(spark, f"{base}/table"), "Versions per product")
    now = spark.sql(f"SELECT * FROM {name} WHERE {END} IS NULL")
    now = now.withColumn("product_sk", key_from_parts("product_id", "product_sk"))
    return plain(now.select(*[c for c in now.columns if not c.startswith("_")]))


def queries() -> dict[str, Query]:
    return {name.rstrip("_"): run for name, run in QUERIES.items()}
