"""The whole flow from file drops to marts, as one run-to-completion batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from shopledger.operators.expectations import Rules, apply_expectations
from shopledger.operators.history import current
from shopledger.operators.skew import hot_keys, merge_hot
from shopledger.plans import facts, maintained, marts, rules
from shopledger.plans.gates import Gate, GateClosed, publish_table
from shopledger.plans.stage import stage_customers, stage_orders, stage_products
from shopledger.sources.tables import (
    read_table,
    register_table,
    register_view,
    table_path,
)
from shopledger.streaming.ingest import (
    FILES,
    backfill,
    conform,
    counted_run,
    flow_paths,
    flow_schema,
    ingest_csv_evolving,
    stream_ingested,
    table_schema,
)
from shopledger.streaming.versioned import (
    Changed,
    fold_versions,
    gather_log,
    log_changes,
    read_versions,
    refresh_versions,
    versions_query,
)


@dataclass(frozen=True)
class Entity:
    """One source: landing folder, ingested and versioned table, key and treatment."""

    folder: str
    ingested: str
    versioned: str
    key: str
    stage: Callable[..., DataFrame]
    rules: Rules
    infer: bool
    delete: str | None = None


ENTITIES = (
    Entity("orders", "bronze_order", "silver_orders", "order_id", stage_orders, rules.ORDERS, False),
    Entity(
        "customers", "bronze_customer", "silver_customers", "customer_id", stage_customers,
        rules.CUSTOMERS, True,
    ),
    Entity(
        "products", "bronze_product", "silver_products", "product_id", stage_products,
        rules.PRODUCTS, True, "operation = 'DELETE'",
    ),
)

COMMENTS = {
    "bronze.bronze_order": "Order rows as received",
    "bronze.bronze_customer": "Customer rows as received",
    "bronze.bronze_product": "Product change events as received",
    "silver.silver_order_customer_fact": "Current orders with current customers",
    "silver.silver_order_customer_product_fact": "Current orders with current customers and products",
    "gold.gold_daily_revenue": "Revenue per day, city and payment method",
    "gold.gold_customer_360": "Customer profile, purchases and value segment",
    "gold.gold_top_products": "Products ranked by revenue",
    "gold.gold_executive_kpis": "Indicator snapshot",
    "gold.gold_order_customer_product_pit_fact": "Orders with the versions valid at order time",
}


class Pipeline:
    """Tables live at ``base/<layer>/<table>``; ``base`` must be shared by all executors."""

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        base: str,
        buckets: int = 256,
        now: datetime | str | None = None,
        history: Mapping[str, str] | None = None,
        gates: Mapping[str, Gate] | None = None,
        from_changes: bool = False,
    ) -> None:
        """``history``: parquet folders by source folder, taken in once before anything else.

        ``gates``: conditions on whole tables by name, in place of ``rules.GATES``.

        ``from_changes``: the daily revenue is kept up to date from the changes of each run instead of
        being recomputed from all orders. It has to be set from a base's first run on.
        """
        self.spark = spark
        self.landing = landing
        self.base = base
        self.buckets = buckets
        self.now = now
        self.history = dict(history or {})
        self.gates = rules.GATES if gates is None else gates
        self.from_changes = from_changes
        # Rows and rule violations of the latest run, per source folder and per mart.
        self.quality: dict[str, dict[str, int]] = {}
        self.closed: list[GateClosed] = []

    def run(self) -> None:
        self.ingest()
        self.refine()
        self.publish()

    def path(self, name: str) -> str:
        layer, table = name.split(".")
        return f"{self.base}/{layer}/{table}"

    def state(self, *parts: str) -> str:
        return "/".join([self.base, "_state", *parts])

    def ingest(self) -> None:
        """New files of every source. A failing source does not stop the others."""
        self._each(self._ingest)

    def _ingest(self, entity: Entity) -> None:
        target = self.path(f"bronze.{entity.ingested}")
        state = self.state("ingest", entity.folder)
        if entity.folder in self.history:
            backfill(self.spark, self.history[entity.folder], target, state)
        ingest_csv_evolving(
            self.spark, f"{self.landing}/{entity.folder}", target, state, entity.infer
        )

    def refine(self) -> None:
        """New ingested rows through stage and rules into the version tables."""
        self._each(self._refine)

    def _refine(self, entity: Entity) -> None:
        table, ingested = self.path(f"bronze.{entity.ingested}"), self.state("ingest", entity.folder)
        raw = stream_ingested(self.spark, table, state=ingested)
        staged = apply_expectations(entity.stage(raw, self.now), entity.rules, entity.folder)
        log = self.path(f"silver.{entity.versioned}_changes")
        state = self.state("log", entity.folder)
        self.quality[entity.folder] = counted_run(
            self.spark,
            entity.folder,
            lambda: log_changes(staged, log, state, entity.key, self.buckets, hot=None),
        )
        refresh_versions(
            self.spark,
            log,
            self.path(f"silver.{entity.versioned}"),
            self.state("versions", entity.folder),
            entity.key,
            entity.delete,
            changed=self._changed(entity),
        )

    def _changed(self, entity: Entity) -> Changed | None:
        if not self.from_changes or entity.versioned != "silver_orders":
            return None
        return maintained.DAILY_REVENUE.record(self.state("daily_revenue"))

    def maintain(self) -> None:
        """Gathers the change logs and folds superseded versions; for the time between runs."""
        for entity in ENTITIES:
            gather_log(self.spark, self.path(f"silver.{entity.versioned}_changes"))
            fold_versions(self.spark, self.path(f"silver.{entity.versioned}"), entity.key)
        if self.from_changes:
            maintained.DAILY_REVENUE.fold(self.spark, self.state("daily_revenue"))

    def _each(self, step: Callable[[Entity], None]) -> None:
        failures: dict[str, Exception] = {}
        with ThreadPoolExecutor(len(ENTITIES)) as pool:
            running = {entity.folder: pool.submit(step, entity) for entity in ENTITIES}
        for folder, outcome in running.items():
            if error := outcome.exception():
                failures[folder] = error
        if failures:
            names = ", ".join(failures)
            raise RuntimeError(f"failed sources: {names}") from next(iter(failures.values()))

    def versions(self, table: str, only_open: bool = False) -> DataFrame:
        return read_versions(self.spark, self.path(f"silver.{table}"), only_open)

    def read(self, name: str) -> DataFrame:
        """A published fact or mart."""
        return read_table(self.spark, self.path(name))

    def publish(self) -> None:
        """Facts and marts from the version tables.

        Every table with an open gate is published; closed gates are raised together at the end.
        """
        self.closed = []
        self._publish()
        if self.closed:
            raise ExceptionGroup("closed gates", self.closed)

    def _publish(self) -> None:
        orders = current(self.versions("silver_orders", only_open=True))
        customers = self.versions("silver_customers")
        products = self.versions("silver_products")
        order_hot = {key: hot_keys(orders, key) for key in ("customer_id", "product_id")}
        pit_hot = {
            "customer_id": merge_hot(order_hot["customer_id"], hot_keys(customers, "customer_id")),
            "product_id": merge_hot(order_hot["product_id"], hot_keys(products, "product_id")),
        }
        dimensions = [
            current(self.versions(table, only_open=True))
            for table in ("silver_customers", "silver_products")
        ]

        by_customer = self._save(
            "silver.silver_order_customer_fact",
            facts.order_customer_fact(orders, dimensions[0], self.now, order_hot),
        )
        by_product = self._save(
            "silver.silver_order_customer_product_fact",
            facts.order_customer_product_fact(orders, *dimensions, self.now, order_hot),
        )
        # Facts over current versions hold each order once.
        if self.from_changes:
            daily = maintained.daily_revenue(self.spark, self.state("daily_revenue"))
        else:
            daily = marts.daily_revenue(by_customer, unique_orders=True)
        self._save("gold.gold_daily_revenue", daily, rules.DAILY_REVENUE)
        self._save(
            "gold.gold_customer_360",
            marts.customer_360(dimensions[0], by_customer, self.now, unique_orders=True),
        )
        self._save("gold.gold_top_products", marts.top_products(by_product, unique_orders=True))
        self._save(
            "gold.gold_executive_kpis", marts.executive_kpis(by_product, self.now, unique_orders=True)
        )
        self._save(
            "gold.gold_order_customer_product_pit_fact",
            facts.pit_fact(orders, customers, products, self.now, pit_hot),
            rules.PIT_FACT,
        )

    def _save(self, name: str, df: DataFrame, rule_set: Rules | None = None) -> DataFrame:
        """A closed gate leaves this table as it was and does not stop the others."""
        seen = Observation(name) if rule_set is not None else None
        # Rules and gate are counted while the rows are written, without another scan.
        checked = df if rule_set is None else apply_expectations(df, rule_set, seen)
        try:
            table = publish_table(checked, self.path(name), name, self.gates.get(name), self.now)
        except GateClosed as closed:
            self.closed.append(closed)
            table = df
        if seen is not None:
            self.quality[name] = seen.get
        return table

    def register(self, properties: Mapping[str, str] | None = None) -> None:
        """Catalog entries: views over all flows of ingested tables and over the versions without
        delete changes and helper columns, tables for facts and marts as last published."""
        extra = dict(properties or {})
        for entity in ENTITIES:
            name = f"bronze.{entity.ingested}"
            query = self._ingested_query(entity)
            register_view(self.spark, name, query, COMMENTS[name], {"layer": "bronze", **extra})
            name = f"silver.{entity.versioned}"
            query = versions_query(self.spark, self.path(name))
            comment = f"Versions per {entity.key}"
            register_view(self.spark, name, query, comment, {"layer": "silver", **extra})
        for name, comment in COMMENTS.items():
            layer = name.split(".")[0]
            if layer != "bronze":
                path = table_path(self.spark, self.path(name))
                register_table(self.spark, name, path, comment, {"layer": layer, **extra})

    def _ingested_query(self, entity: Entity) -> str:
        """A catalog table per flow, and the query that unites them under the stored schema."""
        table = self.path(f"bronze.{entity.ingested}")
        schema = table_schema(self.spark, table, self.state("ingest", entity.folder))
        parts = []
        for flow, path in flow_paths(self.spark, table).items():
            have = flow_schema(self.spark, flow, path, schema)
            name = f"bronze.{entity.ingested}_{flow}"
            batch = "batch" if flow == FILES else None
            register_table(self.spark, name, path, f"Flow {flow}", schema=have, partition=batch)
            parts.append(f"SELECT {', '.join(conform(flow, have, schema))} FROM {name}")
        return " UNION ALL ".join(parts)
