"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is run to completion into a sink that discards its rows. One untimed run of the first
query starts the JVM's compilers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopledger.session import build_session  # noqa: E402
from workload.catalog import queries  # noqa: E402

HEADLINE = [
    "stage_orders",
    "scd2_orders",
    "scd2_products",
    "dedup_orders_latest",
    "fact_order_customer",
    "fact_order_customer_product",
    "pit_fact",
    "mart_daily_revenue",
    "mart_customer_360",
    "mart_top_products",
    "mart_executive_kpis",
    "pit_revenue_by_tier",
    "dq_report",
    "stream_ingest_csv",
    "stream_scd2_deletes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}

    def run(name: str) -> None:
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run(names[0])
    for name in names:
        started = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
