"""Gates before publishing, and versions covered by earlier ones."""

import pytest
from pyspark.sql import functions as F
from test_history import changes, day
from test_pipeline import NOW, ORDERS, drop, first_drops

from shopledger.operators.history import SEQUENCE, covered, versions
from shopledger.plans import rules
from shopledger.plans.gates import DUPLICATES, Gate, GateClosed, publish_table
from shopledger.plans.pipeline import Pipeline
from shopledger.sources.tables import read_table

GATE = Gate(
    measures={"total": "count(*)", "worst": "min(v)"},
    conditions={"some_rows": "total > 0", "positive": "worst > 0"},
    unique=("k",),
)


def mart(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int")


@pytest.mark.parametrize(
    "rows, broken",
    [
        ([("a", 1), ("b", -2)], ["positive"]),
        ([], ["some_rows", "positive"]),
        ([("a", 1), ("a", 2)], [DUPLICATES]),
        ([(None, 1), (None, 0)], ["positive", DUPLICATES]),
    ],
)
def test_a_closed_gate_keeps_the_old_content(spark, tmp_path, rows, broken):
    path = str(tmp_path / "mart")
    publish_table(mart(spark, ("a", 1)), path, "mart", GATE)
    with pytest.raises(GateClosed) as closed:
        publish_table(mart(spark, *rows), path, "mart", GATE)
    assert closed.value.broken == broken and closed.value.table == "mart"
    assert [tuple(r) for r in read_table(spark, path).collect()] == [("a", 1)]
    publish_table(mart(spark, ("b", 3)), path, "mart", GATE)
    assert [tuple(r) for r in read_table(spark, path).collect()] == [("b", 3)]


def test_freshness_and_missing_shares(spark, tmp_path):
    rows = spark.sql(
        "SELECT cast(id as string) order_id, 'c' customer_id, 'p' product_id, 1 quantity, 2D order_unit_price,"
        " if(id < 2, NULL, 'x') customer_sk, 'y' product_sk, timestamp '2025-01-01 00:00:00' _gold_load_ts"
        " FROM range(10)"
    )
    gate = rules.pit_gate(missing_share=0.2, max_hours=24)
    publish_table(rows, f"{tmp_path}/a", "pit", gate, "2025-01-01 12:00:00")
    for broken, tighter, now in (
        (["customer_versions"], rules.pit_gate(0.1, 24), "2025-01-01 12:00:00"),
        (["fresh"], gate, "2025-01-03 00:00:00"),
    ):
        with pytest.raises(GateClosed) as closed:
            publish_table(rows, f"{tmp_path}/a", "pit", tighter, now)
        assert closed.value.broken == broken
    publish_table(rows.limit(0), f"{tmp_path}/a", "pit", gate, "2025-01-03 00:00:00")


def test_a_closed_gate_stops_one_mart_only(spark, tmp_path):
    strict = {"gold.gold_order_customer_product_pit_fact": rules.pit_gate(missing_share=0.4)}
    pipeline = Pipeline(spark, str(tmp_path / "landing"), str(tmp_path / "base"), 4, NOW, gates=strict)
    first_drops(pipeline.landing)
    # One of two lines has no product version at its time, so the mart is not published at all.
    with pytest.raises(ExceptionGroup) as closed:
        pipeline.run()
    (gate,) = closed.value.exceptions
    assert gate.broken == ["product_versions"] and gate.found["missing_product"] == 1
    with pytest.raises(FileNotFoundError):
        pipeline.read("gold.gold_order_customer_product_pit_fact")
    assert pipeline.read("gold.gold_daily_revenue").count() == 2
    drop(
        pipeline.landing, "orders", "o2.csv", ORDERS,
        "DE,CUST-1,2024-08-02,ORD-5,completed,upi,PROD-1,2,Pune,600.0",
    )
    pipeline.run()
    assert pipeline.read("gold.gold_order_customer_product_pit_fact").count() == 3
    pipeline.maintain()
    assert pipeline.versions("silver_orders").count() == 3


@pytest.mark.parametrize("hot", [None, {"a": 3}])
def test_a_long_version_covers_several_later_ones(spark, hot):
    rows = [("a", "I", i, i, i, "f") for i in range(1, 9)] + [("b", "I", i, i, i, "f") for i in (1, 2)]
    good = versions(changes(spark, rows), "k")
    assert covered(good, "k", hot).count() == 0
    # Version 2 ends with version 6 only, and version 7 never.
    late = F.struct(*[F.lit(day(7)).alias(n) for n in SEQUENCE[:3]], F.lit("f").alias(SEQUENCE[3]))
    end = F.when((F.col("k") == "a") & (F.col("v") == 2), late)
    end = end.when((F.col("k") == "a") & (F.col("v") == 7), None).otherwise(F.col("__END_AT"))
    found = covered(good.withColumn("__END_AT", end), "k", hot)
    got = sorted((r.k, r.v, r._covered_until.never) for r in found.collect())
    assert got == [("a", 3, False), ("a", 4, False), ("a", 5, False), ("a", 6, False), ("a", 8, True)]
