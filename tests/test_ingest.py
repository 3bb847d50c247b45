import gzip
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.operators.expectations import apply_expectations
from shopledger.plans.pipeline import ENTITIES, Pipeline
from shopledger.sources.files import read_schema, wider, write_csv
from shopledger.sources.tables import register_view
from shopledger.streaming import ingest
from shopledger.streaming.ingest import (
    append_stream,
    backfill,
    counted_run,
    ingest_csv,
    ingest_csv_evolving,
    read_evolving,
    read_ingested,
    stream_ingested,
)


def drop(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as file:
        file.write(text)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "state")


def test_each_file_once_with_lineage_all_text(spark, paths):
    landing, table, state = paths
    drop(landing, "a.csv", "id,qty\n1,007\n2,x\n")
    ingest_csv(spark, landing, table, state)
    drop(landing, "b.csv", "id,qty\n3,9\n")
    for _ in range(2):
        ingest_csv(spark, landing, table, state, files_per_batch=1)
    got = read_ingested(spark, table)
    assert got.columns == ["id", "qty", "_ingest_ts", "_file_mod_time", "_source_file"]
    rows = sorted((r.id, r.qty, os.path.basename(r._source_file)) for r in got.collect())
    assert rows == [("1", "007", "a.csv"), ("2", "x", "a.csv"), ("3", "9", "b.csv")]
    assert got.filter("_ingest_ts IS NULL OR _file_mod_time IS NULL").count() == 0
    assert stream_ingested(spark, table).isStreaming


def test_a_file_of_another_layout_fails_and_loses_nothing(spark, paths):
    landing, table, state = paths
    drop(landing, "a.csv", "id,qty\n1,5\n")
    ingest_csv(spark, landing, table, state)
    drop(landing, "b.csv", "qty,id\n6,2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ingest_csv(spark, landing, table, state)
    assert read_ingested(spark, table).count() == 1


def test_inferred_types_are_kept_and_misfits_rescued(spark, paths):
    landing, table, state = paths
    drop(landing, "a.csv", "id,since,active\n1,2024-05-06,true\n")
    ingest_csv(spark, landing, table, state, infer=True)
    drop(landing, "b.csv", "id,since,active\ntwo,2024-05-07,false\n")
    ingest_csv(spark, landing, table, state, infer=True)
    stored = read_schema(spark, f"{state}/schema")
    assert [f.dataType.simpleString() for f in stored] == ["int", "date", "boolean", "string"]
    first, second = read_ingested(spark, table).orderBy("since").collect()
    assert (first.id, first.since, first.active, first._rescued_data) == (1, date(2024, 5, 6), True, None)
    assert (second.id, second.since) == (None, date(2024, 5, 7))
    assert second._rescued_data == "two,2024-05-07,false"


def test_columns_are_matched_by_name_and_added(spark, paths):
    landing, table, state = paths
    drop(landing, "a.csv", "id,qty\n1,5\n")
    ingest_csv_evolving(spark, landing, table, state)
    drop(landing, "b.csv", "colour,qty,id\nred,6,2\n")
    drop(landing, "c.csv", "qty,id\n7,3\n")
    drop(landing, "empty.csv", "")
    for _ in range(2):
        ingest_csv_evolving(spark, landing, table, state, files_per_batch=2)
    got = read_evolving(spark, table, state)
    assert got.columns[:3] == ["id", "qty", "colour"]
    rows = sorted((r.id, r.qty, r.colour) for r in got.collect())
    assert rows == [("1", "5", None), ("2", "6", "red"), ("3", "7", None)]
    assert got.filter("_source_file IS NULL").count() == 0


def test_files_are_read_once_while_their_layout_stays(spark, paths, monkeypatch):
    landing, table, state = paths
    calls = []
    real = ingest._layouts
    monkeypatch.setattr(ingest, "_layouts", lambda *a: calls.append(1) or real(*a))

    def run(name, text):
        drop(landing, name, text)
        ingest_csv_evolving(spark, landing, table, state, infer=True)
        return len(calls)

    assert run("a.csv", "id,qty\n1,5\n") == 1
    assert run("b.csv", "id,qty\n2,6\n3,7\n") == 1
    assert run("c.csv", "qty,id\n8,4\n") == 2  # another order: looked through
    drop(landing, "e.csv", "")
    assert run("d.csv", "id,qty\n5,9\n") == 3
    rows = sorted((r.id, r.qty) for r in read_ingested(spark, table, state).collect())
    assert rows == [(1, 5), (2, 6), (3, 7), (4, 8), (5, 9)]


def test_files_of_any_name_are_ingested(spark, paths):
    landing, table, state = paths
    drop(landing, "a.csv", "id,qty\n1,1\n")
    drop(landing, "b.CSV", "id,qty\n2,1\n")
    drop(landing, "part-0003", "id,qty\n3,1\n")
    with gzip.open(os.path.join(landing, "d.csv.gz"), "wt") as file:
        file.write("id,qty\n4,1\n")
    drop(landing, "_SUCCESS", "")
    drop(landing, ".hidden.csv", "id,qty\n9,1\n")
    ingest_csv_evolving(spark, landing, table, state)
    assert sorted(r.id for r in read_evolving(spark, table, state).collect()) == ["1", "2", "3", "4"]


def test_backfill_once_beside_new_files(spark, paths, tmp_path):
    landing, table, state = paths
    history = str(tmp_path / "history")
    spark.createDataFrame([("1", "old")], "id string, v string").write.parquet(history)
    drop(landing, "a.csv", "id,v\n2,new\n")
    for _ in range(2):
        backfill(spark, history, table, state)
        ingest_csv(spark, landing, table, state)
    assert sorted(r.id for r in read_ingested(spark, table).collect()) == ["1", "2"]


def test_csv_file_count(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(100).repartition(5), path, files=2)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 2
    assert spark.read.option("header", True).csv(path).count() == 100


def test_rules_on_a_stream(spark, paths):
    landing, table, state = paths
    drop(landing, "a.csv", "id,qty\n1,5\n,6\n3,-1\n")
    ingest_csv(spark, landing, table, state)
    checked = apply_expectations(
        stream_ingested(spark, table),
        {"expect": {"has_id": "id IS NOT NULL"}, "expect_or_drop": {"positive": "qty > 0"}},
        "checked",
    )
    writer = checked.writeStream.format("parquet").trigger(availableNow=True)
    stream = writer.option("path", f"{table}-out").option("checkpointLocation", f"{state}-out").start()
    stream.awaitTermination()
    assert spark.read.parquet(f"{table}-out").count() == 2
    seen = [p.observedMetrics["checked"] for p in stream.recentProgress if p.observedMetrics]
    assert (seen[0]["rows"], seen[0].has_id, seen[0].positive) == (3, 1, 1)


def test_every_micro_batch_is_counted(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    for i in range(130):
        with open(f"{tmp_path}/in/{i:03}.csv", "w") as file:
            file.write(f"id\n{i}\n")
    reader = spark.readStream.schema("id long").option("header", True).option("maxFilesPerTrigger", 1)
    seen = reader.csv(f"{tmp_path}/in").observe("drops", F.count(F.lit(1)).alias("rows"))
    run = lambda: append_stream(seen, f"{tmp_path}/out", f"{tmp_path}/state")
    assert counted_run(spark, "drops", run) == {"rows": 130}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 130


def test_evolved_columns_survive_every_reader(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    spark.createDataFrame([("a", 1)], "id string, qty int").write.option("header", True).csv(f"{landing}/1")
    ingest_csv_evolving(spark, f"{landing}/*", table, state, infer=True)
    more = spark.createDataFrame([("red", "b", 2)], "colour string, id string, qty int")
    more.write.option("header", True).csv(f"{landing}/2")
    ingest_csv_evolving(spark, f"{landing}/*", table, state, infer=True)
    got = read_ingested(spark, table, state)
    assert "batch" not in got.columns and dict(got.dtypes)["qty"] == "int"
    assert sorted(map(tuple, got.select("id", "qty", "colour").collect())) == [("a", 1, None), ("b", 2, "red")]
    append_stream(stream_ingested(spark, table, state=state), f"{tmp_path}/copy", f"{tmp_path}/copy_state")
    assert spark.read.parquet(f"{tmp_path}/copy").filter("colour = 'red'").count() == 1


# ---- widened types -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "kept, found, want",
    [
        ("int", "int", None), ("int", "double", "double"), ("double", "int", None), ("int", "bigint", "bigint"),
        ("bigint", "double", "double"), ("string", "int", None), ("int", "string", "string"),
        ("date", "timestamp", "timestamp"), ("timestamp", "date", None), ("int", "date", "string"),
        ("boolean", "int", "string"),
    ],
)
def test_lattice(kept, found, want):
    assert wider(kept, found) == want


def test_a_drop_with_decimals_widens_an_integer_column(spark, paths):
    landing, table, state = paths

    def land(name, text):
        drop(landing, name, text)
        ingest_csv_evolving(spark, landing, table, state, infer=True)
        got = read_ingested(spark, table, state)
        return dict(got.dtypes), sorted((r.id, r.qty, r.day) for r in got.selectExpr("id", "qty", "cast(day as string) day").collect())

    types, rows = land("a.csv", "id,qty,day\n1,5,2024-01-01\n2,6,2024-01-02\n")
    assert (types["qty"], types["day"]) == ("int", "date")
    # One stray word: rescued, and the column stays a number.
    types, rows = land("b.csv", "id,qty,day\n3,many,2024-01-03\n4,8,2024-01-03\n5,9,2024-01-03\n")
    assert types["qty"] == "int" and rows[2] == (3, None, "2024-01-03")
    # Decimals, in another column order and behind a quoted comma: read in full.
    types, rows = land("c.csv", 'day,note,qty,id\n2024-01-04,"a,b",1.25,6\n2024-01-05,c,7,7\n')
    assert types["qty"] == "double"
    assert rows[5:] == [(6, 1.25, "2024-01-04"), (7, 7.0, "2024-01-05")]
    assert rows[:2] == [(1, 5.0, "2024-01-01"), (2, 6.0, "2024-01-02")] and rows[2][1] is None
    # Times in a date column, and numbers too large for an integer in the ids.
    types, rows = land("d.csv", "id,qty,day\n9000000000,2.5,2024-01-06 10:00:00\n")
    assert (types["id"], types["day"]) == ("bigint", "timestamp")
    assert rows[-1] == (9000000000, 2.5, "2024-01-06 10:00:00") and rows[0][2] == "2024-01-01 00:00:00"
    # Mostly words: text from now on, and the words of earlier drops come back.
    types, rows = land("e.csv", "id,qty,day\n10,few,2024-01-07\n11,some,2024-01-07\n12,3,2024-01-07\n")
    assert types["qty"] == "string"
    quantities = {r[0]: r[1] for r in rows}
    # What fitted the number it was stored as is shown as that number.
    assert quantities[3] == "many" and (quantities[10], quantities[12]) == ("few", "3.0")
    assert (quantities[1], quantities[6], quantities[9000000000]) == ("5", "1.25", "2.5")
    # The stream reads the same, and nothing was written twice.
    append_stream(stream_ingested(spark, table, state=state), f"{table}-copy", f"{state}-copy")
    copied = spark.read.parquet(f"{table}-copy")
    assert sorted((r.id, r.qty) for r in copied.collect()) == sorted((r[0], r[1]) for r in rows)
    assert "_rescued_header" not in copied.columns and copied.count() == 11


def test_widened_columns_in_the_pipeline(spark, tmp_path):
    landing = str(tmp_path / "landing")
    header = "brand,category,cdc_timestamp,is_active,operation,product_id,product_name,stock_quantity,unit_price"
    row = "A,Toys,2024-07-0{0} 10:00:00,true,INSERT,PROD-{0},Robot,50,{1}"
    drop(f"{landing}/products", "a.csv", "\n".join([header, row.format(1, 600), row.format(2, 20)]) + "\n")
    pipeline = Pipeline(spark, landing, str(tmp_path / "base"), buckets=2)
    (entity,) = [e for e in ENTITIES if e.folder == "products"]
    for more in (None, "\n".join([header, row.format(3, 9.99), row.format(4, 7)]) + "\n"):
        if more:
            drop(f"{landing}/products", "b.csv", more)
        pipeline._ingest(entity)
        pipeline._refine(entity)
    prices = {r.product_id: r.unit_price for r in pipeline.versions("silver_products").collect()}
    assert prices == {"PROD-1": 600.0, "PROD-2": 20.0, "PROD-3": 9.99, "PROD-4": 7.0}
    register_view(spark, "bronze.widened", pipeline._ingested_query(entity))
    shown = {r.product_id: r.unit_price for r in spark.table("bronze.widened").collect()}
    assert shown == prices
    spark.sql("DROP SCHEMA bronze CASCADE")
