"""Disk that a job of many runs gives back on the way."""

import time

import pytest
from pyspark.sql import functions as F

from shopledger.functions.cleaning import key_from_parts, key_parts, version_key
from shopledger.session import FREED, freeing, stored_once
from shopledger.streaming.versioned import (
    log_changes,
    read_versions,
    rebuild_versions,
    refresh_versions,
)
from workload.catalog import _logged_ties

SHAPE = (
    "order_sk string, order_id string, v int, _event_ts timestamp, _ingest_ts timestamp,"
    " _file_mod_time timestamp, _source_file string"
)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = manager.diskBlockManager().getAllFiles().mkString(" ")
    return files.count("shuffle_")


def changes(spark, drop=0):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 9)
    columns = {
        "order_sk": F.lit(""),
        "order_id": F.when(F.col("id") % 11 > 0, F.concat(F.lit("o"), F.col("id") % 40)),
        "v": (F.col("id") + drop).cast("int"),
        "_event_ts": F.when(F.col("id") % 7 > 0, at),
        "_ingest_ts": at,
        "_file_mod_time": at,
        # Many changes of one key and sequence that differ in content.
        "_source_file": F.when(F.col("id") % 5 > 0, F.lit("f")),
    }
    rows = spark.range(600).withColumns(columns).drop("id")
    return rows.withColumn("order_sk", version_key("order_id"))


def run(spark, base, drops, sk=None):
    for drop in drops:
        drop.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(drop.schema).parquet(f"{base}/landing")
        log_changes(stream, f"{base}/log", f"{base}/state/log", "order_id", 3)
        ties = _logged_ties(drop.columns, sk)
        refresh_versions(
            spark, f"{base}/log", f"{base}/table", f"{base}/state/table", "order_id", ties=ties
        )
    rebuild_versions(spark, f"{base}/log", f"{base}/rebuilt", "order_id", ties=ties)
    return read_versions(spark, f"{base}/table"), read_versions(spark, f"{base}/rebuilt")


def test_runs_give_their_shuffles_back(spark, tmp_path):
    # A drop, and another that makes every key late.
    drops = [changes(spark), changes(spark, 1).withColumn("_event_ts", F.lit(None).cast("timestamp"))]
    before = spark.conf.get(FREED)
    start = shuffle_files(spark)
    run(spark, str(tmp_path), drops)
    until = time.time() + 20
    while (left := shuffle_files(spark)) > start and time.time() < until:
        time.sleep(0.5)
    assert left <= start
    assert spark.conf.get(FREED) == before


def test_freeing_may_be_nested_and_ends_with_an_error(spark):
    before = spark.conf.get(FREED)
    with pytest.raises(ValueError), freeing(spark):
        with freeing(spark):
            pass
        assert spark.conf.get(FREED) == "true"
        raise ValueError
    assert spark.conf.get(FREED) == before


def test_stored_once_is_removed(spark, rows_of):
    df = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    with stored_once(df) as kept:
        assert rows_of(kept) == rows_of(df) and kept.schema == df.schema
        (file, *_) = kept.inputFiles()
    files = spark.sparkContext._jvm.java.io.File(file.removeprefix("file:"))
    assert not files.exists()


def test_stored_parts_of_a_key_choose_the_same_rows(spark, tmp_path, rows_of):
    drops = [changes(spark), changes(spark, 1)]
    narrow = [drop.withColumn("order_sk", key_parts()) for drop in drops]
    for whole, parts in zip(
        run(spark, f"{tmp_path}/whole", drops), run(spark, f"{tmp_path}/parts", narrow, "order_sk")
    ):
        made = parts.withColumn("order_sk", key_from_parts("order_id", "order_sk"))
        assert made.columns == whole.columns and whole.count() > 0
        assert rows_of(made) == rows_of(whole)
