import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopledger.operators.history import (
    current,
    current_from_changes,
    keep_latest,
    overlaps,
    version_all,
    versions,
)
from shopledger.session import scratch_path
from shopledger.streaming import versioned
from shopledger.streaming.versioned import log_changes, read_versions, refresh_versions

SCHEMA = (
    "k string, op string, v int, _event_ts timestamp, _ingest_ts timestamp,"
    " _file_mod_time timestamp, _source_file string"
)
DELETE = "op = 'DELETE'"


def day(n):
    return None if n is None else datetime(2024, 1, n)


def changes(spark, rows):
    """Rows of (key, operation, value, event day, ingest day, file)."""
    full = [(k, op, v, day(e), day(i), day(i), f) for k, op, v, e, i, f in rows]
    return spark.createDataFrame(full, SCHEMA)


def spans(df):
    """(key, value, event day of start, event day of end)."""
    found = df.select(
        "k", "v", F.dayofmonth("__START_AT._event_ts"), F.dayofmonth("__END_AT._event_ts"),
        F.col("__END_AT").isNull(),
    ).collect()
    return sorted([(k, v, s, "open" if is_open else e) for k, v, s, e, is_open in found], key=repr)


def brute_force(rows):
    """Versions by a loop over sorted changes; NULL event times come first."""
    by_key = {}
    for k, op, v, e, i, f in rows:
        if k is not None:
            by_key.setdefault(k, {})[(e is not None, e or 0, i, f)] = (op, v, e)
    out = []
    for k, entries in by_key.items():
        ordered = [entries[s] for s in sorted(entries)]
        for (op, v, e), after in zip(ordered, [*ordered[1:], None]):
            if op != "DELETE":
                out.append((k, v, e, "open" if after is None else after[2]))
    return sorted(out, key=repr)


def test_update_delete_reopen(spark):
    rows = [
        ("a", "DELETE", 0, 1, 1, "f"),  # nothing to close
        ("a", "UPDATE", 1, 2, 2, "f"),  # opens although never inserted
        ("a", "UPDATE", 2, 4, 4, "f"),
        ("a", "DELETE", 0, 6, 6, "f"),
        ("a", "INSERT", 3, 9, 9, "f"),
        ("b", "INSERT", 4, 3, 3, "f"),
        ("b", "DELETE", 0, 5, 5, "f"),
    ]
    got = versions(changes(spark, rows), "k", DELETE)
    assert spans(got) == [("a", 1, 2, 4), ("a", 2, 4, 6), ("a", 3, 9, "open"), ("b", 4, 3, 5)]
    assert [r.k for r in current(got).collect()] == ["a"]


def test_equal_attributes_still_make_versions(spark):
    rows = [("a", "I", 1, 1, 1, "f"), ("a", "I", 1, 2, 2, "f")]
    assert len(spans(versions(changes(spark, rows), "k"))) == 2


def test_ties_in_event_time_follow_ingest_then_file(spark):
    rows = [("a", "I", 1, 5, 7, "f2"), ("a", "I", 2, 5, 6, "f9"), ("a", "I", 3, 5, 7, "f1")]
    got = versions(changes(spark, rows), "k").orderBy("__START_AT").collect()
    assert [r.v for r in got] == [2, 3, 1]


def test_null_event_time_sorts_first_and_null_key_is_left_out(spark):
    rows = [("a", "I", 1, 1, 1, "f"), ("a", "I", 2, None, 9, "f"), (None, "I", 3, 1, 1, "f")]
    assert spans(versions(changes(spark, rows), "k")) == [("a", 1, 1, "open"), ("a", 2, None, 1)]


def test_null_delete_condition_is_no_delete(spark):
    rows = [("a", None, 1, 1, 1, "f")]
    assert spans(versions(changes(spark, rows), "k", DELETE)) == [("a", 1, 1, "open")]


@pytest.mark.parametrize("hot", [None, {"a": 3}])
def test_same_sequence_keeps_one_row_whatever_the_order(spark, hot):
    rows = [("a", "I", v, 1, 1, "f") for v in range(20)] + [("a", "I", 99, 2, 2, "f")]
    first = spans(versions(changes(spark, rows), "k", hot=hot))
    again = spans(versions(changes(spark, rows[::-1]), "k", hot=hot))
    assert first == again and len(first) == 2
    assert first == spans(versions(changes(spark, rows), "k"))


def test_hot_keys_change_the_plan_not_the_result(spark):
    random.seed(1)
    rows = [
        (random.choice(["big", "big", f"k{i % 40}"]), random.choice(["I", "DELETE"]), i,
         random.randrange(1, 28), random.randrange(1, 4), f"f{i}")
        for i in range(600)
    ]
    df = changes(spark, rows)
    plain, split = versions(df, "k", DELETE), versions(df, "k", DELETE, {"big": 7})
    assert spans(plain) == spans(split) == brute_force(rows)
    assert plain.columns == split.columns


def test_current_from_changes_equals_current_versions(spark, rows_of):
    random.seed(2)
    rows = [
        (f"k{random.randrange(30)}", random.choice(["I", "I", "DELETE"]), i,
         random.randrange(1, 28), 1, f"f{i}")
        for i in range(300)
    ]
    df = changes(spark, rows)
    short, long = current_from_changes(df, "k", DELETE), current(versions(df, "k", DELETE))
    assert short.columns == long.columns
    assert rows_of(short) == rows_of(long)


def test_keep_latest(spark):
    rows = [("a", "I", 1, 1, 1, "f"), ("a", "I", 2, 1, 2, "f"), ("a", "I", 3, 2, 1, "f")]
    got = keep_latest(changes(spark, rows), ["k", "_event_ts"], ["_ingest_ts", "_source_file"])
    assert sorted((r.v, r._record_number) for r in got.collect()) == [(2, 1), (3, 1)]


@pytest.mark.parametrize("hot", [None, {"a": 2}])
def test_overlaps_found(spark, hot):
    rows = [("a", "I", 1, 1, 1, "f"), ("a", "I", 2, 3, 3, "f"), ("a", "I", 3, 5, 5, "f")]
    good = versions(changes(spark, rows), "k")
    assert overlaps(good, "k", hot).count() == 0
    bad = good.withColumn("__END_AT", F.when(F.col("v") != 1, F.col("__END_AT")))
    assert [r.v for r in overlaps(bad, "k", hot).collect()] == [1]


change_lists = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from(["INSERT", "UPDATE", "DELETE"]),
        st.integers(0, 5),
        st.one_of(st.none(), st.integers(1, 6)),
        st.integers(1, 3),
    ),
    min_size=1,
    max_size=14,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(change_lists, st.randoms())
def test_any_arrival_order_gives_the_same_versions(spark, listed, rng):
    rows = [(*row, f"f{i}") for i, row in enumerate(listed)]
    mixed = rows[:]
    rng.shuffle(mixed)
    assert spans(versions(changes(spark, mixed), "k", DELETE)) == brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_in_any_batches_equals_batch(spark, seed):
    """Random drops, out of order and with repeats; hot keys split from three rows on."""
    rng = random.Random(seed)
    rows = [
        (rng.choice(["big", f"k{rng.randrange(6)}", None]), rng.choice(["I", "I", "DELETE"]), i,
         rng.randrange(1, 28), rng.randrange(1, 3), f"f{i}")
        for i in range(60)
    ]
    shuffled = rows + rows[:10]
    rng.shuffle(shuffled)
    base = scratch_path(spark, "test-stream")
    cuts = sorted(rng.sample(range(1, len(shuffled)), 2))
    for drop in (shuffled[: cuts[0]], shuffled[cuts[0] : cuts[1]], shuffled[cuts[1] :]):
        changes(spark, drop).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(changes(spark, []).schema).parquet(f"{base}/landing")
        log_changes(stream, f"{base}/log", f"{base}/s/log", "k", buckets=2)
        refresh_versions(
            spark, f"{base}/log", f"{base}/table", f"{base}/s/table", "k", DELETE, group_rows=3
        )
    assert spans(read_versions(spark, f"{base}/table")) == brute_force(rows)


def test_bucket_left_with_deletes_only_is_cleared(spark):
    """A delete replacing a change of the same sequence must also replace the stored version."""
    base = scratch_path(spark, "test-clear")
    version, delete = ("a", "I", 1, 1, 1, "f"), ("a", "DELETE", 0, 1, 1, "f")
    both = changes(spark, [version, delete])
    kept = version_all(both, "k", DELETE).collect()[0]
    for row in (version, delete) if kept._deleted else (delete, version):
        changes(spark, [row]).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(both.schema).parquet(f"{base}/landing")
        log_changes(stream, f"{base}/log", f"{base}/s/log", "k", buckets=2)
        refresh_versions(spark, f"{base}/log", f"{base}/table", f"{base}/s/table", "k", DELETE)
    assert read_versions(spark, f"{base}/table").count() == (0 if kept._deleted else 1)


def test_no_change_touches_files_of_ended_versions(spark, tmp_path):
    """Changes in order append what ended, and a late key's new history supersedes its old rows."""
    base = str(tmp_path)

    def drop(rows):
        changes(spark, rows).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(changes(spark, []).schema).parquet(f"{base}/landing")
        log_changes(stream, f"{base}/log", f"{base}/s/log", "k", buckets=4)
        refresh_versions(spark, f"{base}/log", f"{base}/table", f"{base}/s/table", "k", DELETE)
        return {(p, p.stat().st_mtime_ns) for p in tmp_path.glob("table/*/_open=0/*.parquet")}

    keys = [f"k{i}" for i in range(12)]
    rows = [[(k, "I", d, d, d, f"{k}-{d}") for k in keys for d in days] for days in ((3, 4), (6, 7))]
    first, second = drop(rows[0]), drop(rows[1])
    assert first and first < second
    assert spans(read_versions(spark, f"{base}/table")) == brute_force(rows[0] + rows[1])
    late = [("k0", "I", 5, 5, 5, "k0-5")]
    third = drop(late)
    assert second < third
    stored = read_versions(spark, f"{base}/table")
    assert spans(stored) == brute_force(rows[0] + rows[1] + late)
    now = read_versions(spark, f"{base}/table", only_open=True)
    assert spans(now) == spans(current(stored)) and now.count() == len(keys)


@pytest.mark.parametrize("fails_at", [0, 1])
def test_a_failed_later_refresh_is_repeated(spark, monkeypatch, fails_at):
    """Ended versions are appended before the open ones are replaced; a repeat must not double them."""
    base = scratch_path(spark, "test-again")
    rows = [[("a", "I", 1, 1, 1, "f"), ("b", "I", 2, 1, 1, "g")], [("a", "I", 3, 5, 5, "f")]]
    refresh = (spark, f"{base}/log", f"{base}/table", f"{base}/s/table", "k", DELETE)

    def land(part):
        changes(spark, part).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(changes(spark, []).schema).parquet(f"{base}/landing")
        log_changes(stream, f"{base}/log", f"{base}/s/log", "k", buckets=1)

    land(rows[0])
    refresh_versions(*refresh)
    land(rows[1])
    name = ("replace_partitions", "append_partitions")[fails_at]
    write = getattr(versioned, name)

    def broken(*args):
        write(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(versioned, name, broken)
    with pytest.raises(Exception, match="lost"):
        refresh_versions(*refresh)
    monkeypatch.setattr(versioned, name, write)
    refresh_versions(*refresh)
    assert spans(read_versions(spark, f"{base}/table")) == brute_force(rows[0] + rows[1])


@pytest.mark.parametrize("after_write", [False, True])
def test_a_failed_refresh_is_repeated(spark, monkeypatch, after_write):
    base = scratch_path(spark, "test-retry")
    rows = [("a", "I", 1, 3, 3, "f"), ("b", "I", 2, 4, 4, "f"), ("a", "DELETE", 0, 9, 9, "f")]
    changes(spark, rows).write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(changes(spark, []).schema).parquet(f"{base}/landing")
    log_changes(stream, f"{base}/log", f"{base}/s/log", "k", buckets=2)
    write = versioned.replace_partitions

    def broken(*args):
        if after_write:
            write(*args)
        raise RuntimeError("lost")

    refresh = (spark, f"{base}/log", f"{base}/table", f"{base}/s/table", "k", DELETE)
    monkeypatch.setattr(versioned, "replace_partitions", broken)
    with pytest.raises(Exception, match="lost"):
        refresh_versions(*refresh)
    monkeypatch.setattr(versioned, "replace_partitions", write)
    refresh_versions(*refresh)
    assert spans(read_versions(spark, f"{base}/table")) == brute_force(rows)


def test_rows_of_a_hot_or_missing_key_get_several_writers(spark, tmp_path):
    # Small partitions would be joined again.
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    for name, key in (("hot", "'k'"), ("none", "NULL")):
        rows = spark.range(4000, numPartitions=8).selectExpr(f"cast({key} as string) k", "id")
        rows.write.parquet(f"{tmp_path}/{name}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/{name}/in")
        log_changes(stream, f"{tmp_path}/{name}/log", f"{tmp_path}/{name}/s", "k", buckets=64, hot=["k"])
        log = spark.read.parquet(f"{tmp_path}/{name}/log")
        assert log.count() == 4000 and len(log.inputFiles()) > 1
    spark.conf.set(coalesce, "true")
