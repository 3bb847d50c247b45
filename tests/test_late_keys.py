"""Version tables under late data, gathered logs and folded generations; marts kept from changes."""

import random

import pytest
from pyspark.sql import functions as F

from shopledger.operators.history import current
from shopledger.plans import maintained
from shopledger.streaming import versioned
from shopledger.streaming.versioned import (
    fold_versions,
    gather_log,
    log_changes,
    read_log,
    read_versions,
    rebuild_versions,
    refresh_versions,
    replay_versions,
    versions_query,
)
from test_history import DELETE, brute_force, changes, spans


class Table:
    """A version table fed by drops."""

    def __init__(self, spark, base, buckets=4, changed=None):
        self.spark, self.base, self.buckets, self.changed = spark, str(base), buckets, changed
        self.rows = []

    def path(self, name):
        return f"{self.base}/{name}"

    def land(self, rows):
        self.rows += rows
        changes(self.spark, rows).write.mode("append").parquet(self.path("landing"))
        schema = changes(self.spark, []).schema
        stream = self.spark.readStream.schema(schema).parquet(self.path("landing"))
        log_changes(stream, self.path("log"), self.path("s/log"), "k", self.buckets)

    def refresh(self):
        refresh_versions(
            self.spark, self.path("log"), self.path("table"), self.path("s/table"), "k", DELETE,
            changed=self.changed,
        )

    def drop(self, rows):
        self.land(rows)
        self.refresh()

    def spans(self):
        return spans(read_versions(self.spark, self.path("table")))

    def log(self):
        return sorted(map(tuple, read_log(self.spark, self.path("log")).select("k", "v").collect()), key=repr)

    def check(self):
        want = brute_force(self.rows)
        assert self.spans() == want
        now = read_versions(self.spark, self.path("table"), only_open=True)
        assert spans(now) == [v for v in want if v[3] == "open"]


def random_rows(seed, n=70, keys=7):
    rng = random.Random(seed)
    return [
        (rng.choice([*[f"k{i}" for i in range(keys)], None]), rng.choice(["I", "I", "I", "DELETE"]), i,
         rng.choice([None, *range(1, 28)]), rng.randrange(1, 3), f"f{i}")
        for i in range(n)
    ]


def files(base, part):
    return {(p, p.stat().st_mtime_ns) for p in base.glob(f"table/*/{part}/*.parquet")}


def test_a_late_key_in_every_bucket_rewrites_none(spark, tmp_path):
    table = Table(spark, tmp_path)
    keys = [f"k{i}" for i in range(40)]
    table.drop([(k, "I", d, d, d, f"{k}-{d}") for k in keys for d in (3, 6)])
    before = files(tmp_path, "_open=*")
    buckets = {p.parent.parent.name for p, _ in before}
    late, seen = [], set()
    for row in read_versions(spark, table.path("table")).select("k").distinct().collect():
        bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(row.k)), F.lit(4))).first()[0]
        if bucket not in seen:
            seen.add(bucket)
            late.append((row.k, "I", 9, 4, 4, f"{row.k}-late"))
    assert len(late) == len(buckets) == 4
    table.drop(late)
    table.check()
    after = files(tmp_path, "_open=*")
    assert before < after
    # Only the late keys' histories were written again: two old versions and the late one each.
    assert spark.read.parquet(table.path("table")).count() == 80 + 3 * 4
    fold_versions(spark, table.path("table"), "k")
    table.check()
    assert spark.read.parquet(table.path("table")).count() == 84
    fold_versions(spark, table.path("table"), "k")  # nothing left to fold
    table.check()


@pytest.mark.parametrize("seed", [3])
def test_random_drops_with_upkeep_in_between(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = random_rows(seed)
    table = Table(spark, tmp_path, buckets=2)
    for begin in range(0, len(rows), 20):
        table.drop(rows[begin : begin + 20])
        table.check()
        upkeep = rng.choice(["fold", "gather", "rebuild", "none"])
        if upkeep == "fold":
            fold_versions(spark, table.path("table"), "k")
        elif upkeep == "gather":
            gather_log(spark, table.path("log"))
        elif upkeep == "rebuild":
            rebuild_versions(spark, table.path("log"), table.path("table"), "k", DELETE)
        table.check()
    shown = spark.sql(versions_query(spark, table.path("table")))
    assert spans(shown) == brute_force(rows)


@pytest.mark.parametrize("fails_in", ["append_partitions", "_note"])
def test_a_failed_late_refresh_is_repeated(spark, tmp_path, monkeypatch, fails_in):
    table = Table(spark, tmp_path, buckets=1)
    table.drop([("a", "I", 1, 5, 5, "f"), ("b", "I", 2, 5, 5, "g"), ("a", "I", 3, 9, 9, "h")])
    table.land([("a", "I", 4, 2, 2, "i"), ("b", "I", 5, 8, 8, "j"), ("c", "I", 6, 8, 8, "k")])
    write = getattr(versioned, fails_in)

    def broken(*args):
        write(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(versioned, fails_in, broken)
    with pytest.raises(Exception, match="lost"):
        table.refresh()
    monkeypatch.setattr(versioned, fails_in, write)
    table.refresh()
    table.check()
    table.drop([("a", "DELETE", 0, 7, 7, "l")])
    table.check()


# ---- gathered logs -------------------------------------------------------------------------


def test_a_gathered_log_keeps_every_change_once(spark, tmp_path):
    table = Table(spark, tmp_path)
    rows = random_rows(9, 60)
    for begin in (0, 20, 40):
        table.drop(rows[begin : begin + 20])
    whole = table.log()
    runs = lambda: sorted(p.name for p in tmp_path.glob("log/_run=*"))
    assert len(runs()) == 3 and len(whole) == 60
    gather_log(spark, table.path("log"))
    assert runs() == [] and table.log() == whole
    more = random_rows(10, 15)
    table.drop(more)
    assert len(runs()) == 1 and len(table.log()) == 75
    table.rows = rows + more
    table.check()
    gather_log(spark, table.path("log"))
    gather_log(spark, table.path("log"))
    assert runs() == [] and len(table.log()) == 75
    rebuild_versions(spark, table.path("log"), table.path("again"), "k", DELETE)
    assert spans(read_versions(spark, table.path("again"))) == brute_force(table.rows)


@pytest.mark.parametrize("step", ["append_row", "remove_partitions"])
def test_a_failed_gathering_and_a_run_in_between(spark, tmp_path, monkeypatch, step):
    """Before it is noted as done nobody reads the gathered folder; after it, the runs are skipped."""
    table = Table(spark, tmp_path)
    first, second = random_rows(5, 30), random_rows(6, 30)
    table.drop(first)
    call = getattr(versioned, step)

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(versioned, step, broken)
    with pytest.raises(RuntimeError, match="lost"):
        gather_log(spark, table.path("log"))
    monkeypatch.setattr(versioned, step, call)
    assert len(table.log()) == 30
    table.drop(second)
    table.check()
    assert len(table.log()) == 60
    gather_log(spark, table.path("log"))
    assert len(table.log()) == 60 and not list(tmp_path.glob("log/_run=*"))
    table.drop(random_rows(7, 10))
    table.check()


def test_changes_not_taken_yet_are_not_gathered(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.drop(random_rows(1, 10))
    table.land(random_rows(2, 10))
    gather_log(spark, table.path("log"))
    assert len(list(tmp_path.glob("log/_run=*"))) == 1 and len(table.log()) == 20
    table.refresh()
    table.check()


# ---- marts from changes --------------------------------------------------------------------

COUNTS = maintained.Maintained(
    keys=("op",),
    measures=("n", "total"),
    contribute=lambda rows: rows.select("op", F.lit(1).cast("long").alias("n"), F.col("v").cast("long").alias("total")),
)


@pytest.mark.parametrize("seed", [21])
def test_maintained_sums_equal_the_full_mart(spark, tmp_path, seed):
    path = str(tmp_path / "mart")
    table = Table(spark, tmp_path, buckets=2, changed=COUNTS.record(path))
    rows = random_rows(seed, 60)
    for at, begin in enumerate(range(0, 60, 20)):
        table.drop(rows[begin : begin + 20])
        now = current(read_versions(spark, table.path("table")))
        full = now.groupBy("op").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
        got = COUNTS.read(spark, path).filter("n != 0 OR total != 0")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.select("op", "n", "total").collect()))
        if at % 2:
            COUNTS.fold(spark, path)
            COUNTS.fold(spark, path)
            got = COUNTS.read(spark, path).filter("n != 0 OR total != 0")
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.select("op", "n", "total").collect()))


@pytest.mark.parametrize("fails_in", ["_note"])
def test_a_repeated_batch_counts_once(spark, tmp_path, monkeypatch, fails_in):
    path = str(tmp_path / "mart")
    table = Table(spark, tmp_path, buckets=1, changed=COUNTS.record(path))
    table.drop([("a", "I", 1, 5, 5, "f"), ("b", "I", 2, 5, 5, "g"), ("a", "I", 3, 9, 9, "h")])
    table.land([("a", "I", 4, 2, 2, "i"), ("b", "I", 5, 8, 8, "j"), ("a", "X", 6, 12, 12, "k")])
    write = getattr(versioned, fails_in)
    def broken(*args):
        write(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(versioned, fails_in, broken)
    with pytest.raises(Exception, match="lost"):
        table.refresh()
    monkeypatch.setattr(versioned, fails_in, write)
    table.refresh()
    table.check()
    got = {r.op: (r.n, r.total) for r in COUNTS.read(spark, path).collect() if r.n}
    assert got == {"I": (1, 5), "X": (1, 6)}


def test_a_failed_fold_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    table = Table(spark, tmp_path, changed=COUNTS.record(path))
    table.drop(random_rows(30, 20))
    want = sorted(map(tuple, COUNTS.read(spark, path).collect()))

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(maintained, "remove_partitions", broken)
    with pytest.raises(RuntimeError, match="lost"):
        COUNTS.fold(spark, path)
    monkeypatch.undo()
    assert sorted(map(tuple, COUNTS.read(spark, path).collect())) == want
    table.drop(random_rows(31, 20))
    COUNTS.fold(spark, path)
    now = current(read_versions(spark, table.path("table"))).groupBy("op").count()
    assert {r.op: r.n for r in COUNTS.read(spark, path).collect() if r.n} == dict(map(tuple, now.collect()))


# ---- replay of a part ----------------------------------------------------------------------


@pytest.mark.parametrize("seed", [41])
def test_replay_of_a_range_equals_the_full_rebuild(spark, tmp_path, seed):
    """Changes that reached the log but not the table, and ranges and keys that hold them."""
    rng = random.Random(seed)
    table = Table(spark, tmp_path, buckets=2)
    table.drop(random_rows(seed, 50))
    since, until = sorted(rng.sample(range(1, 28), 2))
    key = f"k{rng.randrange(7)}"
    missed = [
        (rng.choice([key, "k1", "new"]), rng.choice(["I", "DELETE"]), 100 + i, rng.randrange(since, until), 3, f"m{i}")
        for i in range(12)
    ]
    table.land(missed)
    replay = (spark, table.path("log"), table.path("table"), "k", DELETE)
    bounds = (f"2024-01-{since:02}", f"2024-01-{until:02}")
    replay_versions(*replay, keys=[key], since=bounds[0], until=bounds[1])
    assert {s for s in table.spans() if s[0] == key} == {s for s in brute_force(table.rows) if s[0] == key}
    replay_versions(*replay, since=bounds[0], until=bounds[1])
    table.check()
    # Nothing changes where nothing was missed, for any range; later runs go on as before.
    replay_versions(*replay, until=bounds[0])
    replay_versions(*replay, keys=["k2", "absent"])
    table.check()
    table.drop(random_rows(seed + 1, 20))
    fold_versions(spark, table.path("table"), "k")
    table.check()
