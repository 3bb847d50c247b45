import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopledger.operators.ranking import dense_rank_desc
from shopledger.operators.skew import (
    _salted,
    _spread,
    hot_keys,
    is_hot,
    lookup_join,
    merge_hot,
    with_greatest_before,
    with_latest,
    with_next,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows, a third of them on key 'big', a ninth on NULL."""
    random.seed(3)
    rows = []
    for i in range(900):
        key = "big" if i % 3 == 0 else None if i % 9 == 1 else f"k{random.randrange(60)}"
        rows.append((key, random.randrange(400), i, i if random.random() < 0.3 else None))
    return spark.createDataFrame(rows, "k string, at int, id int, mark int").cache()


def test_hot_keys_are_those_over_the_limit(skewed):
    assert hot_keys(skewed, "k", group_rows=50) == {"big": 6, None: 2}
    assert hot_keys(skewed, "k") == {}


def test_hot_keys_bounded_by_share(skewed):
    assert set(hot_keys(skewed, "k", group_rows=1, max_share=0.2)) == {"big"}


def test_hot_keys_on_a_sample(spark):
    big = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    df = spark.range(60_000).select(big.alias("k"))
    found = hot_keys(df, "k", group_rows=1_000, sample_rows=6_000)
    assert list(found) == [-1] and 15 <= found[-1] <= 25


def test_merge_hot():
    assert merge_hot({"a": 2, None: 1}, {"a": 3}) == {"a": 5, None: 1}


@pytest.mark.parametrize("hot", [{"big": 2}, {None: 3}, {"big": 2, None: 1}])
def test_is_hot_never_null(skewed, hot):
    picked = {r.k for r in skewed.filter(is_hot("k", hot)).select("k").distinct().collect()}
    assert picked == set(hot)
    left = skewed.filter(~is_hot("k", hot)).count()
    assert left == skewed.filter(F.lit(True)).count() - skewed.filter(is_hot("k", hot)).count()


@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_spreads_hot_rows(spark, skewed, rows_of, null_safe):
    lookup = spark.createDataFrame(
        [("big", "B"), ("k1", "one"), ("k2", "two"), (None, "none")], "k string, label string"
    )
    plain = lookup_join(skewed, lookup, "k", null_safe=null_safe)
    spread = lookup_join(skewed, lookup, "k", {"big": 6, "k1": 1, None: 2}, null_safe=null_safe)
    assert spread.columns == plain.columns
    assert rows_of(spread) == rows_of(plain)
    labelled = {r.label for r in spread.filter(F.col("k").isNull()).collect()}
    assert labelled == ({"none"} if null_safe else {None})


def test_only_lookup_rows_of_hot_keys_are_repeated(spark):
    """The repeats follow the splits of each key, so one very hot key does not inflate the others."""
    hot = {"big": 100, "mid": 3, None: 2}
    keys = spark.createDataFrame([("big",), ("mid",), ("k1",), (None,)], "k string")
    spreads = {r.k: r.n for r in keys.select("k", _spread("k", hot).alias("n")).collect()}
    assert spreads == {"big": 128, "mid": 4, "k1": 1, None: 2}
    salts = _salted(spark.range(5000).withColumn("k", F.lit("big")), "k", hot)
    assert salts.select("_salt").distinct().count() == 128


def test_with_next_equals_brute_force(skewed):
    got = with_next(skewed, "k", ["at", "id"], ["id"], "after", {"big": 6, None: 2})
    by_key = {}
    for r in sorted(skewed.collect(), key=lambda r: (r.at, r.id)):
        by_key.setdefault(r.k, []).append(r.id)
    wanted = {}
    for ids in by_key.values():
        wanted.update(zip(ids, [*ids[1:], None]))
    assert {r.id: r.after and r.after.id for r in got.collect()} == wanted


@pytest.mark.parametrize("splits", [1, 2, 6, 40])
def test_with_latest_equals_brute_force(skewed, splits):
    got = with_latest(skewed, "k", ["at", "id"], "mark", "seen", {"big": splits, None: 2})
    wanted, last = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: (r.at, r.id)):
        if r.mark is not None:
            last[r.k] = r.mark
        wanted[r.id] = last.get(r.k)
    assert {r.id: r.seen for r in got.collect()} == wanted


def test_with_latest_when_a_hot_key_has_no_value(spark):
    df = spark.range(100).select(F.lit("a").alias("k"), "id", F.lit(None).cast("int").alias("mark"))
    got = with_latest(df, "k", ["id"], "mark", "seen", {"a": 5})
    assert Counter(r.seen for r in got.collect()) == {None: 100}


def test_dense_rank_over_ranges(spark):
    random.seed(5)
    values = [random.choice([0.0, None, float(random.randrange(50))]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    order = sorted({v for v in values if v is not None}, reverse=True) + [None]
    got = dense_rank_desc(df, "v", "r").collect()
    assert len(got) == 500
    assert all(r.r == order.index(r.v) + 1 for r in got)


@pytest.mark.parametrize("hot", [None, {"big": 5, None: 2}])
def test_greatest_before_equals_brute_force(skewed, hot):
    got = with_greatest_before(skewed, "k", ["at", "id"], "mark", "top", hot)
    wanted, top = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: (r.at, r.id)):
        wanted[r.id] = top.get(r.k)
        if r.mark is not None:
            top[r.k] = max(r.mark, top.get(r.k, r.mark))
    assert {r.id: r.top for r in got.collect()} == wanted


def test_many_hot_keys_are_a_table(spark, rows_of):
    """Their number shows neither in the plan nor in the time it takes to make one."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("k"), F.col("id") % 25_000).alias("k"), F.col("id").alias("at"), "id"
    )
    hot = {f"k{i}": 2 for i in range(20_000)} | {None: 3}
    lookup = rows.filter("id < 25000").select("k", F.col("id").alias("label"))
    started = time.monotonic()
    joined = lookup_join(rows, lookup, "k", hot)
    chained = with_next(rows, "k", ["at"], ["id"], "after", {k: 1 for k in list(hot)[:1500]})
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert time.monotonic() - started < 20 and len(plan) < 20_000
    assert rows_of(joined) == rows_of(lookup_join(rows, lookup, "k"))
    assert rows_of(chained) == rows_of(with_next(rows, "k", ["at"], ["id"], "after"))
