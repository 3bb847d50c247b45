"""Work on keys of any size: no key's rows have to fit one task.

``hot_keys`` finds keys with more rows than one task should take. The operators here and in
``history`` / ``asof`` accept its result and split only those keys; all others take the plain plan.
Detection reads one column. A missed key costs time, never rows. A few hot keys are literals of the
plan; more are a table that Spark joins by its size, so that plans stay short.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from functools import reduce
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from shopledger.session import materialize

# Hot key -> number of tasks its rows are spread over.
Hot = Mapping[Any, int]

GROUP_ROWS = 1_000_000
MAX_SHARE = 1e-4
# No key above this stays in one task, however large the table is.
TASK_ROWS = 5_000_000
SAMPLE_ROWS = 20_000_000
# Hash buckets of the first count; more than there can be keys above the share.
COUNTED_BUCKETS = 1 << 15
# Up to so many hot keys are written into the plan.
LITERAL_KEYS = 1000


def hot_keys(
    df: DataFrame,
    key: str,
    group_rows: int = GROUP_ROWS,
    max_share: float = MAX_SHARE,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[Any, int]:
    """Keys (NULL included) holding more than ``group_rows`` rows and ``max_share`` of the table.

    The share keeps the answer short, at about ``1 / max_share`` keys, until it would leave more
    than ``TASK_ROWS`` rows of a key to one task; from there on the limit stays where it is, and the
    answer holds a key per ``TASK_ROWS`` rows of the table at most.

    Rows are counted per hash bucket first, which moves next to nothing. Only keys of buckets above
    the limit are then counted one by one, in large tables on a sample of about ``sample_rows``,
    larger where the limit is a smaller share of the table; it only steers the split, the rows
    themselves all stay.
    """
    bucket = F.pmod(F.xxhash64("key"), F.lit(COUNTED_BUCKETS))
    keys = df.select(F.col(key).alias("key"))
    sizes = dict(keys.groupBy(bucket.alias("bucket")).count().collect())
    total = sum(sizes.values())
    limit = max(group_rows, min(total * max_share, TASK_ROWS))
    full = [b for b, size in sizes.items() if size > limit]
    if not full:
        return {}
    # A key at the limit is met about a thousand times in the sample.
    fraction = min(1.0, max(sample_rows / total, 1000 / limit))
    counted = keys if fraction == 1.0 else keys.sample(fraction=fraction, seed=11)
    counted = counted.filter(bucket.isin(full))
    found = counted.groupBy("key").count().filter(F.col("count") > limit * fraction).collect()
    return {row["key"]: ceil(row["count"] / fraction / limit) for row in found}


def merge_hot(*parts: Hot) -> dict[Any, int]:
    """Hot keys of several inputs that will meet in one operator."""
    merged: dict[Any, int] = {}
    for part in parts:
        for key, splits in part.items():
            merged[key] = merged.get(key, 0) + splits
    return merged


def is_hot(key: str, hot: Collection[Any]) -> Column:
    """Whether ``key``, which may be NULL, is one of the hot keys; never NULL itself."""
    known = [k for k in hot if k is not None]
    listed = F.col(key).isin(known) if known else F.col(key).isNull() & F.lit(False)
    return F.when(F.col(key).isNull(), F.lit(None in hot)).otherwise(listed)


def _power(splits: int) -> int:
    return 1 << (splits - 1).bit_length()


def _spread(key: str, hot: Hot, other: int = 1) -> Column:
    """Over how many tasks the rows of a key go: the next power of two for hot keys, else ``other``."""
    by_size: dict[int, list[Any]] = {}
    for value, splits in hot.items():
        by_size.setdefault(_power(splits), []).append(value)
    spread = F.lit(other)
    for size, values in by_size.items():
        spread = F.when(is_hot(key, values), size).otherwise(spread)
    return spread


def marked(rows: DataFrame, key: str, hot: Hot, name: str = "_spread") -> DataFrame:
    """Adds ``name``: 0, or for a hot key the next power of two of its number of tasks."""
    if len(hot) > LITERAL_KEYS:
        kind = rows.select(key).schema[0].dataType
        shape = StructType([StructField("_hot_key", kind), StructField(name, IntegerType())])
        sizes = [(value, _power(splits)) for value, splits in hot.items()]
        table = rows.sparkSession.createDataFrame(sizes, shape)
        joined = rows.join(table, F.col(key).eqNullSafe(F.col("_hot_key")), "left")
        return joined.drop("_hot_key").withColumn(name, F.coalesce(name, F.lit(0)))
    return rows.withColumn(name, _spread(key, hot, 0))


def split(rows: DataFrame, key: str, hot: Hot) -> tuple[DataFrame, DataFrame]:
    """The rows of hot keys, and the others."""
    if len(hot) <= LITERAL_KEYS:
        return rows.filter(is_hot(key, hot)), rows.filter(~is_hot(key, hot))
    both = marked(rows, key, hot)
    return both.filter("_spread > 0").drop("_spread"), both.filter("_spread = 0").drop("_spread")


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, hot: Hot | None = None, null_safe: bool = False
) -> DataFrame:
    """Left join to a side with few rows per key.

    Hot fact rows are spread by a hash of their content, which a repeated task reproduces; the
    lookup rows of hot keys, and only those, are repeated once per spread. Exact copies of one row
    stay together here and are left to the adaptive skew join.
    """
    on = [key]
    if hot:
        facts = _salted(facts, key, hot)
        copies = F.sequence(F.lit(0), F.greatest(F.col("_spread"), F.lit(1)) - 1)
        lookup = marked(lookup, key, hot).withColumn("_salt", F.explode(copies)).drop("_spread")
        on.append("_salt")
    if not null_safe:
        return facts.join(lookup, on, "left").drop("_salt")
    renamed = lookup.withColumnsRenamed({name: f"_right_{name}" for name in on})
    matches = [F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in on]
    joined = facts.join(renamed, matches, "left")
    return joined.drop("_salt", *[f"_right_{name}" for name in on])


def _ranges(rows: DataFrame, key: str, order: Sequence[str], hot: Hot) -> DataFrame:
    """Hot rows cut into ranges of (key, order) with the range number in ``_slice``.

    Range bounds come from sampling, so the numbered rows are checkpointed before anything refers
    to the numbers twice.
    """
    cut = rows.repartitionByRange(sum(hot.values()) + 1, key, *order)
    return materialize(cut.withColumn("_slice", F.spark_partition_id()))


def _salted(facts: DataFrame, key: str, hot: Hot) -> DataFrame:
    content = F.xxhash64(*facts.columns)
    salt = F.when(F.col("_spread") > 1, F.pmod(content, F.col("_spread"))).otherwise(0)
    return marked(facts, key, hot).withColumn("_salt", salt.cast("int")).drop("_spread")


def with_next(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    fields: Sequence[str],
    out: str,
    hot: Hot | None = None,
    drop_copies: bool = False,
    later: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Adds ``out``: a struct of ``fields`` of the next row of the same key in ``order``, else NULL.

    Rows equal in key and order cannot be split into ranges. Where they are mere copies,
    ``drop_copies`` collapses those of hot keys before the shuffle; other keys keep theirs.
    ``later`` adds columns, of which ``order`` may name some, that are made once the rows are dealt
    out; for hot keys before, since they take part in the ranges.
    """
    later = dict(later or {})

    def within(part: DataFrame, *by: str) -> DataFrame:
        # The fields are looked up one by one: a struct column would be shuffled beside them.
        window = Window.partitionBy(*by).orderBy(*order)
        ahead = {f"_next_{f}": F.lead(f).over(window) for f in fields}
        seen = part.withColumns({**ahead, "_has_next": F.lead(F.lit(True)).over(window)})
        after = F.struct(*[F.col(f"_next_{f}").alias(f) for f in fields])
        return seen.withColumn(out, F.when(F.col("_has_next"), after)).drop(*ahead, "_has_next")

    def alone(part: DataFrame) -> DataFrame:
        return within(part.repartition(key).withColumns(later) if later else part, key)

    if not hot:
        return alone(rows)
    heavy, light = split(rows, key, hot)
    heavy = heavy.withColumns(later)
    if drop_copies:
        heavy = heavy.dropDuplicates([key, *order])
    sliced = _ranges(heavy, key, order, hot)
    first = F.min_by(F.struct(*fields), F.struct(*order))
    per_slice = sliced.groupBy(key, "_slice").agg(first.alias("_first"))
    next_first = F.lead("_first").over(Window.partitionBy(key).orderBy("_slice"))
    borders = per_slice.select(key, "_slice", next_first.alias("_border"))
    # At most one border per range and hot key, so broadcasting has a fixed bound.
    stitched = _attach(within(sliced, key, "_slice"), borders, key)
    heavy = stitched.withColumn(out, F.coalesce(out, "_border")).drop("_slice", "_border")
    return alone(light).unionByName(heavy)


def with_latest(
    rows: DataFrame | Sequence[DataFrame],
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    hot: Hot | None = None,
) -> DataFrame:
    """Adds ``out``: the last non-NULL ``value`` of the key up to and including the row.

    ``rows`` may come in several parts, of which some lack columns. Each part is then dealt out by
    itself: one that already lies by key, such as versions fresh from their window, is not moved
    again, and no row takes the other parts' columns through the shuffle.
    """
    parts = [rows] if isinstance(rows, DataFrame) else list(rows)

    def union(some: Iterable[DataFrame]) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), some)

    def within(part: DataFrame, *by: str) -> DataFrame:
        frame = Window.partitionBy(*by).orderBy(*order)
        frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumn(out, F.last(value, ignorenulls=True).over(frame))

    def dealt(some: Sequence[DataFrame]) -> DataFrame:
        return union(some if len(some) == 1 else [part.repartition(key) for part in some])

    if not hot:
        return within(dealt(parts), key)
    sides = [split(part, key, hot) for part in parts]
    heavy, light = union([side[0] for side in sides]), dealt([side[1] for side in sides])
    sliced = _ranges(heavy, key, order, hot)
    position = F.when(F.col(value).isNotNull(), F.struct(*order))
    per_slice = sliced.groupBy(key, "_slice").agg(F.max_by(value, position).alias("_last"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last("_last", ignorenulls=True).over(earlier)
    borders = per_slice.select(key, "_slice", carried.alias("_border"))
    stitched = _attach(within(sliced, key, "_slice"), borders, key)
    heavy = stitched.withColumn(out, F.coalesce(out, "_border")).drop("_slice", "_border")
    return within(light, key).unionByName(heavy)


def with_greatest_before(
    rows: DataFrame, key: str, order: Sequence[str], value: str, out: str, hot: Hot | None = None
) -> DataFrame:
    """Adds ``out``: the greatest ``value`` of the key's earlier rows in ``order``, NULL for the first."""

    def within(part: DataFrame, *by: str) -> DataFrame:
        frame = Window.partitionBy(*by).orderBy(*order)
        frame = frame.rowsBetween(Window.unboundedPreceding, -1)
        return part.withColumn(out, F.max(value).over(frame))

    if not hot:
        return within(rows, key)
    heavy, light = split(rows, key, hot)
    sliced = _ranges(heavy, key, order, hot)
    per_slice = sliced.groupBy(key, "_slice").agg(F.max(value).alias("_top"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    borders = per_slice.select(key, "_slice", F.max("_top").over(earlier).alias("_border"))
    stitched = _attach(within(sliced, key, "_slice"), borders, key)
    # greatest() skips NULL, so the first row of a range takes what came before the range.
    heavy = stitched.withColumn(out, F.greatest(out, "_border")).drop("_slice", "_border")
    return within(light, key).unionByName(heavy)


def _attach(sliced: DataFrame, borders: DataFrame, key: str) -> DataFrame:
    borders = borders.withColumnsRenamed({key: "_key", "_slice": "_at"})
    matches = [F.col(key).eqNullSafe(F.col("_key")), F.col("_slice") == F.col("_at")]
    return sliced.join(F.broadcast(borders), matches, "left").drop("_key", "_at")
