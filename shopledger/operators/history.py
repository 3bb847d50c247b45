"""Version histories (SCD type 2) from change rows.

Every change starts a version at its own sequence and ends at the next sequence of the same key;
delete changes end a version without starting one. Intervals are half-open. The result does not
depend on the order or batching in which changes arrived.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.operators.skew import Hot, with_greatest_before, with_next

# The composite that orders changes, and the names of the validity columns.
SEQUENCE = ("_event_ts", "_ingest_ts", "_file_mod_time", "_source_file")
START = "__START_AT"
END = "__END_AT"

DELETED = "_deleted"


def version_all(
    changes: DataFrame,
    key: str,
    delete: str | None = None,
    hot: Hot | None = None,
    ties: Sequence[str | Column] | None = None,
    later: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Versions plus the delete changes, told apart by the ``_deleted`` column.

    Rows without a key cannot be versioned and are left out. Of rows with the same key and
    sequence one stays, chosen by the content of the ``ties`` columns: all of them by default.
    Naming the few in which such rows can differ lets unused columns be pruned from the scan.
    ``later``, none of them among ``ties``, gives columns of ``changes`` that follow from its other columns, such as hashes; they
    are made after the shuffle instead of being moved.
    """
    later = dict(later or {})
    flag = F.coalesce(F.expr(delete), F.lit(False)) if delete else F.lit(False)
    content = {"_content": F.xxhash64(*(changes.columns if ties is None else ties))}
    rows = changes.filter(F.col(key).isNotNull())
    if ties is None:
        # Hashed before the shuffle, so that columns nobody asks for need not pass it.
        rows, content = rows.withColumns(content), {}
    order = [*SEQUENCE, "_content"]
    rows = rows.drop(*later)
    chained = with_next(rows, key, order, SEQUENCE, END, hot, drop_copies=True, later=content)
    placed = chained.withColumns({**later, DELETED: flag, START: F.struct(*SEQUENCE)})
    newest = placed.filter(~F.col(START).eqNullSafe(F.col(END)))
    return newest.select(*changes.columns, DELETED, START, END)


def versions(
    changes: DataFrame,
    key: str,
    delete: str | None = None,
    hot: Hot | None = None,
    ties: Sequence[str | Column] | None = None,
    later: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The version table: columns of ``changes`` plus ``__START_AT`` and ``__END_AT``."""
    built = version_all(changes, key, delete, hot, ties, later)
    return built.filter(~F.col(DELETED)).drop(DELETED)


def current(version_table: DataFrame) -> DataFrame:
    """The version of each key that has not ended.

    The second condition follows from the first. Unlike a test of the whole struct it reaches the
    parquet scan, which then skips row groups holding ended versions only.
    """
    return version_table.filter(F.col(END).isNull() & F.col(f"{END}.{SEQUENCE[1]}").isNull())


def current_from_changes(changes: DataFrame, key: str, delete: str | None = None) -> DataFrame:
    """``current(versions(changes, ...))`` without building the history.

    A plain aggregation: partial results collapse each key before the shuffle, so hot keys need no
    special care.
    """
    rows = changes.filter(F.col(key).isNotNull())
    place = F.struct(*SEQUENCE, F.xxhash64(*changes.columns))
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*changes.columns), place).alias("row"))
    kept = newest.select("row.*").withColumn(START, F.struct(*SEQUENCE))
    kept = kept.withColumn(END, F.lit(None).cast(kept.schema[START].dataType))
    return kept.filter(~F.coalesce(F.expr(delete), F.lit(False))) if delete else kept


def keep_latest(
    rows: DataFrame,
    by: Sequence[str],
    latest: Sequence[str | Column],
    rank: str = "_record_number",
    later: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per ``by`` group, the greatest by ``latest``; ``rank`` records that it came first.

    ``later`` gives columns that follow from others and are made after the shuffle, as in
    ``version_all``.
    """
    later = dict(later or {})
    place = F.struct(*latest, F.xxhash64(*rows.columns))
    moved = [c for c in rows.columns if c not in later]
    best = rows.groupBy(*by).agg(F.max_by(F.struct(*moved), place).alias("row"))
    whole = best.select("row.*").withColumns(later).select(*rows.columns)
    return whole.withColumn(rank, F.lit(1))


def overlaps(version_table: DataFrame, key: str, hot: Hot | None = None) -> DataFrame:
    """Versions that are still open when the next version of their key starts; none are expected."""
    content = F.xxhash64(*version_table.columns)
    rows = version_table.withColumns({"_from": F.col(START), "_content": content})
    chained = with_next(rows, key, ["_from", "_content"], ["_from"], "_next", hot)
    ended = F.col(END).isNull() | (F.col(END) > F.col("_next._from"))
    found = chained.filter(F.col("_next").isNotNull() & ended)
    return found.select(*version_table.columns, F.col("_next._from").alias("_next_start"))


def covered(version_table: DataFrame, key: str, hot: Hot | None = None) -> DataFrame:
    """Versions that start before some earlier version of their key has ended; none are expected.

    Unlike ``overlaps``, which looks at neighbours, this carries the latest end of all earlier
    versions along, so a version that spans several later ones is met at each of them.
    ``_covered_until`` is that end, with ``never`` for a version that has none.
    """
    until = F.struct(F.col(END).isNull().alias("never"), F.col(END).alias("end"))
    content = F.xxhash64(*version_table.columns)
    rows = version_table.withColumns({"_from": F.col(START), "_content": content, "_until": until})
    seen = with_greatest_before(rows, key, ["_from", "_content"], "_until", "_covered_until", hot)
    still = F.col("_covered_until.never") | (F.col("_covered_until.end") > F.col("_from"))
    return seen.filter(still).select(*version_table.columns, "_covered_until")
