"""Version tables kept up to date from streams.

Staged changes are appended to a change log partitioned by a hash bucket of the key. A second stream
follows the log. The version table is partitioned by bucket and by open or ended. Every row carries
the generation that wrote it, one per run.

Changes that come in order end open versions and start new ones: a run appends what ended and
rewrites the open part only. A key with a change older than its open version is late: its history is
built anew from its stored rows and the change, appended under the run's generation, and the key is
noted as rewritten. Readers take of a rewritten key only what is at least as new as the note, so
nothing of its bucket is rewritten and late data costs what the late keys cost. ``fold_versions``
removes superseded rows. Delete changes stay in the log and in the stored table, so that an earlier
change arriving later cannot revive a deleted key.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from contextlib import ExitStack
from datetime import datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from shopledger.operators.history import (
    DELETED,
    END,
    SEQUENCE,
    START,
    current_from_changes,
    version_all,
)
from shopledger.operators.skew import GROUP_ROWS, hot_keys, marked
from shopledger.session import COMPRESSION, freeing, materialize, stored_once
from shopledger.sources.files import append_row, latest_row, put_row
from shopledger.sources.tables import append_partitions, remove_partitions, replace_partitions
from shopledger.streaming.ingest import drain

BUCKET = "_bucket"
OPEN = "_open"
GENERATION = "_generation"
# Rewritten keys listed in the scan's filter; more are left to the join.
LISTED_KEYS = 1000
BEGUN = "version long, batch long"
RUN = "_run"
# Current rows before and after a batch, and its number.
Changed = Callable[[DataFrame, DataFrame, int], None]
Ties = Sequence[str | Column]
TAKEN = "version long, run long"
GATHERED = "version long, run long"


def log_changes(
    staged: DataFrame,
    log: str,
    checkpoint: str,
    key: str,
    buckets: int,
    hot: Collection[Any] | None = (),
) -> StreamingQuery:
    """Appends the new rows of a staged stream to the change log, a folder per run.

    Rows of a bucket are gathered to keep files large. Each bucket gets its share of the shuffle
    partitions as writers; rows without a key and rows of ``hot`` keys get all of them. With None
    the hot keys are those of the new rows, which are then stored once before they are counted, so
    that nothing they observe is counted twice. Writers are told apart by input partition, so that
    copies of one row spread too, and a repeated task has the same input partition.
    """
    partitions = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batch: DataFrame, batch_id: int) -> None:
        if hot is None:
            batch = materialize(batch)
        known = hot_keys(batch, key) if hot is None else hot
        wide = marked(batch, key, dict.fromkeys({None, *known}, 2))
        spread = F.when(F.col("_spread") > 0, partitions).otherwise(max(partitions // buckets, 1))
        part = F.pmod(F.spark_partition_id(), spread)
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = wide.withColumns({BUCKET: bucket, "_part": part}).drop("_spread")
        gathered = rows.repartition(BUCKET, "_part").drop("_part")
        target = f"{log}/{RUN}={batch_id}"
        kept = gathered.write.option("compression", COMPRESSION).mode("overwrite")
        kept.partitionBy(BUCKET).parquet(target)

    writer = staged.writeStream.foreachBatch(write).trigger(availableNow=True)
    with freeing(staged.sparkSession):
        return drain(writer.option("checkpointLocation", checkpoint).start())


def _gathered_path(log: str) -> str:
    return f"{log}_gathered"


def _taken_path(log: str) -> str:
    return f"{log}_taken"


def _gathered(spark: SparkSession, log: str) -> list[int]:
    """The last run of every completed gathering."""
    try:
        rows = spark.read.schema(GATHERED).json(f"{_gathered_path(log)}_done").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(row.run for row in rows)


def read_log(spark: SparkSession, log: str, before: int | None = None) -> DataFrame:
    """Every logged change once: gathered runs, and the later ones from their own folders.

    ``before`` leaves out the changes of that run and later ones; it must not be gathered yet.
    """
    done = _gathered(spark, log)
    earlier = F.lit(True) if before is None else F.col(RUN) < before
    if not done:
        return spark.read.parquet(log).filter(earlier).drop(RUN)
    folder = _gathered_path(log)
    reader = spark.read.option("basePath", folder)
    old = reader.parquet(*[f"{folder}/upto={run}" for run in done]).drop("upto")
    schema = StructType([*old.schema, StructField(RUN, LongType())])
    new = spark.read.schema(schema).parquet(log).filter((F.col(RUN) > done[-1]) & earlier)
    return old.unionByName(new.drop(RUN))


def stream_log(spark: SparkSession, log: str) -> DataFrame:
    """The log as it grows, with the run that wrote each row."""
    schema = StructType([*read_log(spark, log).schema, StructField(RUN, LongType())])
    return spark.readStream.schema(schema).parquet(log)


def gather_log(spark: SparkSession, log: str) -> None:
    """Gathers the runs that the version table has taken into one folder, and removes theirs.

    The writing stream goes on with new runs and the following stream has read the old ones, so
    neither notices, and their listings stay short. What is gathered counts from the moment it is
    noted as done; a failure before leaves a folder nobody reads, one after it leaves run folders
    that readers skip and the next call removes. Not to be called while readers of the log run.
    """
    latest = latest_row(spark, _taken_path(log), TAKEN)
    done = _gathered(spark, log)
    start = done[-1] if done else -1
    if latest is None:
        return
    if latest.run > start:
        schema = StructType([*read_log(spark, log).schema, StructField(RUN, LongType())])
        runs = spark.read.schema(schema).parquet(log)
        rows = runs.filter((F.col(RUN) > start) & (F.col(RUN) <= latest.run)).drop(RUN)
        target = f"{_gathered_path(log)}/upto={latest.run}"
        rows = rows.hint("rebalance", BUCKET)
        writer = rows.write.option("compression", COMPRESSION).mode("overwrite")
        with freeing(spark):
            writer.partitionBy(BUCKET).parquet(target)
        append_row(spark, f"{_gathered_path(log)}_done", GATHERED, latest.run)
    remove_partitions(spark, log, RUN, latest.run)


def _placed(built: DataFrame, generation: int) -> DataFrame:
    is_open = F.col(END).isNull().cast("int")
    return built.withColumns({GENERATION: F.lit(generation).cast("long"), OPEN: is_open})


def _rebuild(
    changes: DataFrame,
    table: str,
    key: str,
    delete: str | None,
    generation: int,
    group_rows: int = GROUP_ROWS,
    ties: Ties | None = None,
) -> None:
    built = version_all(changes, key, delete, hot_keys(changes, key, group_rows), ties)
    # Stored in between, so that the shuffle by key is gone when that by bucket begins.
    with stored_once(_placed(built, generation)) as rows:
        replace_partitions(rows, table, [BUCKET, OPEN], [key, START])


def _rewritten_path(table: str) -> str:
    return f"{table}_rewritten"


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _note(keys: DataFrame, table: str, key: str, generation: int, mode: str = "append") -> None:
    """Notes that of these keys only rows of this generation or a newer one hold."""
    noted = keys.select(key, BUCKET, F.lit(generation).cast("long").alias(GENERATION))
    noted.write.mode(mode).parquet(_rewritten_path(table))


def _notes(spark: SparkSession, table: str, key: str, columns: StructType) -> DataFrame | None:
    fields = [f for f in columns if f.name in (key, BUCKET)]
    shape = StructType([*fields, StructField(GENERATION, LongType())])
    return _read(spark, _rewritten_path(table), shape)


def _generation(spark: SparkSession, table: str, key: str, least: int, columns: StructType) -> int:
    """A number above all that notes ask for."""
    noted = _notes(spark, table, key, columns)
    newest = noted.agg(F.max(GENERATION)).first()[0] if noted is not None else None
    return max(least, -1 if newest is None else newest + 1)


def _valid(spark: SparkSession, stored: DataFrame, table: str, key: str) -> DataFrame:
    """The stored rows that no later generation of their key has superseded."""
    noted = _notes(spark, table, key, stored.schema)
    if noted is None:
        return stored
    newest = noted.groupBy(key).agg(F.max(GENERATION).alias("_newest"))
    holds = F.col("_newest").isNull() | (F.col(GENERATION) >= F.col("_newest"))
    return stored.join(newest, key, "left").filter(holds).select(*stored.columns)


def _stored(
    spark: SparkSession, table: str, changes: StructType, key: str, delete: str | None
) -> DataFrame | None:
    """All stored rows, superseded ones and delete changes included, or None before the first run."""
    built = version_all(spark.createDataFrame([], changes), key, delete)
    return _read(spark, table, _placed(built, 0).schema)


def _buckets(rows: DataFrame) -> list[int]:
    """At most one value per bucket."""
    return [row[BUCKET] for row in rows.select(BUCKET).distinct().collect()]


def _late(batch: DataFrame, newest: DataFrame, key: str) -> DataFrame:
    """Keys of the batch, with their bucket, that have a change before the start of their open version."""
    first = batch.groupBy(BUCKET, key).agg(F.min(F.struct(*SEQUENCE)).alias("_first"))
    older = first.join(newest.select(key, START), key).filter(F.col("_first") < F.col(START))
    return older.select(key, BUCKET)


def _of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of the given keys. A short list also reaches the scan, whose files are sorted by key."""
    listed = [row[key] for row in keys.select(key).limit(LISTED_KEYS + 1).collect()]
    if len(listed) <= LISTED_KEYS:
        rows = rows.filter(F.col(key).isin(listed))
    return rows.join(keys.select(key), key, "left_semi")


def refresh_versions(
    spark: SparkSession,
    log: str,
    table: str,
    checkpoint: str,
    key: str,
    delete: str | None = None,
    group_rows: int = GROUP_ROWS,
    changed: Changed | None = None,
    ties: Ties | None = None,
) -> None:
    """Takes the changes logged since the last refresh into the version table.

    ``ties`` is what decides between changes of equal key and sequence, see ``version_all``.

    A batch is noted before the table is touched. One that had begun before and is repeated may have
    left half of its work, so its buckets are rebuilt from the log, which gives the same table.

    ``changed`` is told, after each batch, the current rows of the keys it touched, before and after
    it, and the number of the batch. For a repeated batch it is told the same again.
    """
    schema = read_log(spark, log).schema
    begun = f"{checkpoint}-begun"

    def taken(batch: DataFrame, attempt: int) -> None:
        run = batch.agg(F.max(RUN)).first()[0]
        if run is not None:
            put_row(spark, _taken_path(log), TAKEN, attempt, run)

    def tell(before: DataFrame | None, keys: DataFrame, batch_id: int) -> None:
        if changed is not None:
            now = _of_keys(read_versions(spark, table, only_open=True, key=key), keys, key)
            names = [c for c in schema.names if c != BUCKET]
            now = now.select(*names)
            changed(now.limit(0) if before is None else before.select(*names), now, batch_id)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        # Every run inside gives its disk back; what several of them use is stored until the end.
        with freeing(batch.sparkSession), ExitStack() as until:
            take(batch, batch_id, lambda rows: until.enter_context(stored_once(rows)))

    def take(batch: DataFrame, batch_id: int, once: Callable[[DataFrame], DataFrame]) -> None:
        latest = latest_row(spark, begun, BEGUN)
        repeated = latest is not None and latest.batch >= batch_id
        attempt = latest.version + 1 if latest else 0
        put_row(spark, begun, BEGUN, attempt, batch_id)
        # Two numbers per attempt: what a late key gets supersedes what the run wrote before.
        generation = _generation(spark, table, key, 2 * attempt, schema)
        whole, batch = batch, batch.filter(F.col(key).isNotNull())
        touched = _buckets(batch)
        stored = _stored(spark, table, schema, key, delete)
        keys = batch.select(key, BUCKET).distinct()
        if stored is None or repeated:
            before = None
            if changed and repeated:
                run = whole.agg(F.min(RUN)).first()[0]
                known = read_log(spark, log, run).filter(F.col(BUCKET).isin(touched))
                before = current_from_changes(known.join(keys.select(key), key, "left_semi"), key, delete)
            changes = read_log(spark, log)
            if stored is not None:
                changes = changes.filter(F.col(BUCKET).isin(touched))
            _rebuild(changes, table, key, delete, generation, group_rows, ties)
            _note(batch.limit(0), table, key, generation)
            taken(whole, attempt)
            tell(before, keys, batch_id)
            return
        held = _valid(spark, stored.filter(F.col(BUCKET).isin(touched)), table, key)
        newest = held.filter(F.col(OPEN) == 1)
        before = None
        if changed:
            before = once(_of_keys(newest, keys, key).filter(~F.col(DELETED)))
        late = once(_late(batch, newest, key))
        follow_up = batch.join(late.select(key), key, "left_anti")
        in_order = _buckets(follow_up)
        if in_order:
            follow_up = follow_up.select(*schema.names)
            moved = follow_up.select(key).distinct()
            opened = newest.filter(F.col(BUCKET).isin(in_order))
            grown = opened.join(moved, key, "left_semi").select(*schema.names).unionByName(follow_up)
            hot = hot_keys(grown, key, group_rows)
            # Both writes take their rows from one result, as large as the changes.
            placed = _placed(version_all(grown, key, delete, hot, ties), generation)
            with stored_once(placed) as built:
                append_partitions(built.filter(F.col(OPEN) == 0), table, [BUCKET, OPEN], [key, START])
                still = opened.join(moved, key, "left_anti").select(*built.columns)
                now = still.unionByName(built.filter(F.col(OPEN) == 1))
                replace_partitions(now, table, [BUCKET, OPEN], [key, START])
        if not late.isEmpty():
            changes = batch.join(late.select(key), key, "left_semi").select(*schema.names)
            # The table again, after the open rows have moved.
            again = _stored(spark, table, schema, key, delete).filter(F.col(BUCKET).isin(touched))
            history = _of_keys(_valid(spark, again, table, key), late, key).select(*schema.names)
            grown = history.unionByName(changes)
            built = version_all(grown, key, delete, hot_keys(grown, key, group_rows), ties)
            with stored_once(_placed(built, generation + 1)) as rows:
                append_partitions(rows, table, [BUCKET, OPEN], [key, START])
            _note(late, table, key, generation + 1)
        taken(whole, attempt)
        tell(before, keys, batch_id)

    stream = stream_log(spark, log)
    writer = stream.writeStream.foreachBatch(refresh).trigger(availableNow=True)
    with freeing(spark):
        drain(writer.option("checkpointLocation", checkpoint).start())


def rebuild_versions(
    spark: SparkSession,
    log: str,
    table: str,
    key: str,
    delete: str | None = None,
    ties: Ties | None = None,
) -> None:
    """Recomputes the whole version table from the log, as after a change of history.

    It also gathers the files that many runs appended.
    """
    changes = read_log(spark, log)
    stored = _stored(spark, table, changes.schema, key, delete)
    newest = stored.agg(F.max(GENERATION)).first()[0] if stored is not None else None
    _rebuild(changes, table, key, delete, newest or 0, ties=ties)
    _note(changes.select(key, BUCKET).limit(0), table, key, 0, "overwrite")


def replay_versions(
    spark: SparkSession,
    log: str,
    table: str,
    key: str,
    delete: str | None = None,
    keys: Collection[Any] | None = None,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
) -> None:
    """Recomputes versions from the log for some ``keys`` (all if None) and event times from ``since``
    up to before ``until`` (unbounded if None); changes without event time belong to an open start.

    Changes outside the range are taken as stored, so the first and the last recomputed version meet
    their neighbours there. The keys that the range touches get a new generation; the rest of the
    table is neither read nor written, but for the key and time columns that tell them.
    """
    at = F.col(SEQUENCE[0])
    inside = F.lit(True)
    if since is not None:
        inside &= F.coalesce(at >= F.lit(since).cast("timestamp"), F.lit(False))
    if until is not None:
        inside &= F.coalesce(at < F.lit(until).cast("timestamp"), F.lit(since is None))
    changes = read_log(spark, log).filter(F.col(key).isNotNull())
    schema = changes.schema
    stored = _stored(spark, table, schema, key, delete)
    if keys is not None:
        chosen = F.col(key).isin(list(keys))
        changes, stored = changes.filter(chosen), stored.filter(chosen)
    held = _valid(spark, stored, table, key)
    changes = changes.filter(inside)
    touched = changes.select(key, BUCKET).unionByName(held.filter(inside).select(key, BUCKET))
    touched = materialize(touched.distinct())
    outside = _of_keys(held.filter(~inside), touched, key).select(*schema.names)
    grown = outside.unionByName(changes.select(*schema.names))
    generation = _generation(spark, table, key, held.agg(F.max(GENERATION)).first()[0] or 0, schema) + 1
    built = version_all(grown, key, delete, hot_keys(grown, key))
    append_partitions(_placed(built, generation), table, [BUCKET, OPEN], [key, START])
    _note(touched, table, key, generation)


def fold_versions(spark: SparkSession, table: str, key: str) -> None:
    """Rewrites the buckets that hold superseded rows without them, and forgets the notes.

    A failure in between leaves the notes, which hold for the rewritten rows too. A rewritten key
    has an ended and an open row at least, so no partition with superseded rows is left unwritten.
    """
    stored = spark.read.parquet(table)
    noted = _notes(spark, table, key, stored.schema)
    if noted is None or not (buckets := _buckets(noted)):
        return
    held = _valid(spark, stored.filter(F.col(BUCKET).isin(buckets)), table, key)
    replace_partitions(held, table, [BUCKET, OPEN], [key, START])
    # The notes are read from where they are replaced, so the empty ones take no rows from there.
    _note(spark.createDataFrame([], noted.schema), table, key, 0, "overwrite")


HELPERS = (DELETED, BUCKET, OPEN, GENERATION)


def contract_columns(spark: SparkSession, table: str) -> list[str]:
    return [c for c in spark.read.parquet(table).columns if c not in HELPERS]


def read_versions(
    spark: SparkSession, table: str, only_open: bool = False, key: str | None = None
) -> DataFrame:
    """The version table without delete changes; ``only_open`` skips the folders of ended versions."""
    stored = spark.read.parquet(table)
    if only_open:
        stored = stored.filter(F.col(OPEN) == 1)
    stored = _valid(spark, stored, table, key or _noted_key(spark, table))
    return stored.filter(~F.col(DELETED)).drop(*HELPERS)


def _noted_key(spark: SparkSession, table: str) -> str:
    """The key column of a version table, as its notes name it."""
    noted = spark.read.parquet(_rewritten_path(table)).columns
    return next(c for c in noted if c not in (BUCKET, GENERATION))


def versions_query(spark: SparkSession, table: str) -> str:
    """SQL over the stored paths that gives what ``read_versions`` does, for a catalog view."""
    key = _noted_key(spark, table)
    shown = ", ".join(f"v.`{c}`" for c in contract_columns(spark, table))
    notes = f"SELECT `{key}` AS k, max({GENERATION}) AS newest FROM parquet.`{_rewritten_path(table)}` GROUP BY 1"
    return (
        f"SELECT {shown} FROM parquet.`{table}` v LEFT JOIN ({notes}) n ON v.`{key}` = n.k"
        f" WHERE NOT v.{DELETED} AND (n.newest IS NULL OR v.{GENERATION} >= n.newest)"
    )
