"""Incremental ingestion of file drops; every run drains what is new and ends.

An ingested table is a folder with one sub-folder per flow, each written by one streaming query
whose checkpoint remembers the files it has read.
"""

from __future__ import annotations

import csv
import io
import time
from collections.abc import Callable, Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from shopledger.sources.files import (
    RESCUED,
    RESCUED_HEADER,
    WIDER,
    append_row,
    csv_options,
    earlier,
    field_sql,
    ingested_schema,
    latest_row,
    physical_schema,
    read_schema,
    save_schema,
    stored_as,
    stored_schema,
    widened,
    wider,
    with_lineage,
)

FILES = "files"
BACKFILL = "backfill"
FLOWS = (BACKFILL, FILES)
HEADER = "version long, value string"


def drain(query: StreamingQuery) -> StreamingQuery:
    """Waits for a run-to-completion query; its failure is raised here."""
    query.awaitTermination()
    return query


class _Counter(StreamingQueryListener):
    """Observed metrics of every micro-batch of the queries that observe ``name``."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.batches: dict[tuple[str, int], dict[str, int]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches[str(event.progress.runId), event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        self.ended.add(str(event.runId))

    def totals(self) -> dict[str, int]:
        sums: dict[str, int] = {}
        for counts in self.batches.values():
            for metric, count in counts.items():
                sums[metric] = sums.get(metric, 0) + count
        return sums


def counted_run(
    spark: SparkSession, name: str, run: Callable[[], StreamingQuery], patience: float = 300.0
) -> dict[str, int]:
    """Runs a query to its end and sums what it observed under ``name``, over all micro-batches.

    The query's own progress list keeps the latest micro-batches only, so events are counted as
    they come; they are delivered in order, and the last one says that the query has ended.
    """
    counter = _Counter(name)
    spark.streams.addListener(counter)
    try:
        query = run()
        limit = time.monotonic() + patience
        while str(query.runId) not in counter.ended:
            if time.monotonic() > limit:
                raise TimeoutError(f"the events of {name} did not arrive")
            time.sleep(0.05)
        return counter.totals()
    finally:
        spark.streams.removeListener(counter)


def append_stream(
    rows: DataFrame, target: str, checkpoint: str, partition: str | None = None
) -> StreamingQuery:
    """Appends everything new to a parquet folder, each row exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy(partition)
    return drain(writer.option("path", target).option("checkpointLocation", checkpoint).start())


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    infer: bool = False,
    files_per_batch: int | None = None,
) -> None:
    """New CSV files of one layout into ``target``.

    All text unless ``infer``; types are inferred once and stored beside the checkpoint.
    """
    schema = stored_schema(spark, source, f"{state}/schema", infer)
    reader = spark.readStream.schema(schema).options(**csv_options(schema))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    append_stream(with_lineage(reader.csv(source)), f"{target}/{FILES}", f"{state}/{FILES}")


def ingest_csv_evolving(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    infer: bool = False,
    files_per_batch: int = 1000,
    text_share: float = 0.5,
) -> None:
    """New CSV files whose layouts may differ: columns are matched by header name.

    All files count whatever their names, but for those Spark takes as hidden (``_`` or ``.`` first).

    Columns not seen before are appended to the stored schema, as text unless ``infer``. Values that
    do not fit their type are rescued. Where a batch rescued some, the types of its files are
    inferred, and a column whose values need a wider type gets it: whole numbers become larger ones
    or doubles, dates become times. Anything becomes text only when no other type holds the larger
    part (``text_share``) of the batch's values, so that a stray word does not turn a number into
    text. Readers then find the column's values in what it was stored in before, and in the rescued
    records, see ``files.field_sql``; nothing is written again.

    Files are read once where they have the layout of the files before; other layouts take a job
    over the files' first lines. Rows of files without a column hold NULL. Each micro-batch writes its own folder, replaced if
    the batch has to be repeated.
    """
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
    )
    schema_path = f"{state}/schema"

    def take(layouts: dict[tuple[str, ...], list[str]], batch_id: int) -> None:
        known = read_schema(spark, schema_path) or StructType()
        fields = {f.name: f for f in known if f.name != RESCUED}
        for header, files in layouts.items():
            if not set(header) <= set(fields):
                found = spark.read.option("header", True).option("inferSchema", infer).csv(files)
                for field in found.schema:
                    fields.setdefault(field.name, field)
        rescue = [StructField(RESCUED, StringType())] if infer else []
        schema = StructType([*fields.values(), *rescue])
        if schema != known:
            save_schema(spark, schema_path, schema)
        seen = Observation(f"batch {batch_id}")
        parts = []
        for header, files in layouts.items():
            layout = StructType([*[StructField(n, fields[n].dataType) for n in header], *rescue])
            read = spark.read.schema(layout).options(**csv_options(layout)).csv(files)
            read = with_lineage(read).withColumnsRenamed({n: stored_as(fields[n]) for n in header})
            if infer:
                line = F.when(F.col(RESCUED).isNotNull(), F.lit(_csv_line(header)))
                read = read.withColumn(RESCUED_HEADER, line)
            parts.append(read)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if infer:
            rows = rows.observe(seen, F.count(RESCUED).alias("rescued"))
        rows.write.mode("overwrite").parquet(f"{target}/{FILES}/batch={batch_id}")
        if infer and seen.get["rescued"]:
            _widen(spark, layouts, fields, schema_path, text_share)

    def load(batch: DataFrame, batch_id: int) -> None:
        # File names of one micro-batch, at most ``files_per_batch``.
        paths = [row.path for row in batch.collect()]
        last = latest_row(spark, f"{state}/header", HEADER)
        if last is not None and paths:
            # Most drops keep their layout. Spark checks every file's header while it reads, so
            # only a drop with another one is looked through for its headers first.
            try:
                take({tuple(next(csv.reader([last.value]))): paths}, batch_id)
                return
            except (PySparkException, Py4JJavaError) as error:
                if "FAILED_READ_FILE" not in str(error):
                    raise
        layouts = _layouts(spark, paths)
        if layouts:
            take(layouts, batch_id)
            common = max(layouts, key=lambda header: len(layouts[header]))
            append_row(spark, f"{state}/header", HEADER, _csv_line(common))

    writer = listing.writeStream.foreachBatch(load).trigger(availableNow=True)
    drain(writer.option("checkpointLocation", f"{state}/{FILES}").start())


def _csv_line(cells: Iterable[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(cells)
    return out.getvalue()


def _widen(
    spark: SparkSession,
    layouts: dict[tuple[str, ...], list[str]],
    fields: dict[str, StructField],
    schema_path: str,
    text_share: float,
) -> None:
    """Stores wider types for columns whose values in these files need them."""
    needed: dict[str, str] = {}
    for header, files in layouts.items():
        text = spark.read.schema(", ".join(f"`{name}` STRING" for name in header))
        text = text.options(header="true").csv(files)
        counts = []
        for i, name in enumerate(header):
            value, kind = F.col(f"`{name}`"), fields[name].dataType.simpleString()
            counts.append(F.count(value).alias(f"n{i}"))
            for j, other in enumerate([kind, *WIDER.get(kind, ())]):
                held = value.try_cast(other)
                if other == "date":
                    # A cast would take a time as well, and lose it.
                    held = F.when(F.length(F.trim(value)) <= 10, held)
                counts.append(F.count(held).alias(f"n{i}_{j}"))
        found = text.agg(*counts).first()
        for i, name in enumerate(header):
            kind, values = fields[name].dataType.simpleString(), found[f"n{i}"]
            types = [kind, *WIDER.get(kind, ())]
            held = [found[f"n{i}_{j}"] for j in range(len(types))]
            # The narrowest type that holds most; text holds all, so it has to win by a large part.
            best = max(range(len(types) - (types[-1] == "string")), key=lambda j: (held[j], -j), default=0)
            if types[-1] == "string" and held[best] < text_share * values:
                best = len(types) - 1
            if wider(needed.get(name, kind), types[best]):
                needed[name] = wider(needed.get(name, kind), types[best])
    if needed:
        stored = read_schema(spark, schema_path)
        grown = [widened(f, needed[f.name]) if f.name in needed else f for f in stored]
        save_schema(spark, schema_path, StructType(grown))


def _layouts(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header, from one job over the first splits of all files."""
    if not paths:
        return {}
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in first.collect():
        header = next(csv.reader([row.header.lstrip("\ufeff")]), [])
        if header:
            layouts.setdefault(tuple(header), []).append(row.path)
    return layouts


def read_evolving(spark: SparkSession, target: str, state: str) -> DataFrame:
    """The table written by ``ingest_csv_evolving`` with all columns seen so far."""
    return read_ingested(spark, target, state)


def backfill(spark: SparkSession, history: str, target: str, state: str) -> None:
    """Historical parquet files into the same table, once: the checkpoint skips them afterwards."""
    schema = spark.read.parquet(history).schema
    rows = with_lineage(spark.readStream.schema(schema).parquet(history))
    append_stream(rows, f"{target}/{BACKFILL}", f"{state}/{BACKFILL}")


def flow_paths(spark: SparkSession, target: str) -> dict[str, str]:
    """The flows of an ingested table that hold files."""
    paths = {flow: f"{target}/{flow}" for flow in FLOWS}
    return {flow: path for flow, path in paths.items() if _exists(spark, path)}


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def table_schema(spark: SparkSession, target: str, state: str | None) -> StructType | None:
    """The columns of an ingested table by its stored schema, where one is kept."""
    stored = read_schema(spark, f"{state}/schema") if state else None
    return ingested_schema(stored) if stored else None


def flow_schema(spark: SparkSession, flow: str, path: str, schema: StructType | None) -> StructType:
    """The columns of one flow's files, without the folders they lie in.

    New files follow the stored schema. History has its own types, the same in all its files.
    """
    if flow == FILES and schema:
        return physical_schema(schema)
    merged = spark.read.option("mergeSchema", flow == FILES).parquet(path).schema
    return StructType([f for f in merged if f.name != "batch"])


def _united(parts: dict[str, DataFrame], schema: StructType | None) -> DataFrame:
    """Flows under one schema: missing columns are NULL, values that do not fit are NULL."""
    if schema is None:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())
    shown = [
        part.select(*[F.expr(sql) for sql in conform(flow, part.schema, schema)])
        for flow, part in parts.items()
    ]
    return reduce(DataFrame.unionByName, shown)


def conform(flow: str, have: StructType, want: StructType) -> list[str]:
    """SQL for the columns of ``want`` from those of a flow's files."""
    columns = []
    for field in want:
        kind = field.dataType.simpleString()
        if flow == FILES and stored_as(field) in have.names:
            same = not earlier(field) and have[field.name].dataType == field.dataType
            sql = f"`{field.name}`" if same else field_sql(field, want)
        elif field.name in have.names:
            same = have[field.name].dataType == field.dataType
            sql = f"`{field.name}`" if same else f"try_cast(`{field.name}` AS {kind})"
        else:
            sql = f"CAST(NULL AS {kind})"
        columns.append(f"{sql} AS `{field.name}`")
    return columns


def read_ingested(spark: SparkSession, target: str, state: str | None = None) -> DataFrame:
    """All flows of an ingested table; with ``state``, under the schema stored there."""
    schema = table_schema(spark, target, state)
    parts = {}
    for flow, path in flow_paths(spark, target).items():
        shape = flow_schema(spark, flow, path, schema)
        rows = spark.read.schema(shape).parquet(path)
        parts[flow] = rows.select(*[f"`{n}`" for n in shape.names if n != RESCUED_HEADER or schema])
    return _united(parts, schema)


def stream_ingested(
    spark: SparkSession, target: str, files_per_batch: int | None = None, state: str | None = None
) -> DataFrame:
    """All flows of an ingested table as one stream."""
    schema = table_schema(spark, target, state)
    parts = {}
    for flow, path in flow_paths(spark, target).items():
        shape = flow_schema(spark, flow, path, schema)
        reader = spark.readStream.schema(shape)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        rows = reader.parquet(path)
        parts[flow] = rows.select(*[f"`{n}`" for n in shape.names if n != RESCUED_HEADER or schema])
    return _united(parts, schema)
