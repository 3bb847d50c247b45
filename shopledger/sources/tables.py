"""Parquet tables: full replacement, clustering, catalog entries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from shopledger.session import COMPRESSION, freeing
from shopledger.sources.files import append_row, latest_row


VERSIONS, SLOT = "versions", "content-"
VERSION = "version long, slot int"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_table(
    df: DataFrame, path: str, accept: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """Writes ``df`` as the new content of the table at ``path`` and returns it as read back.

    The table has two folders in turn and a version row that names the one to read, appended once
    the new one is complete. A failed write leaves readers with the old content, and so does
    ``accept``, which is given the new content before it is named, if it raises.
    """
    spark = df.sparkSession
    latest = latest_row(spark, f"{path}/{VERSIONS}", VERSION)
    slot = 1 - latest.slot if latest else 0
    df.write.mode("overwrite").parquet(f"{path}/{SLOT}{slot}")
    if accept is not None:
        accept(spark.read.parquet(f"{path}/{SLOT}{slot}"))
    append_row(spark, f"{path}/{VERSIONS}", VERSION, slot)
    return read_table(spark, path)


def table_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the current content of a table written by ``replace_table``."""
    latest = latest_row(spark, f"{path}/{VERSIONS}", VERSION)
    if latest is None:
        raise FileNotFoundError(f"no table was published at {path}")
    return f"{path}/{SLOT}{latest.slot}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, path))


def _clustered(
    df: DataFrame, partition: Sequence[str], sort_by: Sequence[str | Column]
) -> DataFrameWriter:
    """The rebalance hint gathers the rows of a partition and splits large ones over several tasks.

    Sorted files keep the ranges of their row groups narrow.
    """
    gathered = df.hint("rebalance", *partition).sortWithinPartitions(*partition, *sort_by)
    return gathered.write.option("compression", COMPRESSION).partitionBy(*partition)


def replace_partitions(
    df: DataFrame, path: str, partition: Sequence[str], sort_by: Sequence[str | Column]
) -> None:
    """Replaces only the partitions that occur in ``df``."""
    writer = _clustered(df, partition, sort_by).mode("overwrite")
    with freeing(df.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_partitions(
    df: DataFrame, path: str, partition: Sequence[str], sort_by: Sequence[str | Column]
) -> None:
    with freeing(df.sparkSession):
        _clustered(df, partition, sort_by).mode("append").parquet(path)


def remove_partitions(spark: SparkSession, path: str, column: str, upto: int) -> None:
    """Removes the folders ``column=n`` of a path with n up to ``upto``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        name, _, value = entry.getPath().getName().partition("=")
        if name == column and value.isdigit() and int(value) <= upto:
            files.delete(entry.getPath(), True)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    partition: str | None = None,
) -> None:
    """Catalog entry ``layer.table`` over a parquet path; creates the layer when missing.

    Without ``schema`` the columns are those of a file; ``partition`` names a numeric folder column.
    """
    layer = name.split(".")[0]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns, folders = "", ""
    if schema is not None:
        listed = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
        columns = f"({', '.join([*listed, *([f'{partition} INT'] if partition else [])])})"
        folders = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(
        f"CREATE TABLE {name} {columns} USING parquet {folders}"
        f" LOCATION {_quoted(path)} COMMENT {_quoted(comment)}"
    )
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    if properties:
        listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def register_view(
    spark: SparkSession,
    name: str,
    query: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Catalog view ``layer.table`` over a query on paths."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in (properties or {}).items())
    extra = f"TBLPROPERTIES ({listed})" if listed else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT {_quoted(comment)} {extra} AS {query}")
