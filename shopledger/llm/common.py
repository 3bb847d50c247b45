"""Pieces the operators share: word rule, ASCII folding, tables cut in the shared folder."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def share_package(spark: SparkSession) -> None:
    """Adds the package's folder to the workers' path; a cluster has the package installed."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    Later steps may use it several times, survive lost executors, and prune its columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def body(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def token_list(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes split on exactly 0x20 and 0x09-0x0D."""
    return (text or "").encode("utf-8", "replace").lower().split()


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
