"""Training corpus from raw documents: quality, boilerplate, near duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents; the last
returns one row per packed piece. A document copied by the mix is packed once per copy, and its
copies, the shortened one at the mix's cut too, end in different bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import compress_quality, line_dedup, mixing, near_dedup, packing
from shopledger.llm.common import body, settle, share_package, table

# Share alone decides; only a page of its own says nothing about its source.
LEAST_PAGES = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the compression classifier accepts; it learns from the labelled ones."""
    share_package(spark)
    model = compress_quality.train(docs, table(spark, sf_dir, "labels"))
    return compress_quality.accepted(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that are boilerplate of their source, however small that is."""
    return line_dedup.strip(docs, least_pages=LEAST_PAGES)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    share_package(spark)
    return near_dedup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source up to its target, repeated where it exceeds the source."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of documents for training sequences; copies of a document are a cluster."""
    share_package(spark)
    # Near duplicates are gone by now, and the copy at a mix's cut is shorter than the others.
    same = F.coalesce(F.concat(F.lit("doc "), F.col("doc_id").cast("string")), F.md5(body()))
    return packing.pack(docs.withColumn("__cluster", same), cluster="__cluster")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mix),
    ("packing", pack),
]

# Compressed sizes and sketches cannot be stated in SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
