"""The registered queries of the operators; each derives its digest columns from the operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import (
    chat,
    compress_quality,
    line_dedup,
    mixing,
    near_dedup,
    ngram_trie,
    packing,
    phrase_dedup,
    pii,
    prefix_trie,
    quality_rules,
    shared_search,
    vptree,
)
from shopledger.llm.common import share_package, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vptree.nearest(rows, F.col("vec_id") % 100 == 0)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op3_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score(table(spark, sf_dir, "documents"))


def op4_compress_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return compress_quality.classify(documents, labels)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.strip_lines(table(spark, sf_dir, "documents"))
    text = F.md5(F.coalesce("row.text", F.lit("")))
    dropped = F.col("dropped").alias("n_dropped")
    return rows.select("row.doc_id", "row.source", dropped, text.alias("text_md5"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat.with_probe(table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_chat(conversations))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrase_dedup.without_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return rows.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op13_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _reachable(build: Query) -> Query:
    """Lets Python workers on this machine import the package from where the driver found it."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return build(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _reachable(f)
    for f in (
        op1_vptree,
        op2_pii,
        op3_ngram_trie,
        op4_compress_quality,
        op5_near_dedup,
        op6_packing,
        op7_mixing,
        op8_quality_rules,
        op9_line_dedup,
        op10_chat_format,
        op11_prefix_trie,
        op12_phrase_dedup,
        op13_shared_search,
    )
}
SQL = {
    "op7_mixing": mixing.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op10_chat_format": chat.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_phrase_dedup": phrase_dedup.SQL,
    "op13_shared_search": shared_search.SQL,
}
