"""Mixing sources to target weights.

Every document gets a hash-random key. Keys are range-sorted within each source, word counts are
summed per range and prefixed over the ranges, and the source is cut where the prefix meets its
budget. What remains of the plan is one row per source: full passes, the cut key, and the words
the documents at the cut still give.

Defined cases: NULL text counts 0 words; the NULL source is a source of its own, last in order;
a source without words gets target 0; repeated rows share their key and, at the cut, share what is
left evenly (the rounding loss is below one word per copy); an empty table gives an empty mix.
Other columns, whatever their names, pass through ``mixed`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import body, settle, word_count, words
from shopledger.session import materialize

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3


def random_key(doc_id: Column, text: Column) -> Column:
    """Depends on the document alone, so reruns and lost tasks repeat it."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), text))


def sized(documents: DataFrame) -> DataFrame:
    text = body()
    return documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        random_key(F.col("doc_id"), text).alias("key"),
    )


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES
) -> DataFrame:
    """source, source_size, target: shares by weight, held at ``most`` times the source's size.

    The excess of held sources goes to the others by weight. That ends where every target is
    least(cap, level * weight); the level follows from the sources in order of cap / weight.
    One row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn % len(weights) + 1)
    listed = per_source.withColumn("_weight", weight)
    listed = listed.withColumn("_cap", F.col("source_size") * float(most))
    by_fill = Window.orderBy(
        F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(by_fill), F.lit(0.0))
    open_weight = F.sum("_weight").over(every) - F.coalesce(
        F.sum("_weight").over(by_fill), F.lit(0.0)
    )
    levels = listed.withColumn("_level", left / open_weight)
    holds = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))
    found = levels.withColumn("_level", F.max(holds).over(every))
    target = F.least(F.col("_cap"), F.col("_level") * F.col("_weight"))
    return found.select(
        "source", "source_size", F.coalesce(target, F.col("_cap")).alias("target")
    )


def cuts(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """One row per source: source_size, target, passes, cut_key, cut_words.

    ``cut_words`` is what each document at the cut key gives beyond its full passes.
    """
    want = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("passes", full.cast("long"))
    goals = goals.withColumn("_rest", want - F.col("passes") * F.col("source_size"))
    keyed = sizes.groupBy("source", "key").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies")
    )
    # Range bounds come from sampling: the numbered rows are cut from their lineage.
    ranged = keyed.repartitionByRange(F.col("source").asc_nulls_last(), "key")
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()))
    parts = ranged.groupBy("source", "_range").agg(F.sum("words").alias("_words"))
    earlier = Window.partitionBy("source").orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    rest = goals.select(F.col("source").alias("_source"), "_rest")
    met = parts.join(rest, F.col("source").eqNullSafe(F.col("_source"))).filter(
        (F.col("_before") < F.col("_rest"))
        & (F.col("_rest") <= F.col("_before") + F.col("_words"))
    )
    met = met.select(F.col("source").alias("_of"), F.col("_range").alias("_at"), "_before", "_rest")
    inside = ranged.join(
        met, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at"))
    )
    upto = Window.partitionBy("source").orderBy("key")
    inside = inside.withColumn("_prefix", F.col("_before") + F.sum("words").over(upto))
    at_cut = inside.filter(
        (F.col("_prefix") >= F.col("_rest")) & (F.col("_prefix") - F.col("words") < F.col("_rest"))
    )
    share = F.floor((F.col("_rest") - F.col("_prefix") + F.col("words")) / F.col("copies"))
    at_cut = at_cut.select(
        F.col("source").alias("_of"),
        F.col("key").alias("cut_key"),
        share.cast("long").alias("cut_words"),
    )
    planned = goals.join(at_cut, F.col("source").eqNullSafe(F.col("_of")), "left")
    return planned.drop("_of", "_rest")


def plan_mix(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """The cuts, written: Spark knows their size and broadcasts them only where that is small."""
    goals = settle(targets(sizes, weights, most), "mix-targets")
    return settle(cuts(sizes, goals).withColumnRenamed("source", "_of"), "mix-plan")


def taken(size: Column, key: Column) -> Column:
    """Words the mix takes of a document, from the columns of ``cuts``."""
    more = F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), F.col("cut_words"))
    return F.col("passes") * size + F.coalesce(more, F.lit(0))


def mix(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES
) -> DataFrame:
    """doc_id, size, source_size, target, taken per document."""
    sizes = settle(sized(documents), "mix-sizes")
    plan = plan_mix(sizes, weights, most)
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("_of")))
    give = taken(F.col("size"), F.col("key")).alias("taken")
    return joined.select("doc_id", "size", "source_size", "target", give)


def mixed(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES
) -> DataFrame:
    """The mixed documents: one row per pass; the document at a cut ends with its last word taken.

    Documents are scanned for sizes and again for the result; their texts are never shuffled.
    """
    sizes = settle(sized(documents), "mix-sizes")
    plan = plan_mix(sizes, weights, most)
    names = documents.columns
    text = body()
    rows = documents.select(
        F.struct(*[documents[name] for name in names]).alias("_row"),
        F.col("source").cast("string").alias("_source"),
        text.alias("_text"),
        random_key(F.col("doc_id"), text).alias("_key"),
    )
    joined = rows.join(plan, F.col("_source").eqNullSafe(F.col("_of")))
    below, at = F.col("_key") < F.col("cut_key"), F.col("_key") == F.col("cut_key")
    part = F.when(at & (F.col("cut_words") > 0), F.col("cut_words"))
    passes = F.col("passes") + F.when(below | part.isNotNull(), 1).otherwise(0)
    copies = joined.filter(passes > 0).withColumn(
        "_pass", F.explode(F.sequence(F.lit(1).cast("long"), passes))
    )
    cut = part.isNotNull() & (F.col("_pass") > F.col("passes"))
    short = F.array_join(F.slice(words(F.col("_text")), F.lit(1), part.cast("int")), " ")
    out = {name: F.col(f"_row.`{name}`") for name in names}
    out["text"] = F.when(cut, short).otherwise(out["text"])
    if "n_chars" in out:
        out["n_chars"] = F.when(cut, F.length(short).cast("long")).otherwise(out["n_chars"])
    return copies.select(*[column.alias(name) for name, column in out.items()])


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3.0::DOUBLE * source_size AS cap,
             CAST([1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
      FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) /
                (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size,
             least(cap, weight * max(CASE WHEN level * weight <= cap THEN level END) OVER ()) AS target
      FROM l),
h AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END AS BIGINT) AS passes
      FROM g),
r AS (SELECT *, CAST(round(target) AS BIGINT) - passes * source_size AS rest FROM h),
k AS (SELECT source, key, sum(size) AS words, count(*) AS copies,
             sum(sum(size)) OVER (PARTITION BY source ORDER BY key) AS prefix
      FROM d GROUP BY source, key)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, r.source_size, r.target,
       CAST(r.passes * d.size + CASE WHEN k.prefix <= r.rest THEN d.size
            WHEN k.prefix - k.words < r.rest THEN floor((r.rest - k.prefix + k.words) / k.copies)
            ELSE 0 END AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
       JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.key = k.key
"""
