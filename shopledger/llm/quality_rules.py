"""Quality rules whose thresholds follow the data.

Base counts are taken per text. Ratios of them go into one KLL sketch per language and source;
the sketches merge into one per language and one for all. A text is judged by the fences of its
own group, or of the wider one while its group has too few texts to have quartiles worth using.

Defined cases: NULL and empty texts hold no words and fail the base rules; NULL language or source
is a group of its own; repeated rows each get a row; an empty table gives no rows. Only doc_id,
text, lang and source are read, so further columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import WORD, body, settle, words

LEAST_WORDS = 50
MOST_REPEATED = 50
# Ratio -> least distance between quartiles; both fences where low is True.
RATIOS = {
    "word_length": (0.15, True),
    "symbols": (0.01, False),
    "dup_lines": (0.1, False),
    "repeats": (0.1, False),
    "shouted": (0.02, False),
}
REACH = 4.0
LEAST_GROUP = 200
SKETCH_K = 4096


def _without(text: Column, characters: str) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)


def counts(documents: DataFrame) -> DataFrame:
    """The base counts per text, in linear or n log n work within the row."""
    text = body("_text")
    rows = documents.select("doc_id", "lang", "source", F.col("text").alias("_text"))
    rows = rows.withColumn("_words", words(text))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD)))
    rows = rows.withColumn("_lines", lines)
    # Windows as (hash, place) in order: equal neighbours are windows found more than once.
    last = F.size("_words") - 3
    window = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)),
        lambda i: F.struct(
            F.xxhash64(
                F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)
            ).alias("h"),
            i.alias("at"),
        ),
    )
    rows = rows.withColumn("_windows", F.sort_array(window))

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get("_windows", i - 1), F.get("_windows", i + 1)
        same = F.coalesce(before["h"] == x["h"], F.lit(False))
        return same | F.coalesce(after["h"] == x["h"], F.lit(False))

    found = F.transform(F.filter("_windows", repeated), lambda x: x["at"])
    rows = rows.withColumn("_found", F.sort_array(found))
    covered = F.aggregate(
        F.transform(
            "_found",
            lambda at, i: F.coalesce(F.least(F.lit(3), F.get("_found", i + 1) - at), F.lit(3)),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("_words").cast("long").alias("n_words"),
        F.length(_without(text, " \t\n\v\f\r")).cast("long").alias("word_chars"),
        (F.size(F.split(text, "[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}{3,}")).cast("long").alias("_n_shouted"),
    )


def _ratios() -> dict[str, Column]:
    per_word = F.when(F.col("n_words") > 0, F.col("n_words"))
    return {
        "word_length": F.col("word_chars") / per_word,
        "symbols": F.col("n_symbols") / per_word,
        "dup_lines": F.col("n_dup_lines") / F.when(F.col("_n_lines") > 0, F.col("_n_lines")),
        "repeats": F.col("n_repeat_words") / per_word,
        "shouted": F.col("_n_shouted") / per_word,
    }


def base_failed() -> Column:
    short = F.col("n_words") < LEAST_WORDS
    return short | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def thresholds(measured: DataFrame, least_group: int = LEAST_GROUP) -> DataFrame:
    """One row per language and source with the fences that apply to it."""
    sketches = [F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(n) for n, c in _ratios().items()]
    known = measured.filter(F.col("n_words") > 0)
    own = settle(
        known.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *sketches), "rule-sketch"
    )
    merged = [F.kll_merge_agg_double(n, F.lit(SKETCH_K)).alias(f"_{n}") for n in RATIOS]
    wide = own.groupBy("lang").agg(F.sum("n").alias("_n"), *merged)
    wide = wide.withColumnRenamed("lang", "_lang")
    everything = own.agg(*[m.alias(f"_all{i}") for i, m in enumerate(merged)])
    rows = own.join(wide, F.col("lang").eqNullSafe(F.col("_lang"))).crossJoin(
        F.broadcast(everything)  # a single row
    )
    fences = []
    for i, (name, (least, low)) in enumerate(RATIOS.items()):
        chosen = (
            F.when(F.col("n") >= least_group, F.col(name))
            .when(F.col("_n") >= least_group, F.col(f"_{name}"))
            .otherwise(F.col(f"_all{i}"))
        )
        q1 = F.kll_sketch_get_quantile_double(chosen, F.lit(0.25))
        q3 = F.kll_sketch_get_quantile_double(chosen, F.lit(0.75))
        reach = REACH * F.greatest(q3 - q1, F.lit(least))
        fences.append((q3 + reach).alias(f"_hi_{name}"))
        if low:
            fences.append((q1 - reach).alias(f"_lo_{name}"))
    return rows.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *fences)


def judge(documents: DataFrame, least_group: int = LEAST_GROUP) -> DataFrame:
    """doc_id, the base counts, base_failed and kept per text."""
    measured = settle(counts(documents), "rule-counts")
    fences = thresholds(measured, least_group)
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    inside = F.lit(True)
    for name, ratio in _ratios().items():
        inside &= F.coalesce(ratio <= F.col(f"_hi_{name}"), F.lit(True))
        if RATIOS[name][1]:
            inside &= F.coalesce(ratio >= F.col(f"_lo_{name}"), F.lit(True))
    failed = base_failed()
    return measured.join(fences, same, "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & inside).alias("kept"),
    )
