"""Site-relative line removal.

Pages are grouped by host. A line that more than ``ratio`` of a host's pages contain is boilerplate
of that host and leaves its pages; only a line of a single page never is, as that says nothing about
the host. Exact copies of a page
count as one page: a page copied a thousand times says nothing about a site's boilerplate, and must
not lose its own text for having copies.

Counting combines on the map side before the shuffle. A host keeps at most (lines per page / ratio)
boilerplate lines, so the joined lists are bounded per host.

Defined cases: NULL text counts as empty and stays NULL; lines without a word are never dropped and
never counted; the NULL host is a host of its own; a page may lose all its lines and then is empty;
repeated rows lose the same lines; an empty table gives no rows. All columns pass through, held in
a struct meanwhile, so that no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import WORD, body, settle

RATIO = 0.05
LEAST_PAGES = 2


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _worded(line: Column) -> Column:
    return F.regexp_like(line, F.lit(WORD))


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    text: str = "text",
) -> DataFrame:
    """host, line_hash, n_pages, host_pages of every boilerplate line."""
    content = body(text)
    rows = pages.select(
        F.col(host).cast("string").alias("host"),
        F.md5(content).alias("page"),
        F.array_distinct(
            F.transform(F.filter(lines(content), _worded), lambda x: F.md5(x))
        ).alias("hashes"),
    )
    # A copy of a page has the same lines, so any of the copies stands for all.
    rows = rows.groupBy("host", "page").agg(F.first("hashes").alias("hashes"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counted = rows.select("host", F.explode("hashes").alias("line_hash"))
    counted = counted.groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n_pages"))
    counted = counted.filter(F.col("n_pages") >= least_pages)
    totals = totals.withColumnRenamed("host", "_host")
    joined = counted.join(totals, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    return joined.filter(F.col("n_pages") > ratio * F.col("host_pages"))


def strip_lines(
    pages: DataFrame,
    host: str = "source",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    text: str = "text",
) -> DataFrame:
    """``row``, the page's columns with the boilerplate gone from its text, and ``dropped`` lines."""
    bad = boilerplate(pages, host, ratio, least_pages, text)
    lists = bad.groupBy("host").agg(F.collect_set("line_hash").alias("bad"))
    # Written, so that Spark knows its size and broadcasts it only where that is small.
    lists = settle(lists, "line-lists")
    rows = pages.select(F.struct("*").alias("row"), F.col(host).cast("string").alias("of"))
    rows = rows.join(lists, F.col("of").eqNullSafe(F.col("host")), "left")
    split = lines(F.coalesce(F.col(f"row.{text}").cast("string"), F.lit("")))
    # The host's list is looked through once per page, the page's own hits once per line.
    hits = F.array_intersect(F.transform(F.filter(split, _worded), lambda x: F.md5(x)), F.col("bad"))
    rows = rows.withColumn("hits", F.coalesce(hits, F.array().cast("array<string>")))
    left = F.filter(split, lambda x: ~(_worded(x) & F.array_contains("hits", F.md5(x))))
    rows = rows.withColumn("left", F.when(F.size("hits") > 0, left).otherwise(split))
    rows = rows.withColumn("dropped", (F.size(split) - F.size("left")).cast("long"))
    given = F.col(f"row.{text}")
    changed = F.when(F.col("dropped") > 0, F.array_join("left", "\n")).otherwise(given)
    fields = [changed.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in pages.columns]
    return rows.select(F.struct(*fields).alias("row"), "dropped")


def strip(pages: DataFrame, **options: object) -> DataFrame:
    """The pages as documents: columns as before, ``n_chars`` following the text if present."""
    rows = strip_lines(pages, **options)
    text = str(options.get("text", "text"))
    columns = {c: F.col(f"row.`{c}`") for c in pages.columns}
    if "n_chars" in columns:
        size = F.length(f"row.{text}").cast("long")
        columns["n_chars"] = F.when(F.col("dropped") > 0, size).otherwise(columns["n_chars"])
    return rows.select(*[column.alias(c) for c, column in columns.items()])


SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
p AS (SELECT DISTINCT source, text FROM d),
n AS (SELECT source, count(*) AS host_pages FROM p GROUP BY source),
l AS (SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM p),
c AS (SELECT source, line, count(*) AS n_pages FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
b AS (SELECT c.source, c.line FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE n_pages >= {LEAST_PAGES} AND n_pages > {RATIO} * host_pages),
s AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS at,
             row_number() OVER () AS r FROM d),
k AS (SELECT s.doc_id, s.source, s.text,
             string_agg(s.line, chr(10) ORDER BY s.at) FILTER (b.line IS NULL) AS kept,
             count(b.line) AS dropped
      FROM s LEFT JOIN b ON s.source IS NOT DISTINCT FROM b.source AND s.line = b.line
      GROUP BY s.doc_id, s.source, s.text)
SELECT doc_id, source, dropped AS n_dropped, md5(coalesce(kept, '')) AS text_md5 FROM k
"""
