"""Conflict-constrained best-fit packing.

Documents are dealt evenly over tasks. Each task packs its share, largest first: bins are ordered
by their residual room, and the search starts at the successor of the document's size and goes on
until the tightest bin is found that the document may join. Every bin carries a bitmap of the
duplicate clusters and bitmaps of the sources it holds: no two members of a cluster share a bin,
and at most ``per_source`` documents of a source do. Texts beyond the capacity fill whole bins;
their last piece is packed like a document.

Defined cases: NULL text and texts without words need no room and get no bin; NULL source is a
source of its own, NULL cluster never conflicts; ties go by doc_id; repeated rows are documents of
their own and, being of one cluster, end in different bins; an empty table gives no rows. Only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import body, word_count

CAPACITY = 4096
PER_SOURCE = 4
SHARE = 8_000
SCHEMA = "doc_id long, piece int, n_words long, bin_id long, start long"


class Bins:
    """Open bins by residual room, with their bitmaps."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity = capacity
        self.planes = per_source
        self.open: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and start of a document; ``source`` and ``cluster`` are one-bit masks, or 0."""
        at = bisect_left(self.open, (size, -1))
        while at < len(self.open):
            room, b = self.open[at]
            if not (self.clusters[b] & cluster or self.sources[b][-1] & source):
                del self.open[at]
                break
            at += 1
        else:
            room, b = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.planes)
        self.clusters[b] |= cluster
        for level, plane in enumerate(self.sources[b]):
            if not plane & source:
                self.sources[b][level] |= source
                break
        if room > size:
            insort(self.open, (room - size, b))
        return b, self.capacity - room


def pack_share(rows: pd.DataFrame, capacity: int, per_source: int) -> list[tuple]:
    """(doc_id, piece, words, bin, start) of one share of documents, bins numbered from 0."""
    bins = Bins(capacity, per_source)
    shared = Counter(c for c in rows["cluster"] if c is not None)
    cluster_bit = {c: 1 << i for i, c in enumerate(c for c, n in shared.items() if n > 1)}
    source_bit: dict[object, int] = {}
    out, pieces = [], []
    for doc, size, source, cluster in rows.itertuples(index=False, name=None):
        whole, rest = divmod(size, capacity)
        out += [(doc, p, capacity) for p in range(whole)]
        if rest:
            pieces.append((rest, doc, whole, source, cluster))
    for source in rows["source"]:
        source_bit.setdefault(source, 1 << len(source_bit))
    last = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2], str(x[4]))
    placed = [
        (doc, piece, size, *bins.place(size, source_bit[source], cluster_bit.get(cluster, 0)))
        for size, doc, piece, source, cluster in sorted(pieces, key=last)
    ]
    n = len(bins.clusters)
    return placed + [(*row, n + i, 0) for i, row in enumerate(out)]


def pack(
    documents: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    share: int = SHARE,
    cluster: str | None = None,
) -> DataFrame:
    """doc_id, piece, n_words, bin_id, start: one row per piece, in words.

    ``cluster`` names a column of duplicate clusters; without one, equal texts are a cluster.
    """
    text = body()
    marks = F.col(cluster).cast("string") if cluster else F.md5(text)
    slim = documents.select(
        "doc_id",
        word_count(text).alias("size"),
        F.col("source").cast("string").alias("source"),
        marks.alias("cluster"),
    )
    shares = max(1, ceil(documents.count() / share))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)  # one share
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).astype(object)
        rows = rows.where(rows.notna(), None)
        first = TaskContext.get().partitionId() << 32
        result = [
            (doc, piece, size, first + b, start)
            for doc, piece, size, b, start in pack_share(rows, capacity, per_source)
        ]
        result += [(d, 0, 0, None, None) for d, s in zip(rows["doc_id"], rows["size"]) if s == 0]
        names = ["doc_id", "piece", "n_words", "bin_id", "start"]
        frame = pd.DataFrame(result, columns=names)
        yield frame.astype({n: "Int32" if n == "piece" else "Int64" for n in names})

    # Dealt evenly whatever the values are; Spark orders the rows first, so a rerun deals the same.
    return slim.repartition(shares).mapInPandas(run, SCHEMA)
