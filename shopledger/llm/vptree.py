"""Nearest neighbours by vantage-point trees, one per shard of the vectors.

Shards are dealt by a hash of the id and sized by ``shard_rows``; every row is in one. A node keeps
a vantage point and the median distance to it; a side is skipped when the triangle inequality says
it cannot hold anything nearer than the query's current k-th neighbour times ``factor``. Factor 1
is exact search; smaller factors skip more and may miss neighbours.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components take no part,
neither do rows without id; only vectors of equal length are compared; rows of one id count once,
by the smallest vector; equal vectors share a node and are told apart by id; ties go to the smaller
id; fewer candidates than k give fewer rows; an empty table gives none. Only id and vector are
read, so further columns cannot clash.
"""

from __future__ import annotations

import pickle

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import settle

SHARD_ROWS = 2_048
LEAF = 64
FACTOR = 0.75
BLOCK = 512


class VpTree:
    """Nodes in arrays; leaves are runs of distinct vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        _, first, inverse = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        inverse = inverse.ravel()
        by_vector = np.argsort(inverse, kind="stable")
        self.points = vectors[first].astype(np.float64)
        # Ids of vector v, ascending: ids[starts[v]:starts[v + 1]].
        self.ids = ids[by_vector]
        self.starts = np.searchsorted(inverse[by_vector], np.arange(len(first) + 1))
        self.leaf = leaf
        self.nodes: list[tuple] = []
        self.root = self._grow(np.arange(len(first)))

    def _grow(self, members: np.ndarray) -> int:
        if len(members) <= self.leaf:
            self.nodes.append((None, members, 0.0, -1, -1))
            return len(self.nodes) - 1
        # The vantage point is the member farthest from the first: a corner splits well.
        corner = members[np.argmax(distances(self.points[members[:1]], self.points[members])[0])]
        rest = members[members != corner]
        d = distances(self.points[[corner]], self.points[rest])[0]
        middle = float(np.median(d))
        near = d <= middle
        if near.all():
            near = np.arange(len(rest)) < len(rest) // 2
        at = len(self.nodes)
        self.nodes.append(())
        # Both bounds hold whatever the split did with ties.
        low, high = float(d[near].max()), float(d[~near].min())
        inside, outside = self._grow(rest[near]), self._grow(rest[~near])
        self.nodes[at] = (corner, (low, high), middle, inside, outside)
        return at

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, factor: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """k nearest (distance, id) per query, without the query's own id; unfilled are inf, max."""
        self.k, self.factor, self.own = k, factor, own
        self.best = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.queries = queries
        self._visit(self.root, np.arange(len(queries)))
        return self.best, self.found

    def _offer(self, who: np.ndarray, d: np.ndarray, members: np.ndarray) -> None:
        counts = np.minimum(self.starts[members + 1] - self.starts[members], self.k + 1)
        # The k + 1 smallest ids of a vector are all that can matter to one query.
        owner = np.repeat(np.arange(len(members)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        ids = self.ids[self.starts[members][owner] + within]
        d = d[:, owner]
        d = np.where(ids[None, :] == self.own[who][:, None], np.inf, d)
        ids = np.where(np.isinf(d), np.iinfo(np.int64).max, ids[None, :])
        d = np.concatenate([self.best[who], d], axis=1)
        ids = np.concatenate([self.found[who], ids], axis=1)
        order = np.lexsort((ids, d), axis=1)[:, : self.k]
        self.best[who] = np.take_along_axis(d, order, axis=1)
        self.found[who] = np.take_along_axis(ids, order, axis=1)

    def _visit(self, at: int, who: np.ndarray) -> None:
        if not len(who):
            return
        corner, bounds, middle, inside, outside = self.nodes[at]
        if corner is None:
            if len(bounds):
                self._offer(who, distances(self.queries[who], self.points[bounds]), bounds)
            return
        d = distances(self.queries[who], self.points[[corner]])
        self._offer(who, d, np.array([corner]))
        d, (low, high) = d[:, 0], bounds
        inner = d <= middle
        self._visit(inside, who[inner])
        self._visit(outside, who[~inner])
        # The other side, where its nearest possible member is not beyond the relaxed radius.
        a = who[inner]
        self._visit(outside, a[high - d[inner] <= self.factor * self.best[a, -1]])
        b = who[~inner]
        self._visit(inside, b[d[~inner] - low <= self.factor * self.best[b, -1]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, in blocks of bounded memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        difference = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.sqrt(np.einsum("ijk,ijk->ij", difference, difference))
    return out


def usable(vector: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    solid = F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(solid, F.lit(False))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """dim, shard, tree: one pickled tree per shard of ``_id``, ``_vector``, settled."""
    shards = max(1, ceil(vectors.count() / shard_rows))
    dealt = vectors.select(
        F.col("_id"),
        F.col("_vector"),
        F.size("_vector").alias("dim"),
        F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int").alias("shard"),
    )

    def grow(rows: pa.Table) -> pa.Table:
        ids = rows["_id"].to_numpy()
        dim = rows["dim"][0].as_py()
        flat = rows["_vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        points = flat.reshape(len(ids), dim)
        keep = np.lexsort((*points.T[::-1], ids))
        ids, points = ids[keep], points[keep]
        once = np.concatenate([[True], ids[1:] != ids[:-1]])
        tree = VpTree(points[once], ids[once], leaf)
        return pa.table(
            {"dim": [dim], "shard": [rows["shard"][0].as_py()], "tree": [pickle.dumps(tree, 5)]},
            schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("tree", pa.binary())]),
        )

    grown = dealt.groupBy("dim", "shard").applyInArrow(grow, "dim int, shard int, tree binary")
    return settle(grown, "vp-index")


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 10,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    leaf: int = LEAF,
    block: int = BLOCK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query row.

    Blocks of queries meet every shard; a shard answers with at most k rows per query, so what is
    merged per query is k times the number of shards.
    """
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(vector_column).cast("array<double>").alias("_vector"),
        is_query.alias("_asks"),
    ).filter(F.col("_id").isNotNull() & usable(F.col("_vector")))
    index = build_index(rows, shard_rows, leaf)
    asked = rows.filter("_asks").groupBy("_id").agg(F.min("_vector").alias("_vector"))
    asked = asked.withColumn("dim", F.size("_vector"))
    blocks = max(1, ceil(asked.count() / block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(blocks)).cast("int"))
    places = index.select("dim", "shard").groupBy("dim").agg(F.collect_list("shard").alias("_in"))
    asked = asked.join(places, "dim").withColumn("shard", F.explode("_in")).drop("_in")
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "score": [], "vec_id": []}
        if len(trees) and len(queries):
            tree: VpTree = pickle.loads(trees["tree"][0].as_py())
            own = queries["_id"].to_numpy()
            flat = queries["_vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            best, found = tree.search(flat.reshape(len(own), -1), own, k, factor)
            real = np.isfinite(best)
            out = {
                "query_id": np.repeat(own, real.sum(axis=1)),
                "score": best[real],
                "vec_id": found[real],
            }
        schema = [("query_id", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())]
        return pa.table(out, schema=pa.schema(schema))

    keys = ["dim", "shard", "block"]
    answers = index.groupBy(*keys).cogroup(asked.groupBy(*keys))
    answers = answers.applyInArrow(answer, "query_id long, score double, vec_id long")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
