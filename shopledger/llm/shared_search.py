"""Ranked lexical search of many items at once, sharing what the items have in common.

Items come in blocks of bounded size. For a block, every use of a term by an item is a unit; units
used by the same items form one shared term set, whose sum over a document is the same for all of
them. Sets that several items combine are paired greedily, the pair shared by most items first, so
that the block becomes a graph of sums: a leaf is a term set, an inner node adds two nodes, an item
adds what is left over for it. A document's accumulators are filled once per term set and then
combined along the graph, in whole numbers, so the order of adding does not matter.

Documents are read once per block into their postings of the block's terms (written to the shared
folder), document frequencies are counted from these, and a second pass scores. A task keeps the
best ``top`` documents per item of all it has seen; only these rows are shuffled, so no row is made
per document and item.

Score, as in BM25 with k1 = 1.2 and b = 0.25 in whole numbers: see ``impacts``.

Defined cases: NULL, empty and termless texts have no terms and take no part in any count; an item
without terms, or without a document above 0, returns no row; every row of the items is an item of
its own, equal ids included, and so is every row of the documents; rows without doc_id count and may
be returned, after all others of their score; empty tables give no rows. Only item_id, doc_id and
text are read, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import body, settle

TOP = 20
BLOCK_ITEMS = 512
BLOCK_CHARS = 1_000_000
SCORE_ROWS = 256
MERGE_PARTS = 64

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    c if c >= 0x80 or c in _KEPT else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def terms(text: str | bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()


class SharedPlan:
    """The sums of a block of items: ``leaves`` of terms, ``joins`` of two nodes, ``items`` of nodes."""

    def __init__(self, items: list[list[bytes]]):
        uses: dict[bytes, list[Counter]] = defaultdict(list)
        for i, item in enumerate(items):
            for term, times in Counter(item).items():
                for level in range(times):
                    while len(uses[term]) <= level:
                        uses[term].append(Counter())
                    uses[term][level][i] = 1
        self.vocabulary = {term: at for at, term in enumerate(sorted(uses))}
        groups: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for term, at in self.vocabulary.items():
            for users in uses[term]:
                groups[tuple(sorted(users))].append(at)
        self.leaves = [groups[users] for users in sorted(groups)]
        parts: list[set[int]] = [set() for _ in items]
        for leaf, users in enumerate(sorted(groups)):
            for i in users:
                parts[i].add(leaf)
        self.joins = self._pair(parts)
        self.items = [sorted(p) for p in parts]

    def _pair(self, parts: list[set[int]]) -> list[tuple[int, int]]:
        """Replaces the pair of nodes most items share by a node of their sum, while two items share one."""
        holders: dict[int, set[int]] = defaultdict(set)
        for i, nodes in enumerate(parts):
            for node in nodes:
                holders[node].add(i)
        shared = {node for node, users in holders.items() if len(users) > 1}
        counts: Counter = Counter()
        for nodes in parts:
            common = sorted(nodes & shared)
            counts.update((a, b) for k, a in enumerate(common) for b in common[k + 1 :])
        heap = [(-n, pair) for pair, n in counts.items() if n > 1]
        heapq.heapify(heap)
        joins: list[tuple[int, int]] = []
        while heap:
            n, (a, b) = heapq.heappop(heap)
            users = holders[a] & holders[b]
            if len(users) < 2:
                continue
            if len(users) < -n:
                heapq.heappush(heap, (-len(users), (a, b)))
                continue
            node = len(self.leaves) + len(joins)
            joins.append((a, b))
            near: Counter = Counter()
            for i in users:
                parts[i] -= {a, b}
                near.update(parts[i] & shared)
                parts[i].add(node)
            holders[a] -= users
            holders[b] -= users
            holders[node] = set(users)
            shared.add(node)
            for other, times in near.items():
                if times > 1:
                    heapq.heappush(heap, (-times, (other, node)))
        return joins

    def compiled(self) -> tuple[np.ndarray, ...]:
        """Flat arrays of the graph: terms by leaf, leaf starts, joins, nodes by item, item starts."""

        def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
            sizes = np.cumsum([0, *map(len, lists)])
            return np.array([x for part in lists for x in part], np.int64), sizes

        joins = np.array(self.joins, np.int64).reshape(-1, 2)
        return *flat(self.leaves), joins, *flat(self.items)


def item_blocks(items: DataFrame, block_items: int, block_chars: int) -> Iterator[list[tuple]]:
    """Blocks of (item_id, terms), streamed to the driver one bounded block at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), body().alias("text"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        found = terms(row["text"])
        if not found:
            continue
        if block and (len(block) >= block_items or size + len(row["text"]) > block_chars):
            yield block
            block, size = [], 0
        block.append((row["item_id"], found))
        size += len(row["text"])
    if block:
        yield block


def postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), ids and tfs of the vocabulary's terms, of texts with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            rows: dict[str, list] = {"doc_id": [], "n": [], "ids": [], "tfs": []}
            for doc_id, text in zip(doc_ids, batch.column("text")):
                found = terms(text.as_buffer().to_pybytes() if text.is_valid else b"")
                if not found:
                    continue
                hits = [t for t in map(known, found) if t is not None]
                ids, tfs = np.unique(np.array(hits, np.int32), return_counts=True)
                rows["doc_id"].append(doc_id)
                rows["n"].append(len(found))
                rows["ids"].append(ids)
                rows["tfs"].append(tfs.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["doc_id"], pa.int64()),
                    pa.array(rows["n"], pa.int64()),
                    pa.array(rows["ids"], pa.list_(pa.int32())),
                    pa.array(rows["tfs"], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "ids", "tfs"],
            )

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    return read.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>")


def weight(df: int, total: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def impacts(
    weights: np.ndarray, tfs: np.ndarray, n: np.ndarray, total: int, length: int
) -> np.ndarray:
    """weight * ((10^9 tf) div (1000 tf + 12 m)), m = 75 + (25 n total) div length, rounding down."""
    m = 100 - 25 + (25 * n * total) // length
    return weights * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m))


def scored(
    rows: DataFrame, plan: SharedPlan, weights: np.ndarray, total: int, length: int, top: int
) -> DataFrame:
    """item (its place in the block), doc_id, score: the best ``top`` of every task."""
    leaf_terms, leaf_at, joins, item_nodes, item_at = plan.compiled()
    n_leaves, n_nodes = len(plan.leaves), len(plan.leaves) + len(joins)
    n_items, n_terms = len(plan.items), len(weights)

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        """Scores of all the block's items (rows) for the batch's documents (columns)."""
        ids, tfs = batch.column("ids"), batch.column("tfs")
        sizes = np.diff(np.asarray(ids.offsets))
        terms_, counts = np.asarray(ids.flatten()), np.asarray(tfs.flatten())
        doc = np.repeat(np.arange(len(batch)), sizes)
        n = np.asarray(batch.column("n"))[doc]
        impact = np.zeros((n_terms, len(batch)), np.int64)
        impact[terms_, doc] = impacts(weights[terms_], counts, n, total, length)
        nodes = np.empty((n_nodes, len(batch)), np.int64)
        nodes[:n_leaves] = np.add.reduceat(impact[leaf_terms], leaf_at[:-1], axis=0)
        for at, (a, b) in enumerate(joins, n_leaves):
            np.add(nodes[a], nodes[b], out=nodes[at])
        return np.add.reduceat(nodes[item_nodes], item_at[:-1], axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(n_items)]
        last = np.int64(2**63 - 1)
        floor = np.zeros(n_items, np.int64)
        for whole in batches:
            for begin in range(0, len(whole), SCORE_ROWS):
                batch = whole.slice(begin, SCORE_ROWS)
                doc_ids = batch.column("doc_id").fill_null(last).to_numpy(zero_copy_only=False)
                scores = sums(batch)
                # Equal scores may still win by their id, so the floor itself passes.
                for i in np.nonzero((scores >= np.maximum(floor, 1)[:, None]).any(axis=1))[0]:
                    new = scores[i] >= max(floor[i], 1)
                    s = np.concatenate([best[i][0], scores[i][new]])
                    d = np.concatenate([best[i][1], doc_ids[new]])
                    order = np.lexsort((d, -s))[:top]
                    best[i] = s[order], d[order]
                    if len(order) == top:
                        floor[i] = s[order[-1]]
        items = np.repeat(np.arange(n_items), [len(s) for s, _ in best])
        ids = np.concatenate([d for _, d in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(items, pa.int64()),
                pa.array(ids, pa.int64(), mask=ids == last),
                pa.array(np.concatenate([s for s, _ in best]), pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def _best(found: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(
    documents: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block_items: int = BLOCK_ITEMS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """item_id, rank, doc_id, score of every item's best documents."""
    spark = documents.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, block_items, block_chars):
        plan = SharedPlan([found for _, found in block])
        rows = settle(postings(documents, plan.vocabulary), "search-postings")
        totals = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
        if not totals["docs"]:
            break
        held = rows.select(F.explode("ids").alias("term")).groupBy("term").count()
        df = dict(map(tuple, held.collect()))  # one row per term of the block at most
        weights = np.array([weight(df.get(t, 0), totals["docs"]) for t in range(len(plan.vocabulary))])
        found = scored(rows, plan, weights, totals["docs"], totals["length"], top)
        found = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS)))
        found = _best(_best(found, top, "item", "part").drop("rank", "part"), top, "item")
        names = spark.createDataFrame(
            [(at, item_id) for at, (item_id, _) in enumerate(block)], "item long, item_id long"
        )
        named = found.join(F.broadcast(names), "item")
        out = out.unionByName(settle(named.select("item_id", "rank", "doc_id", "score"), "search-found"))
    return out


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count(*) AS total, CAST(sum(len(terms)) AS BIGINT) AS length FROM d WHERE len(terms) > 0),
p AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
t AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
      FROM p GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (SELECT item_id, row_number() OVER () AS q, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
u AS (SELECT q, any_value(item_id) AS item_id, term, count(*) AS times FROM i GROUP BY q, term),
e AS (SELECT u.q, u.item_id, t.r, t.doc_id, u.times
        * CAST(floor(1000 * ln((2.0 * s.total + 2) / (2.0 * f.df + 1))) AS BIGINT)
        * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * t.n * s.total) // s.length))) AS part
      FROM u JOIN t ON u.term = t.term JOIN f ON f.term = t.term CROSS JOIN s),
g AS (SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
             CAST(sum(part) AS BIGINT) AS score FROM e GROUP BY q, r),
k AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
      FROM g WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""
