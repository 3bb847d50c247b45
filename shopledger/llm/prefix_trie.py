"""Prefix trie of conversations, with totals of every subtree by parallel tree contraction.

Conversations are numbered, rebuilt on the first turns of their group's head, and every sequence of
first turns becomes a node. A node is known by the sum of position-dependent hashes of its turns (two
times 60 bits), so prefixes are running sums and a node's parent is its own sum without its last
turn: neither needs a join. Running sums and turn numbers are taken within ranges of (conversation,
position) and carried over the range borders, so a conversation of any length is no group of one
task. Nodes are aggregations over the prefixes and combine before the shuffle, so a turn or a
conversation that many share is no hot key either. Totals over subtrees come from
``tree_contraction``.

The digest of the members that end in a node is one digest over one text and thus made in one task;
it is made from pieces joined in ranges before, and holds one piece at a time.

Defined cases: NULL turns come first, equal turns go by role and text; NULL roles and texts are
empty; rows without conv_id take no part; repeated rows are turns of their own; the head of a
negative conv_id is the next multiple towards zero; an empty table gives no rows. Only conv_id, turn,
role and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import body, parallelism, settle, word_count
from shopledger.llm.near_dedup import mixed
from shopledger.llm.tree_contraction import subtree_totals

GROUP = 20
HEADS = 4
PIECE_CHARS = 65_536

_BITS = 2**60
_MASK = np.uint64(_BITS - 1)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _head(conv_id: Column) -> Column:
    return conv_id - conv_id % GROUP


def _places(conv_ids: np.ndarray, last: int | None, count: int) -> np.ndarray:
    """Places of sorted rows within their conversation, going on from ``count`` rows of ``last``."""
    n = len(conv_ids)
    starts = np.flatnonzero(np.concatenate([[True], conv_ids[1:] != conv_ids[:-1]]))
    first = np.repeat(starts, np.diff(np.concatenate([starts, [n]])))
    at = np.arange(n) - first
    return at + np.where((conv_ids == last) & (first == 0), count, 0) if last is not None else at


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place of the turn, from 0), digest (of role and text), words."""
    text, role = body("text"), body("role")
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        word_count(text).alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    # ``row`` only keeps copies of a row from all having to be in one range.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    parts = parallelism(conversations.sparkSession)
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv_ids = np.asarray(batch.column("conv_id"))
            at = _places(conv_ids, last, count)
            last, count = conv_ids[-1], int(at[-1]) + 1
            arrays = [batch.column("conv_id"), pa.array(np.full(len(at), part, np.int64)), pa.array(at)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, batch.column("digest"), batch.column("words")],
                names=["conv_id", "part", "at", "digest", "words"],
            )

    schema = "conv_id long, part long, at long, digest binary, words long"
    rows = settle(rows.select("conv_id", "digest", "words").mapInArrow(run, schema), "trie-turns")
    runs = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(_earlier())
    carried = runs.select("conv_id", "part", before.alias("before")).filter("before > 0")
    # One row per range at most: only a range's first conversation began before it.
    rows = rows.join(settle(carried, "trie-carried"), ["conv_id", "part"], "left")
    at = F.col("at") + F.coalesce("before", F.lit(0))
    return rows.select("conv_id", at.alias("at"), "digest", "words")


def _earlier() -> Window:
    """Earlier ranges of the same conversation; one row per conversation and range."""
    by_part = Window.partitionBy("conv_id").orderBy("part")
    return by_part.rowsBetween(Window.unboundedPreceding, -1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, at, digest, words of the rebuilt turns, and conv_id of every conversation."""
    convs = turns.select("conv_id").distinct()
    heads = turns.filter((F.col("at") < HEADS - 1) & (F.col("conv_id") % GROUP == 0))
    heads = heads.groupBy(F.col("conv_id").alias("head")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("turns")
    )
    # A head serves the conversations of its group only.
    own = convs.withColumn("head", _head(F.col("conv_id"))).join(heads, "head", "left")
    first = F.slice(F.coalesce("turns", F.array()), 1, _shared_turns(F.col("conv_id")).cast("int"))
    own = settle(own.select("conv_id", first.alias("first")), "trie-heads")
    given = own.select("conv_id", F.explode("first").alias("t")).select("conv_id", "t.*")
    after = turns.filter(F.col("at") >= _shared_turns(F.col("conv_id")))
    after = after.join(own.select("conv_id", F.size("first").alias("n_first")), "conv_id")
    at = F.col("at") - _shared_turns(F.col("conv_id")) + F.col("n_first")
    rows = given.unionByName(after.select("conv_id", at.alias("at"), "digest", "words"))
    return rows, own.select("conv_id")


def _folded(total: Column) -> Column:
    return F.pmod(total, F.lit(_BITS)).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, id and parent (structs), words of the last turn: every prefix but the empty one."""
    parts = parallelism(turns.sparkSession)
    rows = turns.repartitionByRange(parts, "conv_id", "at").sortWithinPartitions("conv_id", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carry = TaskContext.get().partitionId(), None, np.zeros(2, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv_ids, at = np.asarray(batch.column("conv_id")), np.asarray(batch.column("at"))
            raw = b"".join(batch.column("digest").to_pylist())
            halves = np.frombuffer(raw, np.uint64).reshape(-1, 2)
            place = mixed(at.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            own = np.stack([mixed(halves[:, 0] + place), mixed(halves[:, 1] ^ place)], axis=1)
            sums = np.cumsum(own, axis=0, dtype=np.uint64)
            first = np.arange(len(at)) - _places(conv_ids, None, 0)
            sums -= np.where((first > 0)[:, None], sums[np.maximum(first - 1, 0)], np.uint64(0))
            sums += np.where(((conv_ids == last) & (first == 0))[:, None], carry, np.uint64(0))
            last, carry = conv_ids[-1], sums[-1]
            columns = [c.astype(np.int64) for c in [*(sums & _MASK).T, *(own & _MASK).T]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(np.full(len(at), part, np.int64)),
                    pa.array(at + 1),
                    batch.column("words"),
                    *map(pa.array, columns),
                ],
                names=["conv_id", "part", "depth", "words", "s1", "s2", "f1", "f2"],
            )

    schema = "conv_id long, part long, depth long, words long, s1 long, s2 long, f1 long, f2 long"
    rows = settle(rows.select("conv_id", "at", "digest", "words").mapInArrow(run, schema), "trie-sums")
    runs = rows.groupBy("conv_id", "part").agg(F.max_by(F.struct("s1", "s2"), "depth").alias("s"))
    wide = [F.sum(F.col(f"s.s{i}").cast("decimal(20,0)")).over(_earlier()) for i in (1, 2)]
    carried = runs.select(
        "conv_id", "part", _folded(wide[0]).alias("b1"), _folded(wide[1]).alias("b2")
    ).filter("b1 IS NOT NULL")
    # One row per range at most, as above.
    rows = rows.join(settle(carried, "trie-carried"), ["conv_id", "part"], "left")
    total = [_folded(F.col(f"s{i}") + F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)]
    above = [_folded(total[i] - F.col(f"f{i + 1}")) for i in (0, 1)]
    return rows.select(
        "conv_id",
        "depth",
        F.struct(total[0].alias("a"), total[1].alias("b")).alias("id"),
        F.struct(above[0].alias("a"), above[1].alias("b")).alias("parent"),
        "words",
    )


def _root() -> Column:
    zero = F.lit(0).cast("long")
    return F.struct(zero.alias("a"), zero.alias("b"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """id, ends_sha256: SHA-256 of the ascending, comma-joined conv_ids per id of (id, conv_id)."""
    order = ["id", "conv_id"]
    rows = ends.select("id.a", "id.b", "conv_id")
    order, parts = ["a", "b", "conv_id"], parallelism(ends.sparkSession)
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        node, held, size, number = None, [], 0, 0
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 4, pa.string()))],
                names=["a", "b", "part", "number", "piece"],
            )

        for batch in batches:
            for a, b, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (node != (a, b) or size > PIECE_CHARS):
                    out.append((*node, part, number, ",".join(held)))
                    held, size, number = [], 0, number + 1
                    if len(out) == 64:
                        yield batch_of(out)
                        out = []
                node = (a, b)
                held.append(str(conv_id))
                size += len(held[-1]) + 1
        if held:
            out.append((*node, part, number, ",".join(held)))
        if out:
            yield batch_of(out)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                names=["a", "b", "ends_sha256"],
            )

        for batch in batches:
            done = []
            for a, b, piece in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "piece"))):
                if node == (a, b):
                    digest.update(b"," + piece.encode())
                    continue
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256(piece.encode())
            if done:
                yield batch_of(done)
        if node is not None:
            yield batch_of([(*node, digest.hexdigest())])

    schema = "a long, b long, part long, number long, piece string"
    joined = settle(rows.mapInArrow(pieces, schema), "trie-pieces")
    joined = joined.repartition("a", "b").sortWithinPartitions("a", "b", "part", "number")
    found = joined.mapInArrow(digests, "a long, b long, ends_sha256 string")
    return found.select(F.struct("a", "b").alias("id"), "ends_sha256")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(numbered(conversations))
    rows = settle(prefixes(turns), "trie-prefixes")
    nodes = rows.groupBy("id").agg(
        F.first("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("words").alias("words"),
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = root.filter("n_convs > 0").select(
        _root().alias("id"),
        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"),
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        "n_convs",
        F.lit(0).cast("long").alias("words"),
    )
    nodes = settle(nodes.unionByName(root), "trie-nodes")
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
    kids = kids.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = nodes.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    last = rows.groupBy("conv_id").agg(F.max_by("id", "depth").alias("id"))
    ends = convs.join(last, "conv_id", "left").select(F.coalesce("id", _root()).alias("id"), "conv_id")
    # A parent of very many children is met by the adaptive skew join: one lookup row, many nodes.
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "id").join(ends_digest(ends), "id", "left")
    out = out.join(parents, "parent", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST,
                            coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id FROM t),
h AS (
  SELECT conv_id, xor(list_reduce([4294967295] || list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
         lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda a, y: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)),
         4294967295) % 4 AS h FROM c),
g AS (
  SELECT h.conv_id, t.role, t.text, 0 AS own, t.i
  FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.i < h.h
  UNION ALL
  SELECT t.conv_id, t.role, t.text, 1 AS own, t.i FROM h JOIN t ON t.conv_id = h.conv_id AND t.i >= h.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, text,
         md5(string_agg(md5(role || chr(31) || text), '') OVER w) AS id
  FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY own, i
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (
  SELECT conv_id, depth, id, text FROM p
  UNION ALL SELECT conv_id, 0, 'root', '' FROM c),
n AS (
  SELECT id, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
         any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS words
  FROM a GROUP BY id),
u AS (
  SELECT n.id, n.conv_id, n.depth, n.n_convs, n.words, b.id AS parent
  FROM n LEFT JOIN a b ON b.conv_id = n.conv_id AND b.depth = n.depth - 1),
k AS (SELECT parent AS id, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
s AS (
  SELECT b.id, sum(CASE WHEN k.id IS NULL THEN 1 ELSE 0 END) AS n_leaves,
         sum((n.n_convs - 1) * n.words) AS saved
  FROM n JOIN a b ON b.conv_id = n.conv_id AND b.depth <= n.depth LEFT JOIN k ON k.id = n.id
  GROUP BY b.id),
l AS (SELECT conv_id, max_by(id, depth) AS id FROM a GROUP BY conv_id),
e AS (SELECT id, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends FROM l GROUP BY id)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, u.n_convs,
       coalesce(k.n_children, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM u JOIN s ON s.id = u.id LEFT JOIN k ON k.id = u.id LEFT JOIN e ON e.id = u.id
LEFT JOIN n q ON q.id = u.parent
"""
