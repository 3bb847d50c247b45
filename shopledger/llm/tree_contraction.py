"""Subtree totals of a forest by parallel tree contraction.

Rounds alternate two steps until nothing is left. Rake takes all leaves away; their totals are known
and go to their parents. Compress takes away all nodes with a single child: every such node points
at its child, pointers are doubled in join rounds until each ends at the chain's end, and the end
moves up to the parent of the chain's top, carrying the chain's sum on its edge. After a compress
every inner node has two children or more, so the next rake takes at least half of the tree: the
number of rounds grows with the logarithm of the nodes, the joins of a round with that of the
longest chain, never with the depth.

Then the contracted nodes are expanded, last round first: a chain node's total is its sum down to
the chain's end plus the end's total.

Sums reach parents as aggregations that combine before the shuffle, so a parent of many children is
no hot key, and joins meet unique ids on both sides, but for the expansion of a long chain, whose
nodes look up one end.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import settle


def _columns(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _raked(alive: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The leaves, and the other nodes with their leaves' totals added, ``left`` children and one of them."""
    parents = alive.filter("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct()
    marked = alive.join(parents.withColumn("inner", F.lit(True)), "id", "left")
    marked = settle(marked.withColumn("inner", F.coalesce("inner", F.lit(False))), "tree-marked")
    sums = [
        F.sum(F.when(~F.col("inner"), F.col(f"v{i}") + F.col(f"e{i}")).otherwise(0)).alias(f"r{i}")
        for i in range(n)
    ]
    below = marked.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
    below = below.agg(
        *sums,
        F.count_if("inner").alias("left"),
        F.max(F.when(F.col("inner"), F.col("id"))).alias("only"),
    )
    added = [(F.col(f"v{i}") + F.col(f"r{i}")).alias(f"v{i}") for i in range(n)]
    rest = marked.filter("inner").join(below, "id")
    rest = rest.select("id", "parent", *added, *_columns("e", n), "left", "only")
    return marked.filter("NOT inner").select("id", *_columns("v", n)), settle(rest, "tree-inner")


def _compressed(inner: DataFrame, n: int) -> tuple[DataFrame | None, DataFrame]:
    """The chain nodes (id, end, w: sum from the node down to before the end), and the tree without them."""
    chain = inner.filter("left = 1")
    if chain.isEmpty():
        return None, inner.select("id", "parent", *_columns("v", n), *_columns("e", n))
    child = inner.select(
        F.col("id").alias("only"),
        (F.col("left") != 1).alias("ended"),
        *[F.col(f"e{i}").alias(f"c{i}") for i in range(n)],
    )
    steps = chain.join(child, "only").select(
        "id",
        F.col("only").alias("end"),
        "ended",
        *[(F.col(f"v{i}") + F.col(f"c{i}")).alias(f"w{i}") for i in range(n)],
    )
    steps = settle(steps, "tree-steps")
    inside = steps.filter("NOT ended").select(F.col("end").alias("id"))
    tops = settle(chain.join(inside, "id", "left_anti"), "tree-tops")
    while not steps.filter("NOT ended").isEmpty():
        ahead = steps.select(
            F.col("id").alias("end"),
            F.col("end").alias("far"),
            F.col("ended").alias("far_ended"),
            *[F.col(f"w{i}").alias(f"c{i}") for i in range(n)],
        )
        moved = steps.filter("NOT ended").join(ahead, "end").select(
            "id",
            F.col("far").alias("end"),
            F.col("far_ended").alias("ended"),
            *[(F.col(f"w{i}") + F.col(f"c{i}")).alias(f"w{i}") for i in range(n)],
        )
        steps = settle(steps.filter("ended").unionByName(moved), "tree-steps")
    top = tops.select("id", F.col("parent").alias("above"), *_columns("e", n))
    top = top.join(steps.drop("ended"), "id").select(
        F.col("end").alias("id"),
        F.lit(True).alias("moved"),
        "above",
        *[(F.col(f"e{i}") + F.col(f"w{i}")).alias(f"c{i}") for i in range(n)],
    )
    rest = inner.filter("left != 1").join(top, "id", "left")
    rest = rest.select(
        "id",
        F.when(F.col("moved"), F.col("above")).otherwise(F.col("parent")).alias("parent"),
        *_columns("v", n),
        *[F.coalesce(f"c{i}", f"e{i}").alias(f"e{i}") for i in range(n)],
    )
    return steps.drop("ended"), settle(rest, "tree-alive")


def subtree_totals(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """id and, under their names, the sums of the long columns ``values`` over each node's subtree.

    ``tree``: id (unique, any type that joins), parent (NULL for a root) and the values, of a forest
    whose parents all exist. An empty tree gives no rows; NULL values count 0.
    """
    n = len(values)
    given = [F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(f"v{i}") for i, v in enumerate(values)]
    edges = [F.lit(0).cast("long").alias(f"e{i}") for i in range(n)]
    alive = settle(tree.select("id", "parent", *given, *edges), "tree-alive")
    known, chains = [], []
    while not known or not alive.isEmpty():
        leaves, inner = _raked(alive, n)
        known.append(leaves)
        chain, alive = _compressed(inner, n)
        if chain is not None:
            chains.append(chain)
    totals = reduce(DataFrame.unionByName, known)
    for chain in reversed(chains):
        end = totals.select(F.col("id").alias("end"), *_columns("v", n))
        sums = [(F.col(f"w{i}") + F.col(f"v{i}")).alias(f"v{i}") for i in range(n)]
        totals = totals.unionByName(settle(chain.join(end, "end").select("id", *sums), "tree-totals"))
    return totals.withColumnsRenamed({f"v{i}": v for i, v in enumerate(values)})
