"""Marts of sums and counts that are kept up to date from changes instead of being recomputed.

A batch of changes adds what the new current rows contribute and takes back what the old ones did.
Its signed sums per group are written under the batch's number, so a repeated batch replaces its own
and the content does not depend on how often it was tried. Reading adds up the folded groups and the
batches after them; folding keeps that short. Amounts are kept as whole numbers of ``UNIT`` parts,
so that adding and taking back leave no rounding behind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.functions.business import UNIT, whole
from shopledger.plans.facts import revenue_orders
from shopledger.sources.tables import read_table, remove_partitions, replace_table

RUN = "run"


def _steps(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/steps")
    except AnalysisException as error:
        # No batch yet, or all of them folded.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


@dataclass(frozen=True)
class Maintained:
    """A mart by ``keys``; ``contribute`` gives keys and long ``measures`` of every row that counts."""

    keys: Sequence[str]
    measures: Sequence[str]
    contribute: Callable[[DataFrame], DataFrame]

    def _added(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(*[F.sum(m).alias(m) for m in self.measures])

    def signed(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """Per group, what the step from ``before`` to ``after`` changes; unchanged groups are left out."""
        back = self.contribute(before)
        back = back.withColumns({m: -F.col(m) for m in self.measures})
        moved = self._added(self.contribute(after).unionByName(back))
        return moved.filter(reduce(Column.__or__, [F.col(m) != 0 for m in self.measures]))

    def record(self, path: str) -> Callable[[DataFrame, DataFrame, int], None]:
        """For ``refresh_versions``: stores the step of every batch below ``path``."""

        def changed(before: DataFrame, after: DataFrame, run: int) -> None:
            self.signed(before, after).write.mode("overwrite").parquet(f"{path}/steps/{RUN}={run}")

        return changed

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The sums per group as of the last batch; groups to which nothing is left contribute 0."""
        steps = _steps(spark, path)
        try:
            folded = read_table(spark, f"{path}/folded")
        except FileNotFoundError:
            if steps is None:
                raise
            return self._added(steps)
        if steps is None:
            return self._added(folded)
        # No row of the folded groups names a run when all groups are empty; then all steps add to 0.
        upto = folded.agg(F.coalesce(F.max(RUN), F.lit(-1)).alias("_upto"))
        steps = steps.join(F.broadcast(upto)).filter(F.col(RUN) > F.col("_upto")).drop("_upto")
        return self._added(folded.unionByName(steps))

    def fold(self, spark: SparkSession, path: str) -> None:
        """Adds the steps to the folded groups and removes them.

        The folded groups name the last step they hold, and take its place in one move, so a failure
        in between neither loses a step nor counts one twice.
        """
        steps = _steps(spark, path)
        last = steps.agg(F.max(RUN)).first()[0] if steps is not None else None
        if last is None:
            return
        now = self.read(spark, path).withColumn(RUN, F.lit(last))
        left = reduce(Column.__or__, [F.col(m) != 0 for m in self.measures])
        replace_table(now.filter(left), f"{path}/folded")
        remove_partitions(spark, f"{path}/steps", RUN, last)


def _daily_parts(orders: DataFrame) -> DataFrame:
    return revenue_orders(orders).select(
        "order_date",
        "shipping_city",
        "payment_method",
        F.coalesce(whole(F.col("total_amount")), F.lit(0)).alias("amount"),
        F.col("total_amount").isNotNull().cast("long").alias("amounts"),
        F.lit(1).cast("long").alias("orders"),
        F.coalesce(F.col("quantity").cast("long"), F.lit(0)).alias("items"),
        F.col("quantity").isNotNull().cast("long").alias("counted"),
    )


DAILY_REVENUE = Maintained(
    keys=("order_date", "shipping_city", "payment_method"),
    measures=("amount", "amounts", "orders", "items", "counted"),
    contribute=_daily_parts,
)


def daily_revenue(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``marts.daily_revenue`` from the maintained sums."""
    sums = DAILY_REVENUE.read(spark, path).filter("orders > 0")
    amount = F.when(F.col("amounts") > 0, F.col("amount") / UNIT)
    return sums.select(
        *DAILY_REVENUE.keys,
        amount.alias("daily_revenue"),
        F.col("orders").alias("order_count"),
        (amount / F.col("amounts")).alias("avg_order_value"),
        F.when(F.col("counted") > 0, F.col("items")).alias("total_items_sold"),
    )
