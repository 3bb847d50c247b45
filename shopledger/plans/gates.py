"""Conditions on a whole table that decide whether it is published.

A gate names SQL aggregates over the new rows, conditions on their results and columns that no two
rows share. The aggregates are observed while the rows are written, so they cost no scan of their
own; shared keys are counted on the written rows, reading the key columns only. A condition holds
only when TRUE, as a rule of a row does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopledger.session import moment
from shopledger.sources.tables import replace_table

DUPLICATES = "no_duplicates"


class GateClosed(RuntimeError):
    """The new content of a table broke its gate; readers keep the old one."""

    def __init__(self, table: str, broken: Sequence[str], found: Mapping[str, object]) -> None:
        super().__init__(f"{table} was not published, broken: {', '.join(broken)}; found {dict(found)}")
        self.table = table
        self.broken = list(broken)
        self.found = dict(found)


@dataclass(frozen=True)
class Gate:
    """``measures``: aggregates by name; ``conditions``: SQL over these names and ``now``, by name."""

    measures: Mapping[str, str] = field(default_factory=dict)
    conditions: Mapping[str, str] = field(default_factory=dict)
    unique: Sequence[str] = ()

    def aggregates(self) -> list[Column]:
        return [F.expr(sql).alias(name) for name, sql in self.measures.items()]

    def broken(
        self, spark: SparkSession, found: Mapping[str, object], now: datetime | str | None = None
    ) -> list[str]:
        """Names of the conditions that do not hold for the measured values."""
        if not self.conditions:
            return []
        values = [F.lit(found[name]).alias(name) for name in self.measures]
        row = spark.range(1).select(*values, moment(now).alias("now"))
        held = row.select(*[F.expr(sql).alias(name) for name, sql in self.conditions.items()]).first()
        return [name for name in self.conditions if held[name] is not True]

    def shared(self, rows: DataFrame) -> int:
        """How many keys more than one row has."""
        counted = rows.groupBy(*self.unique).agg(F.count(F.lit(1)).alias("n"))
        return counted.filter("n > 1").count()


def publish_table(
    df: DataFrame,
    path: str,
    name: str,
    gate: Gate | None = None,
    now: datetime | str | None = None,
) -> DataFrame:
    """``replace_table`` behind a gate; raises ``GateClosed`` and moves nothing when it is closed."""
    if gate is None:
        return replace_table(df, path)
    spark = df.sparkSession
    seen = Observation(f"{name} gate")
    observed = df.observe(seen, *gate.aggregates()) if gate.measures else df

    def accept(rows: DataFrame) -> None:
        found: dict[str, object] = dict(seen.get) if gate.measures else {}
        broken = gate.broken(spark, found, now)
        if gate.unique:
            found["shared_keys"] = gate.shared(rows)
            if found["shared_keys"]:
                broken.append(DUPLICATES)
        if broken:
            raise GateClosed(name, broken, found)

    return replace_table(observed, path, accept)
