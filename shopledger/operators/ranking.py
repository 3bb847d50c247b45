"""Ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.operators.skew import hot_keys, lookup_join
from shopledger.session import materialize


def dense_rank_desc(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds ``out``: the dense rank by ``value``, greatest first.

    The distinct values are sorted in ranges, ranked inside each range and shifted by the number of
    values in the ranges before it; the ranks are then joined back to the rows.
    """
    rows = materialize(df)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = rows.select(value).distinct().repartitionByRange(ranges, F.col(value).desc())
    cut = materialize(values.withColumn("_slice", F.spark_partition_id()))

    inside = Window.partitionBy("_slice").orderBy(F.col(value).desc())
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so this window and the broadcast stay as small as the partition count.
    sizes = cut.groupBy("_slice").agg(F.count("*").alias("_size"))
    shifts = sizes.select("_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    ranks = cut.withColumn("_place", F.row_number().over(inside)).join(F.broadcast(shifts), "_slice")
    ranks = ranks.select(value, (F.col("_place") + F.col("_shift")).cast("int").alias(out))
    return lookup_join(rows, ranks, value, hot_keys(rows, value), null_safe=True)
