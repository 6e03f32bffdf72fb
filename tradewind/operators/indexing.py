"""Consecutive row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

_ROW_BITS = (1 << 33) - 1


def with_row_index(df: DataFrame, *order: Column | str, name: str = "row_index") -> DataFrame:
    """Number the rows 1..n in a total order.

    A range-partitioned sort places the rows; the sorted table is checkpointed so that partitions
    keep their content whatever is recomputed later. A row's number is then its place in its
    partition plus the sizes of the partitions before it, one row per partition to broadcast.
    """
    shared_folder(df.sparkSession)
    placed = (
        df.orderBy(*order).checkpoint()
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(_ROW_BITS))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_place") + 1).alias(name))
