"""Dense row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.workspace import enable_checkpoints


def with_ordinal(df: DataFrame, *order_by: str | Column, name: str = "ordinal") -> DataFrame:
    """Numbers the rows 0, 1, 2, ... in the given order.

    The table is sorted by range partitions and checkpointed, which freezes the
    split into partitions even if executors are lost later. A row's number is
    then its position in its partition plus the sizes of the partitions before.
    The hash as last sort key lets rows with one order key, but otherwise
    different, spread over several partitions.
    """
    enable_checkpoints(df.sparkSession)
    frozen = df.orderBy(*order_by, F.xxhash64(*df.columns)).checkpoint()
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = frozen.select("*", F.spark_partition_id().alias("_part"), in_partition.alias("_pos"))
    # One row per partition, so this window and the broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_pos")).alias(name)
    )
