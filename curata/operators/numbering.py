"""Consecutive numbers over a whole table or within groups, without one task ordering a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.session import frozen

PARTITION_BITS = 33


def number_rows(df: DataFrame, order: str, group: str | None = None, name: str = "number") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 .. in the order of a column, within each group if given.

    Rows are dealt into ranges and sorted there, so a hot group lies in many ranges; counts
    per range and group (few rows whatever the table's size) give each its offset.
    """
    by = [group] if group else []
    ranged = frozen(df.repartitionByRange(*by, order).sortWithinPartitions(*by, order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", PARTITION_BITS).alias("_part")
    ranges = ranged.groupBy(*by, part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).select(*(F.col(c).alias(f"_of_{c}") for c in by), F.col("_part").alias("_of_part"), "_offset")
    match = F.col("_of_part") == F.shiftright("_at", PARTITION_BITS)
    for c in by:
        match &= F.col(f"_of_{c}").eqNullSafe(F.col(c))
    return ranged.join(offsets, match).withColumn(name, F.col("_at") + F.col("_offset")).select(*df.columns, name)


def batches(df: DataFrame, size: int, order: str, group: str | None = None, name: str = "batch") -> DataFrame:
    """``df`` with ``name``: the number of the batch of ``size`` consecutive rows; groups follow each other and share no batch."""
    made = number_rows(df, order, group, "_number").withColumn("_batch", F.floor(F.col("_number") / size).cast("long"))
    if group is None:
        return made.withColumn(name, F.col("_batch")).drop("_number", "_batch")
    each = made.groupBy(F.col(group).alias("_group")).agg((F.max("_batch") + 1).alias("_n"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # a row a group
    start = each.select("_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return made.join(start, F.col(group).eqNullSafe(F.col("_group"))).withColumn(name, F.col("_start") + F.col("_batch")).drop("_number", "_batch", "_group", "_start")
