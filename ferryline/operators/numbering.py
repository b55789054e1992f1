"""Positions in a total order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.functions.cells import quoted
from ferryline.runtime import materialize
from ferryline.sources.feed_writer import row_in_partition


def number_rows(df: DataFrame, keys: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the order of its unique ``keys``.

    The rows are range-partitioned and sorted, so every task numbers its own range.
    What is missing is the number of rows in the ranges before it: a running sum
    over one row per range. That small table is joined back. The ranges are written
    out first, because a lost range would otherwise be drawn with new borders.
    """
    columns = [quoted(k) for k in keys]
    ranges = materialize(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("__range", F.spark_partition_id())
        .withColumn("__row", row_in_partition()),
        "ranges",
    )
    # One row per range: bounded by the number of shuffle partitions.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("__range")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    return ranges.join(F.broadcast(offsets), "__range").select(
        *[quoted(c) for c in df.columns], (F.col("__offset") + F.col("__row")).alias(name)
    )
