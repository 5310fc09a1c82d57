"""Positions in a total order, and dense surrogate keys, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.sources.storage import stage

# monotonically_increasing_id() holds the partition above this bit and the row below it.
_ROW_BITS = 33


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position``, 0..n-1 in the given order; the order columns must identify a row.

    Rows are range-partitioned and sorted, numbered within their partition, and written once;
    the partitions' sizes, a row per partition, then give each one's starting position.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    staged = stage(ranged, "positions").select(
        "*",
        F.shiftright("_slot", _ROW_BITS).alias("_part"),
        F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    return (
        staged.join(_starts(staged, F.count("*")), "_part")
        .withColumn("position", F.col("_start") + F.col("_row"))
        .drop("_slot", "_part", "_row", "_start")
    )


def running_totals(df: DataFrame, order: Sequence[str], weight: str) -> DataFrame:
    """Add ``before``, the sum of the weights of all earlier rows in the given order."""
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    staged = stage(ranged, "totals").select("*", F.shiftright("_slot", _ROW_BITS).alias("_part"))
    # A window partition is one range partition of the shuffle above: a bounded share of rows.
    earlier = (
        Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        staged.withColumn("_within", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
        .join(_starts(staged, F.sum(weight)), "_part")
        .withColumn("before", F.col("_start") + F.col("_within"))
        .drop("_slot", "_part", "_within", "_start")
    )


def _starts(staged: DataFrame, size: Column) -> DataFrame:
    """Where each partition starts. Small by construction: a row per shuffle partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged.groupBy("_part").agg(size.alias("_size"))
    return F.broadcast(
        sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )


def assign_keys(new: DataFrame, natural_key: str, key: str, last: int = 0) -> DataFrame:
    """Add an integer key, last+1, last+2, ... in natural-key order, to rows not keyed yet."""
    return positions(new, [natural_key]).select(
        "*", (F.col("position") + last + 1).cast("int").alias(key)
    ).drop("position")
