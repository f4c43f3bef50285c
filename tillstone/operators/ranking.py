"""Positions in a sorted list, without putting a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.operators.lookups import lookup_join
from tillstone.session import cut_lineage

# monotonically_increasing_id keeps the partition number above this bit.
_SLOT_BITS = 33


def positional_index(
    frame: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    tie: Sequence[str] = (),
    name: str = "idx",
) -> DataFrame:
    """Number the rows of every group from 0 in the given order.

    The rows are range-partitioned over (group, order, tie), so a large group spreads over many
    partitions; `tie` names a unique column that also splits runs of equal sort keys. The sorted
    layout is written to the shared folder once. Then only one count per (group, partition) is
    needed to turn places within a partition into places within the group.
    """
    sort_keys = [F.col(c) if isinstance(c, str) else c for c in [*group, *order, *tie]]
    laid_out = cut_lineage(
        frame.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftrightunsigned("_slot", _SLOT_BITS))
    )
    runs = laid_out.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_slot").alias("_first"))
    # One row per partition a group touches.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(*group, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        lookup_join(laid_out, starts, [*group, "_part"], "inner", measure=True)
        .withColumn(name, (F.col("_before") + F.col("_slot") - F.col("_first")).cast("bigint"))
        .drop("_slot", "_part", "_first", "_before")
    )
