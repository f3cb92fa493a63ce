"""Gapless numbers in a given order, without sorting anything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.scratch import staged

# monotonically_increasing_id keeps the partition number above these bits.
PLACE_BITS = 33


def numbered(df: DataFrame, group: Column, *order: str) -> DataFrame:
    """``df``, staged, with ``group`` and a ``number`` from 0 within each group.

    The rows are range-partitioned on (group, order) and numbered inside their
    partition; the partition totals then shift each partition to its place. With
    an order that no two rows share, partitions are even however rows fall into
    groups. The shifts are at most groups x partitions rows.
    """
    ranges = ("group", *order)
    placed = staged(
        df.withColumn("group", group)
        .repartitionByRange(*ranges)
        .sortWithinPartitions(*ranges)
        .withColumn("place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("part", F.shiftright("place", PLACE_BITS))
    totals = placed.groupBy("group", "part").agg(
        F.count("*").alias("n"), F.min("place").alias("first_place")
    )
    earlier_parts = (
        Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("n").over(earlier_parts), F.lit(0))
    shifts = totals.select("group", "part", (before - F.col("first_place")).alias("shift"))
    return placed.join(shifts, ["group", "part"]).select(
        *df.columns, "group", (F.col("place") + F.col("shift")).alias("number")
    )
