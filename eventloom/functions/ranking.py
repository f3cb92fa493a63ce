"""Top-k with ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def limited(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows; all of them where ``n`` is None."""
    return df if n is None else df.limit(n)


def top_ranked(df: DataFrame, k: int, *order: Column, rank: str = "rank_position") -> DataFrame:
    """The first ``k`` rows in ``order``, numbered from 1.

    The limit comes before the numbering. Ranks follow the sort order, so this
    equals ranking everything first, but only ``k`` rows meet in one task.
    """
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
