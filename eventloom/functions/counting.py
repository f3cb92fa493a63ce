"""Counts by event kind and of whole frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def kind(event_type: str) -> Column:
    return F.col("event_type") == event_type


def count_kind(event_type: str, when: Column | None = None) -> Column:
    return F.count_if(kind(event_type) if when is None else kind(event_type) & when)


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``name`` and ``row_count`` of each frame."""
    counts = (
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, df in frames.items()
    )
    return reduce(DataFrame.union, counts)


def one_row(counts: DataFrame, names) -> DataFrame:
    """``row_counts`` turned into one row with a column per name."""
    return counts.agg(*(F.sum(F.when(F.col("name") == n, F.col("row_count"))).alias(n) for n in names))
