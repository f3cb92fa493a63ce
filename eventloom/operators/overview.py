"""Totals and event type shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def overview(events: DataFrame, actors: DataFrame, repos: DataFrame, orgs: DataFrame) -> DataFrame:
    """One row: the four table counts and the latest event time."""
    no_time = F.lit(None).cast("timestamp_ntz").alias("latest")

    def counted(name: str, df: DataFrame, latest=no_time) -> DataFrame:
        return df.agg(F.count("*").alias("n"), latest).select(F.lit(name).alias("name"), "n", "latest")

    counts = (
        counted("total_events", events, F.max("created_at").alias("latest"))
        .union(counted("total_actors", actors))
        .union(counted("total_repos", repos))
        .union(counted("total_orgs", orgs))
    )
    names = ("total_events", "total_actors", "total_repos", "total_orgs")
    return counts.agg(
        *(F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names),
        F.max("latest").alias("latest_event"),
    )


def event_types(events: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent event types."""
    counts = events.groupBy("event_type").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("event_type")).limit(n)


def event_type_share(events: DataFrame, n: int = 20) -> DataFrame:
    """Those types with their percentage of the returned rows' total.

    Rounded half up to two places in whole numbers, so no share depends on how
    a fraction is represented.
    """
    total = F.sum("count").over(Window.partitionBy())
    hundredths = F.floor((F.col("count") * 20000 + F.col("total")) / (2 * F.col("total")))
    return (
        event_types(events, n)
        .withColumn("total", total)
        .select(
            "event_type",
            "count",
            F.when(F.col("total") == 0, 0.0).otherwise(hundredths / 100).alias("percentage"),
        )
    )
