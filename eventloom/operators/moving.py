"""Moving sums and ranks of repositories, and the leading developers of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

FRAMES = (7, 28)


def repo_days(events: DataFrame) -> DataFrame:
    """repo_id, stats_date, events, actors: days on which nothing happened are missing."""
    known = events.where("repo_id is not null and created_at_date is not null")
    return known.groupBy("repo_id", F.col("created_at_date").alias("stats_date")).agg(
        F.count("*").alias("events"), F.count_distinct("actor_id").alias("actors")
    )


def moving_sums(days: DataFrame, frames: tuple[int, ...] = FRAMES) -> DataFrame:
    """``days`` with events_N, the events of the N dates up to this one, and rank_N of it on its date.

    Frames are ranges of dates, so missing days count as days without events. A
    repository has one row for each day at most, however hot it is; a date's ranks are
    taken over the repositories active on it, ties by id.
    """
    by_day = Window.partitionBy("repo_id").orderBy(F.unix_date("stats_date"))
    summed = days.select("*", *(F.sum("events").over(by_day.rangeBetween(1 - n, 0)).alias(f"events_{n}") for n in frames))

    def rank(n: int):
        return F.row_number().over(Window.partitionBy("stats_date").orderBy(F.desc(f"events_{n}"), "repo_id"))

    return summed.select("*", *(rank(n).alias(f"rank_{n}") for n in frames))


def leading_developers(events: DataFrame, n: int = 3) -> DataFrame:
    """repo_id, place, actor_id, events: the ``n`` developers with most events of each repository, ties by id.

    Events are counted per pair first. Each task then keeps ``n`` rows of a repository
    before the shuffle, so a repository with very many developers is no large group.
    """
    known = events.where("repo_id is not null and actor_id is not null")
    counted = known.groupBy("repo_id", "actor_id").agg(F.count("*").alias("events"))
    in_order = Window.partitionBy("repo_id").orderBy(F.desc("events"), "actor_id")
    return counted.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= n)
