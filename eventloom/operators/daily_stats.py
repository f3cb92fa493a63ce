"""Daily statistics per event type."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.ranking import limited
from eventloom.functions.time_windows import CALENDAR, day, last_days, moment


def count_by_day(events: DataFrame) -> DataFrame:
    """Per date and event type: events, and distinct actors, repos and orgs.

    There are few groups and they are large. Spark expands the distincts and
    shuffles on (date, type, id), so no group has to fit in one task.
    """
    return events.groupBy(F.col("created_at_date").alias("stats_date"), "event_type").agg(
        F.count("*").alias("total_count"),
        F.count_distinct("actor_id").alias("unique_actors"),
        F.count_distinct("repo_id").alias("unique_repos"),
        F.count_distinct("org_id").alias("unique_orgs"),
    )


def daily_stats(events: DataFrame, on: date) -> DataFrame:
    """Statistics of one date."""
    return count_by_day(events.where(F.col("created_at_date") == day(on)))


def daily_stats_recent(events: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Statistics of the last ``days`` dates and today, newest and largest first."""
    recent = count_by_day(events.where(last_days(days, as_of, CALENDAR)))
    return recent.orderBy(F.desc("stats_date"), F.desc("total_count"), F.asc("event_type"))


def recent_daily_summary(stats: DataFrame, as_of=None, n: int | None = 3) -> DataFrame:
    """Sums over the newest ``n`` dates (None: all) from three days ago on.

    Distinct counts of several types are added up, so an actor active in two
    types counts twice.
    """
    first = moment(as_of).date() - timedelta(days=3)
    sums = (
        stats.where(F.col("stats_date") >= day(first))
        .groupBy("stats_date")
        .agg(
            F.sum("total_count").alias("total_events"),
            F.count_distinct("event_type").alias("event_types"),
            F.sum("unique_actors").alias("total_actors"),
            F.sum("unique_repos").alias("total_repos"),
        )
    )
    return limited(sums.orderBy(F.desc("stats_date")), n)
