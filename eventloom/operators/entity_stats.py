"""Per-actor and per-repository statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.counting import count_kind, kind
from eventloom.functions.time_windows import CALENDAR, ROLLING, ntz, window_start
from eventloom.operators.upsert import REPLACE, upsert
from eventloom.schemas import FORK, ISSUES, PULL_REQUEST, PUSH, WATCH

ALL_KEYS = ("actor_id", "repo_id", "relation_type")


def relation_type():
    """star, fork or contributor."""
    return (
        F.when(kind(WATCH), "star").when(kind(FORK), "fork").otherwise("contributor")
    ).alias("relation_type")


def activity(events: DataFrame, *keys, as_of=None, mode: str = ROLLING) -> DataFrame:
    """All event counters, and first and last times, grouped by ``keys``."""

    def within(days: int):
        return F.col("created_at") >= ntz(window_start(as_of, days, mode))

    return events.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.count_if(within(7)).alias("events_7d"),
        count_kind(WATCH).alias("stars"),
        count_kind(WATCH, within(1)).alias("stars_1d"),
        count_kind(WATCH, within(7)).alias("stars_7d"),
        count_kind(WATCH, within(30)).alias("stars_30d"),
        count_kind(FORK).alias("forks"),
        count_kind(PUSH).alias("commits"),
        count_kind(PUSH, within(7)).alias("commits_7d"),
        count_kind(PULL_REQUEST).alias("prs"),
        count_kind(PULL_REQUEST, within(7)).alias("prs_7d"),
        count_kind(ISSUES).alias("issues"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def pair_activity(events: DataFrame, as_of=None, mode: str = ROLLING) -> DataFrame:
    """The counters of every (actor, repository) pair.

    One scan and one shuffle of the facts, combined on the map side. A hot
    actor or repository spreads over its pairs, and distinct partners become
    plain row counts.
    """
    return activity(events, "actor_id", "repo_id", as_of=as_of, mode=mode)


def coarser(counted: DataFrame, *keys: str) -> DataFrame:
    """``activity`` of fewer keys, from that of more."""
    times = {"first_at": F.min, "last_at": F.max}
    counters = (c for c in counted.columns if c not in ALL_KEYS)
    return counted.groupBy(*keys).agg(*(times.get(c, F.sum)(c).alias(c) for c in counters))


def total(name: str):
    return F.coalesce(F.sum(name), F.lit(0))


def actor_stats_of(pairs: DataFrame, actors: DataFrame) -> DataFrame:
    """Actor statistics from pair counters."""
    stats = pairs.groupBy("actor_id").agg(
        total("commits").alias("total_commits"),
        total("prs").alias("total_prs"),
        total("issues").alias("total_issues"),
        F.count("*").alias("total_repos"),
        total("stars").alias("total_stars_received"),
        total("commits_7d").alias("commits_7d"),
        total("prs_7d").alias("prs_7d"),
        F.count_if(F.col("events_7d") > 0).alias("repos_7d"),
    )
    active = stats.where("total_commits > 0 or total_prs > 0 or total_issues > 0")
    return active.join(actors.select("actor_id"), "actor_id", "left_semi")


def actor_stats(events: DataFrame, actors: DataFrame, as_of=None) -> DataFrame:
    """Lifetime and 7-day counts of actors with a push, pull request or issue.

    ``total_stars_received`` keeps its established name and value: the stars
    the actor gave.
    """
    return actor_stats_of(pair_activity(events, as_of), actors)


def repo_totals():
    return (
        F.count_if(F.col("stars") > 0).alias("total_watchers"),
        F.count("*").alias("contributors"),
        total("commits").alias("total_commits"),
        total("prs").alias("total_prs"),
        total("issues").alias("total_issues"),
        total("stars_1d").alias("stars_1d"),
        total("stars_7d").alias("stars_7d"),
        total("stars_30d").alias("stars_30d"),
    )


REPO_STATS = (
    "repo_id",
    "total_stars",
    "total_forks",
    "total_watchers",
    "total_contributors",
    "total_commits",
    "total_prs",
    "total_issues",
    "stars_1d",
    "stars_7d",
    "stars_30d",
)


def repo_stats_of(pairs: DataFrame, repos: DataFrame) -> DataFrame:
    """Repository statistics from pair counters."""
    counts = pairs.groupBy("repo_id").agg(*repo_totals())
    active = counts.where("total_commits > 0 or total_prs > 0 or total_issues > 0 or stars_7d > 0")
    stored = repos.select("repo_id", "total_stars", "total_forks", "total_contributors")
    return active.join(stored, "repo_id").select(
        "repo_id",
        F.coalesce("total_stars", F.lit(0)).alias("total_stars"),
        F.coalesce("total_forks", F.lit(0)).alias("total_forks"),
        "total_watchers",
        F.greatest(F.coalesce("total_contributors", F.lit(0)), "contributors").alias(
            "total_contributors"
        ),
        *REPO_STATS[5:],
    )


def repo_stats(events: DataFrame, repos: DataFrame, as_of=None) -> DataFrame:
    """Statistics of repositories with a push, pull request, issue or recent star.

    Stars and forks are the stored totals; contributors are at least the stored
    number.
    """
    return repo_stats_of(pair_activity(events, as_of), repos)


def repo_stats_one(events: DataFrame, repo_id: int, as_of=None) -> DataFrame:
    """The same statistics for one repository, all counted from events.

    Windows are calendar days. There is always one row, of zeros when the
    repository has no events. Grouping by actor first keeps even a very large
    repository spread over many tasks.
    """
    pairs = pair_activity(events.where(F.col("repo_id") == repo_id), as_of, CALENDAR)
    return pairs.agg(
        F.lit(repo_id).cast("bigint").alias("repo_id"),
        total("stars").alias("total_stars"),
        total("forks").alias("total_forks"),
        *repo_totals(),
    ).withColumnRenamed("contributors", "total_contributors").select(*REPO_STATS)


def refresh_repo_stats(
    stats: DataFrame, events: DataFrame, repo_id: int, as_of=None
) -> DataFrame:
    """Stored statistics with one repository's row counted anew."""
    policy = dict.fromkeys(REPO_STATS[1:], REPLACE)
    return upsert(stats, repo_stats_one(events, repo_id, as_of), ["repo_id"], policy)


def repo_stats_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count("*").alias("total_repos"),
        F.sum("total_stars").alias("sum_stars"),
        F.sum("total_watchers").alias("sum_watchers"),
        F.sum("stars_7d").alias("sum_stars_7d"),
        F.max("total_stars").alias("max_stars"),
    )


def top_n(stats: DataFrame, column: str, n: int = 3, key: str = "repo_id") -> DataFrame:
    """The ``n`` rows with the largest ``column``; ties by ``key``."""
    return stats.orderBy(F.desc(column), F.asc(key)).limit(n)
