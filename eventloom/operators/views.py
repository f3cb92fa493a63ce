"""The standing report views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.joins import keep_known
from eventloom.functions.ranking import limited
from eventloom.functions.time_windows import CALENDAR, last_days, day, window_start

RECENT_ROWS = 10_000
BOARD_ROWS = 100


def recent_events_summary(
    events: DataFrame, actors: DataFrame, repos: DataFrame, as_of=None, n: int | None = RECENT_ROWS
) -> DataFrame:
    """The newest events of the last 7 days with actor and repository details.

    Events of unknown actors or repositories must not take up places, so they
    are removed first. The newest rows are then chosen before the joins, which
    leaves the details to be joined to ``n`` rows at most (None: no limit).
    """
    window = events.where(last_days(7, as_of)).select(
        "gh_event_id", "event_type", "created_at", "actor_id", "repo_id", "actor_login", "repo_name"
    )
    known = keep_known(window, {"actor_id": actors, "repo_id": repos})
    newest = limited(known.orderBy(F.desc("created_at"), F.asc("gh_event_id")), n)
    details = newest.join(actors.select("actor_id", "display_login"), "actor_id").join(
        repos.select("repo_id", "total_stars", "total_forks"), "repo_id"
    )
    return details.select(
        F.col("gh_event_id").alias("event_id"),
        "gh_event_id",
        "event_type",
        "created_at",
        "actor_login",
        "repo_name",
        "display_login",
        "total_stars",
        "total_forks",
    ).orderBy(F.desc("created_at"), F.asc("gh_event_id"))


def trending_repos_view(board: DataFrame, repos: DataFrame, n: int | None = BOARD_ROWS) -> DataFrame:
    """The first ``n`` of the repository leaderboard (None: all) with stored totals."""
    contributors_7d = (
        F.col("contributors_7d") if "contributors_7d" in board.columns else F.lit(0).cast("bigint")
    )
    totals = repos.select("repo_id", "total_stars", "total_forks", "total_contributors")
    detailed = board.join(totals, "repo_id").select(
        "repo_id",
        "repo_name",
        "total_stars",
        "total_forks",
        "total_contributors",
        "score",
        "stars_7d",
        "forks_7d",
        "prs_7d",
        contributors_7d.alias("contributors_7d"),
        "rank_position",
    )
    return limited(detailed.orderBy("rank_position"), n)


def active_developers_view(board: DataFrame, actors: DataFrame, n: int | None = BOARD_ROWS) -> DataFrame:
    """The first ``n`` of the developer leaderboard (None: all) with stored totals."""
    totals = actors.select("actor_id", "total_events", "total_repos", "last_active_at")
    detailed = board.join(totals, "actor_id").select(
        "actor_id",
        "actor_login",
        "activity_score",
        "commits_7d",
        "prs_7d",
        "issues_7d",
        "repos_7d",
        "rank_position",
        "total_events",
        "total_repos",
        "last_active_at",
    )
    return limited(detailed.orderBy("rank_position"), n)


def repo_detail_stats(repos: DataFrame, stats: DataFrame) -> DataFrame:
    """Every repository with its statistics, NULL where there are none."""
    cached = stats.select(
        "repo_id",
        "total_watchers",
        F.col("total_contributors").alias("counted_contributors"),
        "total_commits",
        "total_prs",
        "total_issues",
        "stars_7d",
        "stars_30d",
    )
    return repos.join(cached, "repo_id", "left").select(
        "repo_id",
        "name",
        "url",
        "language",
        "total_stars",
        "total_forks",
        "total_events",
        "total_watchers",
        F.col("counted_contributors").alias("total_contributors"),
        "total_commits",
        "total_prs",
        "total_issues",
        "stars_7d",
        "stars_30d",
        "last_event_at",
    )


def actor_detail_stats(actors: DataFrame, stats: DataFrame) -> DataFrame:
    """Every actor with its statistics, NULL where there are none."""
    cached = stats.select(
        "actor_id",
        "total_commits",
        "total_prs",
        "total_issues",
        "total_stars_received",
        "commits_7d",
        "prs_7d",
    )
    return actors.join(cached, "actor_id", "left").select(
        "actor_id",
        "login",
        "display_login",
        "avatar_url",
        "total_events",
        "total_repos",
        "last_active_at",
        "total_commits",
        "total_prs",
        "total_issues",
        "total_stars_received",
        "commits_7d",
        "prs_7d",
    )


def ratio(count: str, by: str) -> Column:
    """``count / by`` rounded half up to two places; NULL when ``by`` is 0."""
    whole = F.col(count).cast("decimal(20,0)")
    return F.round(whole / F.nullif(F.col(by).cast("decimal(20,0)"), F.lit(0)), 2)


def daily_event_trends(stats: DataFrame, as_of=None) -> DataFrame:
    """Daily statistics of the last 30 days with events per actor and per repository."""
    recent = stats.where(F.col("stats_date") >= day(window_start(as_of, 30, CALENDAR)))
    return recent.select(
        "stats_date",
        "event_type",
        "total_count",
        "unique_actors",
        "unique_repos",
        ratio("total_count", "unique_actors").alias("avg_events_per_actor"),
        ratio("total_count", "unique_repos").alias("avg_events_per_repo"),
    ).orderBy(F.desc("stats_date"), F.desc("total_count"), F.asc("event_type"))
