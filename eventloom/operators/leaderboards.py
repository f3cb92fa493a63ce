"""Repository and developer leaderboards.

Scores are doubles: every weight is a multiple of one half, so they are exact.
Ties are broken by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.counting import count_kind, zero_if_null
from eventloom.functions.ranking import top_ranked
from eventloom.functions.scratch import staged
from eventloom.functions.time_windows import CALENDAR, ROLLING, last_days
from eventloom.schemas import FORK, ISSUES, PULL_REQUEST, PUSH, WATCH

WEIGHTED = "weighted"
CUMULATIVE = "cumulative"
DAYS = 7

# Window rule and rows kept, per formula.
WINDOW = {WEIGHTED: CALENDAR, CUMULATIVE: ROLLING}
KEPT = {WEIGHTED: 1000, CUMULATIVE: 100}

REPO_COUNTS = ("stars_7d", "forks_7d", "prs_7d")
ACTOR_COUNTS = ("commits_7d", "prs_7d", "issues_7d")


def repo_counts():
    return (
        count_kind(WATCH).alias("stars_7d"),
        count_kind(FORK).alias("forks_7d"),
        count_kind(PULL_REQUEST).alias("prs_7d"),
    )


def actor_counts():
    return (
        count_kind(PUSH).alias("commits_7d"),
        count_kind(PULL_REQUEST).alias("prs_7d"),
        count_kind(ISSUES).alias("issues_7d"),
    )


def recent(events: DataFrame, as_of, mode: str) -> DataFrame:
    return events.where(last_days(DAYS, as_of, mode))


def hot_repos(
    events: DataFrame,
    repos: DataFrame,
    as_of=None,
    formula: str = CUMULATIVE,
    window_mode: str | None = None,
    k: int | None = None,
) -> DataFrame:
    """Repositories by score over the last 7 days.

    ``weighted``: 3 per star, 2 per fork, 1.5 per pull request and 2 per
    distinct contributor, in calendar days. A repository without events in the
    window scores 0 and is out, so an inner join is enough.

    ``cumulative``: stored stars plus 2 per star and 1.5 per fork, in rolling
    days. Pull requests are reported but not scored; contributors are not
    counted.
    """
    by_repo = recent(events, as_of, window_mode or WINDOW[formula]).groupBy("repo_id")
    names = repos.select("repo_id", F.col("name").alias("repo_name"), "total_stars")
    if formula == WEIGHTED:
        counts = by_repo.agg(*repo_counts(), F.count_distinct("actor_id").alias("contributors_7d"))
        score = "stars_7d * 3 + forks_7d * 2 + prs_7d * 1.5D + contributors_7d * 2"
        board = names.join(counts, "repo_id")
        columns = [*REPO_COUNTS, "contributors_7d"]
    else:
        counts = by_repo.agg(*repo_counts())
        score = "coalesce(total_stars, 0) + stars_7d * 2 + forks_7d * 1.5D"
        board = names.join(counts, "repo_id", "left").withColumns(
            {name: zero_if_null(name) for name in REPO_COUNTS}
        )
        columns = list(REPO_COUNTS)
    scored = board.select("repo_id", "repo_name", F.expr(score).alias("score"), *columns)
    return top_ranked(
        scored.where("score > 0"), k or KEPT[formula], F.desc("score"), F.asc("repo_id")
    )


def active_developers(
    events: DataFrame,
    actors: DataFrame,
    as_of=None,
    formula: str = CUMULATIVE,
    window_mode: str | None = None,
    k: int | None = None,
) -> DataFrame:
    """Developers by activity score over the last 7 days.

    ``weighted``: 2 per push, 3 per pull request, 1 per issue event and 1.5 per
    distinct repository, in calendar days.

    ``cumulative``: stored event total plus all events, in rolling days.
    """
    by_actor = recent(events, as_of, window_mode or WINDOW[formula]).groupBy("actor_id")
    logins = actors.select("actor_id", F.col("login").alias("actor_login"), "total_events")
    counts = by_actor.agg(
        *actor_counts(),
        F.count_distinct("repo_id").alias("repos_7d"),
        F.count("*").alias("events_7d"),
    )
    columns = [*ACTOR_COUNTS, "repos_7d"]
    if formula == WEIGHTED:
        score = "commits_7d * 2 + prs_7d * 3 + issues_7d + repos_7d * 1.5D"
        board = logins.join(counts, "actor_id")
    else:
        score = "cast(coalesce(total_events, 0) + events_7d as double)"
        board = logins.join(counts, "actor_id", "left").withColumns(
            {name: zero_if_null(name) for name in (*columns, "events_7d")}
        )
    scored = board.select("actor_id", "actor_login", F.expr(score).alias("activity_score"), *columns)
    return top_ranked(
        scored.where("activity_score > 0"),
        k or KEPT[formula],
        F.desc("activity_score"),
        F.asc("actor_id"),
    )


def leaderboard_top(board: DataFrame, n: int = 3) -> DataFrame:
    return board.orderBy("rank_position").limit(n)


def _realtime(events, dimension, key, total, counts, names, n, as_of) -> DataFrame:
    """Top rows of a dimension by a stored total, with recent counts beside it.

    The total does not depend on events, so the ``n`` rows are chosen first,
    staged, and only their events are counted.
    """
    top = staged(top_ranked(dimension, n, F.desc_nulls_last(total), F.asc(key)), "top")
    window = recent(events, as_of, ROLLING).join(top.select(key), key, "left_semi")
    counted = window.groupBy(key).agg(*counts)
    return top.join(counted, key, "left").withColumns({name: zero_if_null(name) for name in names})


def trending_repos_realtime(events: DataFrame, repos: DataFrame, n: int = 10, as_of=None) -> DataFrame:
    """The ``n`` most starred repositories; zero scores stay in."""
    rows = _realtime(events, repos, "repo_id", "total_stars", repo_counts(), REPO_COUNTS, n, as_of)
    return rows.select(
        "repo_id",
        F.col("name").alias("repo_name"),
        F.coalesce("total_stars", F.lit(0)).cast("double").alias("score"),
        *REPO_COUNTS,
        "rank_position",
    )


def trending_developers_realtime(
    events: DataFrame, actors: DataFrame, n: int = 10, as_of=None
) -> DataFrame:
    """The ``n`` developers with the most stored events; zero scores stay in."""
    rows = _realtime(events, actors, "actor_id", "total_events", actor_counts(), ACTOR_COUNTS, n, as_of)
    return rows.select(
        "actor_id",
        F.col("login").alias("actor_login"),
        F.coalesce("total_events", F.lit(0)).cast("double").alias("activity_score"),
        *ACTOR_COUNTS,
        "rank_position",
    )


def trending_repos(
    cached: DataFrame | None, events: DataFrame, repos: DataFrame, n: int = 10, as_of=None
) -> DataFrame:
    """The stored leaderboard when it has rows, else the realtime ranking."""
    if cached is not None and not cached.isEmpty():
        rows = leaderboard_top(cached, n).select(
            "repo_id", "repo_name", "score", *REPO_COUNTS, "rank_position"
        )
        return rows.withColumn("source", F.lit("cached"))
    return trending_repos_realtime(events, repos, n, as_of).withColumn("source", F.lit("realtime"))


def trending_developers(
    cached: DataFrame | None, events: DataFrame, actors: DataFrame, n: int = 10, as_of=None
) -> DataFrame:
    """The stored leaderboard when it has rows, else the realtime ranking."""
    if cached is not None and not cached.isEmpty():
        rows = leaderboard_top(cached, n).select(
            "actor_id", "actor_login", "activity_score", *ACTOR_COUNTS, "rank_position"
        )
        return rows.withColumn("source", F.lit("cached"))
    return trending_developers_realtime(events, actors, n, as_of).withColumn(
        "source", F.lit("realtime")
    )
