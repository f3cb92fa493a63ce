from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from eventloom.functions.time_windows import moment, window_start
from eventloom.operators import base_stats, daily_stats, entity_stats, leaderboards, overview, views
from tests.conftest import rows

AS_OF = "2024-01-31 12:00:00"


@pytest.fixture(scope="module")
def small(make_events):
    return make_events(
        [
            (1, "Watch", "2024-01-24 11:59:59", 1, 1, None),  # calendar only
            (2, "Watch", "2024-01-24 12:00:00", 1, 1, None),  # first instant of both
            (3, "Fork", "2024-02-05 00:00:00", 2, 1, 4),  # after the reference time
            (4, "PullRequest", "2024-01-30 00:00:00", 2, 2, 4),
            (5, "Push", "2024-01-30 00:00:00", 2, 2, None),
            (6, "Issues", "2024-01-01 00:00:00", 3, 2, 5),
            (7, "Push", "2024-01-30 00:00:00", 9, 9, None),  # unknown to both dimensions
        ]
    )


@pytest.fixture(scope="module")
def repos(make_repos):
    return make_repos(
        {"repo_id": 1}, {"repo_id": 2, "total_stars": 3, "total_contributors": 7}, {"repo_id": 3}, {"repo_id": 4, "total_stars": None}
    )


@pytest.fixture(scope="module")
def actors(make_actors):
    return make_actors({"actor_id": 1}, {"actor_id": 2, "total_events": 5}, {"actor_id": 3}, {"actor_id": 4})


def test_window_rules():
    assert window_start(AS_OF, 7) == datetime(2024, 1, 24, 12)
    assert window_start(AS_OF, 7, "calendar") == datetime(2024, 1, 24)
    assert moment(date(2024, 1, 31)) == datetime(2024, 1, 31)
    assert moment("2024-01-31T12:00:00+02:00") == datetime(2024, 1, 31, 10)
    with pytest.raises(ValueError):
        window_start(AS_OF, 7, "weekly")


def test_hot_repos_both_formulas(small, repos):
    weighted = leaderboards.hot_repos(small, repos, AS_OF, "weighted")
    assert rows(weighted) == [
        (1, "org/repo-1", 12.0, 2, 1, 0, 2, 1),
        (2, "org/repo-2", 3.5, 0, 0, 1, 1, 2),
    ]
    cumulative = leaderboards.hot_repos(small, repos, AS_OF)
    assert rows(cumulative) == [(1, "org/repo-1", 3.5, 1, 1, 0, 1), (2, "org/repo-2", 3.0, 0, 0, 1, 2)]


def test_active_developers_both_formulas(small, actors):
    weighted = leaderboards.active_developers(small, actors, AS_OF, "weighted")
    assert rows(weighted) == [
        (2, "dev-2", 8.0, 1, 1, 0, 2, 1),
        (1, "dev-1", 1.5, 0, 0, 0, 1, 2),
    ]
    cumulative = leaderboards.active_developers(small, actors, AS_OF)
    assert rows(cumulative) == [(2, "dev-2", 8.0, 1, 1, 0, 2, 1), (1, "dev-1", 1.0, 0, 0, 0, 1, 2)]


def test_ties_follow_the_id(make_events, make_repos):
    none = make_events([(1, "Push", "2020-01-01", 1, 1, None)])
    repos = make_repos(*({"repo_id": i, "total_stars": 5} for i in (3, 1, 2)))
    board = leaderboards.hot_repos(none, repos, AS_OF, k=2)
    assert rows(board.select("repo_id", "rank_position")) == [(1, 1), (2, 2)]


def test_realtime_keeps_zero_scores_and_sorts_null_last(small, repos):
    found = leaderboards.trending_repos_realtime(small, repos, 10, AS_OF)
    assert rows(found.drop("repo_name"), "rank_position") == [
        (2, 3.0, 0, 0, 1, 1),
        (1, 0.0, 1, 1, 0, 2),
        (3, 0.0, 0, 0, 0, 3),
        (4, 0.0, 0, 0, 0, 4),
    ]


def test_trending_falls_back_when_nothing_is_stored(small, repos, actors):
    board = leaderboards.hot_repos(small, repos, AS_OF)
    sources = [
        leaderboards.trending_repos(cached, small, repos, 2, AS_OF).select("source").first()[0]
        for cached in (board, board.limit(0), None)
    ]
    assert sources == ["cached", "realtime", "realtime"]
    developers = leaderboards.active_developers(small, actors, AS_OF)
    found = leaderboards.trending_developers(developers, small, actors, 1, AS_OF)
    assert rows(found) == [(2, "dev-2", 8.0, 1, 1, 0, 1, "cached")]


def test_entity_statistics(small, repos, actors):
    assert rows(entity_stats.actor_stats(small, actors, AS_OF), "actor_id") == [
        (2, 1, 1, 0, 2, 0, 1, 1, 2),
        (3, 0, 0, 1, 1, 0, 0, 0, 0),
    ]
    assert rows(entity_stats.repo_stats(small, repos, AS_OF), "repo_id") == [
        (1, 0, 0, 1, 2, 0, 0, 0, 0, 1, 2),
        (2, 3, 0, 0, 7, 1, 1, 1, 0, 0, 0),
    ]
    assert rows(entity_stats.repo_stats_one(small, 1, AS_OF)) == [(1, 2, 1, 1, 2, 0, 0, 0, 0, 2, 2)]
    assert rows(entity_stats.repo_stats_one(small, 55, AS_OF)) == [(55,) + (0,) * 10]


def test_daily_statistics_ignore_null_orgs(small):
    found = daily_stats.daily_stats(small, date(2024, 1, 30))
    assert rows(found, "event_type") == [
        (date(2024, 1, 30), "PullRequestEvent", 1, 1, 1, 1),
        (date(2024, 1, 30), "PushEvent", 2, 2, 2, 0),
    ]
    recent = daily_stats.daily_stats_recent(small, 30, AS_OF).select("stats_date", "event_type")
    assert rows(recent) == [
        (date(2024, 2, 5), "ForkEvent"),
        (date(2024, 1, 30), "PushEvent"),
        (date(2024, 1, 30), "PullRequestEvent"),
        (date(2024, 1, 24), "WatchEvent"),
        (date(2024, 1, 1), "IssuesEvent"),
    ]


def test_merging_a_batch_twice_counts_it_twice(small, actors, repos):
    once = base_stats.merge_actor_stats(actors, small)
    twice = base_stats.merge_actor_stats(once, small)
    at = datetime(2024, 1, 24, 12)
    columns = ("actor_id", "total_events", "last_active_at")
    assert rows(once.select(*columns), "actor_id")[0] == (1, 2, at)
    assert rows(twice.select(*columns), "actor_id")[0] == (1, 4, at)
    assert rows(once.select(*columns), "actor_id")[3] == (4, 0, None)
    assert once.columns == actors.columns
    stars = base_stats.merge_repo_stats(repos, small).select("repo_id", "total_stars", "total_forks")
    assert rows(stars, "repo_id")[:2] == [(1, 2, 1), (2, 3, 0)]


def test_merges_add_up_over_batches(small, actors, repos):
    early, late = small.where("gh_event_id <= 3"), small.where("gh_event_id > 3")
    for merge, table in ((base_stats.merge_actor_stats, actors), (base_stats.merge_repo_stats, repos)):
        key = table.columns[0]
        assert rows(merge(merge(table, early), late), key) == rows(merge(table, small), key)


def test_relation_keeps_first_and_replaces_last(make_events, actors, repos):
    new = make_events([(1, "Watch", "2024-01-20", 1, 1, None), (2, "Push", "2024-01-20", 9, 1, None)])
    old = make_events([(3, "Watch", "2024-01-10", 1, 1, None), (4, "Push", "2024-01-11", 1, 1, None)])
    prior = base_stats.relations(new, actors, repos)
    merged = base_stats.relations(old, actors, repos, prior)
    assert rows(merged, "relation_type") == [
        (1, 1, "contributor", *[datetime(2024, 1, 11)] * 3, 1),
        (1, 1, "star", datetime(2024, 1, 20), datetime(2024, 1, 20), datetime(2024, 1, 10), 2),
    ]


def test_shares_are_rounded_half_up(make_events):
    events = make_events(
        [(n, "Push" if n else "Fork", "2024-01-05", 1, 1, None) for n in range(16)]
    )
    assert rows(overview.event_type_share(events)) == [("PushEvent", 15, 93.75), ("ForkEvent", 1, 6.25)]
    eighth = make_events([(n, "Push" if n % 3 else "Fork", "2024-01-05", 1, 1, None) for n in range(3)])
    assert rows(overview.event_type_share(eighth)) == [("PushEvent", 2, 66.67), ("ForkEvent", 1, 33.33)]
    assert rows(overview.event_type_share(events.limit(0))) == []


def test_overview_of_nothing(make_events, actors, repos, make_orgs):
    none = make_events([(1, "Push", "2024-01-05", 1, 1, None)]).where("false")
    assert rows(overview.overview(none, actors, repos, make_orgs({"org_id": 1}))) == [(0, 4, 4, 1, None)]


def test_trends_round_half_up_and_survive_zero(spark):
    stats = spark.createDataFrame(
        [(date(2024, 1, 30), "PushEvent", 107, 40, 0, 0), (date(2023, 12, 31), "PushEvent", 1, 1, 1, 1)],
        "stats_date date, event_type string, total_count bigint, unique_actors bigint, unique_repos bigint, unique_orgs bigint",
    )
    trend = rows(views.daily_event_trends(stats, AS_OF))
    assert [(float(r[5]), r[6]) for r in trend] == [(2.68, None)]


def test_recent_events_skip_unknown_entities_before_the_limit(small, actors, repos):
    found = views.recent_events_summary(small, actors, repos, AS_OF, n=2)
    assert [r.gh_event_id for r in found.collect()] == [3, 4]


def test_weighted_board_equals_four_joins(small, repos):
    """One conditional aggregate gives what four joined subqueries give."""
    window = small.where(F.col("created_at_date") >= F.lit("2024-01-24").cast("date"))
    joined = repos.select("repo_id")
    for kind, name in (("Watch", "stars_7d"), ("Fork", "forks_7d"), ("PullRequest", "prs_7d")):
        counts = window.where(f"event_type = '{kind}Event'").groupBy("repo_id").agg(F.count("*").alias(name))
        joined = joined.join(counts, "repo_id", "left")
    people = window.groupBy("repo_id").agg(F.count_distinct("actor_id").alias("contributors_7d"))
    joined = joined.join(people, "repo_id", "left").na.fill(0)
    score = "stars_7d * 3 + forks_7d * 2 + prs_7d * 1.5D + contributors_7d * 2"
    expected = joined.withColumn("score", F.expr(score)).where("score > 0")
    board = leaderboards.hot_repos(small, repos, AS_OF, "weighted").select(*expected.columns)
    assert rows(board, "repo_id") == rows(expected, "repo_id")


@pytest.fixture(scope="module")
def many(spark):
    """12,000 recent events: 1,500 actors and repositories, 25 types."""
    kinds = F.array(*(F.lit(f"{k}Event") for k in ["Watch", "Push", *(f"Kind{n:02d}" for n in range(23))]))
    n = F.col("id")
    return spark.range(12_000).select(
        n.alias("gh_event_id"),
        F.element_at(kinds, (F.when(n < 6000, n % 2).otherwise(n % 25) + 1).cast("int")).alias("event_type"),
        F.expr("TIMESTAMP_NTZ'2024-01-31 11:00:00' - make_dt_interval(0, 0, 0, id)").alias("created_at"),
        F.lit(date(2024, 1, 31)).alias("created_at_date"),
        (n % 1500).alias("actor_id"),
        (n % 1500).alias("repo_id"),
        F.lit("someone").alias("actor_login"),
        F.lit("org/repo").alias("repo_name"),
    )


def test_limits_that_are_exceeded(many, make_actors, make_repos):
    actors = make_actors(*({"actor_id": n} for n in range(1500)))
    repos = make_repos(*({"repo_id": n} for n in range(1500)))
    newest = rows(views.recent_events_summary(many, actors, repos, AS_OF).select("gh_event_id"))
    assert newest == [(n,) for n in range(10_000)]
    assert views.recent_events_summary(many, actors, repos, AS_OF, None).count() == 12_000
    types = rows(overview.event_types(many).select("event_type"))
    assert len(types) == 20 and ("WatchEvent",) in types and ("Kind22Event",) not in types

    for board, key, view, table in (
        (leaderboards.hot_repos(many, repos, AS_OF, "weighted"), "repo_id", views.trending_repos_view, repos),
        (leaderboards.active_developers(many, actors, AS_OF, "weighted"), "actor_id", views.active_developers_view, actors),
    ):
        ranked = rows(board.select("rank_position", "score" if key == "repo_id" else "activity_score", key), "rank_position")
        assert [r[0] for r in ranked] == list(range(1, 1001))
        assert ranked == sorted(ranked, key=lambda r: (-r[1], r[2]))
        shown = rows(view(board, table).select("rank_position"))
        assert shown == [(n,) for n in range(1, 101)]
        assert view(board, table, None).count() == 1000
