"""What the plans look like, and results when one key holds a third of the rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from eventloom.functions import joins, numbering
from eventloom.functions.scratch import shared_folder, staged
from eventloom.operators import base_stats, daily_stats, entities, entity_stats, events, leaderboards, payloads
from eventloom.sinks import tables as sinks
from eventloom.sources import archive
from tests.conftest import line, rows, write_hour

AS_OF = "2024-01-31 12:00:00"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(make_events):
    """6000 events; actor 1, repository 1 and their pair hold a third each."""
    draw = random.Random(7)
    kinds = ["Watch", "Fork", "Push", "PullRequest", "Issues", "Create"]
    made = []
    for n in range(6000):
        actor = 1 if n % 3 == 0 else draw.randrange(2, 400)
        repo = 1 if n % 3 == 0 or n % 6 == 1 else draw.randrange(2, 300)
        at = datetime(2024, 1, 1) + timedelta(minutes=draw.randrange(30 * 24 * 60))
        made.append((n, draw.choice(kinds), at.isoformat(), actor, repo, n % 11 or None))
    return made, make_events(made)


@pytest.fixture(scope="module")
def stored(spark, skewed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "events")
    sinks.write_events(skewed[1], path)
    return spark.read.schema(skewed[1].schema).parquet(path)


def test_windows_prune_partitions_and_reach_the_scan(stored, make_repos):
    repos = make_repos({"repo_id": 1})
    for formula in ("weighted", "cumulative"):
        text = plan(leaderboards.hot_repos(stored, repos, AS_OF, formula))
        scan = next(t for t in text.splitlines() if "FileScan parquet" in t)
        assert "PartitionFilters: [isnotnull(created_at_date" in scan
        assert "GreaterThanOrEqual(created_at" in scan
        assert "actor_login" not in scan and "org_id" not in scan


def test_facts_are_scanned_once(stored, make_repos, make_actors):
    repos, actors = make_repos({"repo_id": 1}), make_actors({"actor_id": 1})
    for df in (
        leaderboards.hot_repos(stored, repos, AS_OF, "weighted"),
        leaderboards.active_developers(stored, actors, AS_OF, "weighted"),
        entity_stats.repo_stats_one(stored, 1, AS_OF),
        entity_stats.actor_stats(stored, actors, AS_OF),
    ):
        assert plan(df).count("FileScan parquet") == 1


def test_boards_limit_before_they_rank(stored, make_repos):
    text = plan(leaderboards.hot_repos(stored, make_repos({"repo_id": 1}), AS_OF))
    assert text.index("Window [row_number()") < text.index("TakeOrderedAndProject(limit=100")
    assert "Exchange SinglePartition" not in text


def test_statistics_of_pairs_need_no_expand(stored, make_actors):
    assert "Expand" not in plan(entity_stats.actor_stats(stored, make_actors({"actor_id": 1}), AS_OF))


def test_copies_are_dropped_before_the_shuffle(stored):
    numbered = stored.selectExpr("*", "created_at as archive_hour", "gh_event_id as line_no")
    text = plan(events.first_copies(numbered))
    assert text.index("WindowGroupLimit", text.index("Exchange hashpartitioning")) > 0


def test_few_unknown_ids_are_broadcast_and_many_are_not(spark, stored, make_actors):
    known = make_actors(*({"actor_id": n} for n in range(1, 400)))
    rows_left = events.check_ids(stored, {"actor_id": known})
    assert "BroadcastHashJoin" in plan(rows_left) and rows_left.count() == 6000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        none_known = events.check_ids(stored, {"actor_id": make_actors({"actor_id": 1})})
        assert "BroadcastHashJoin" not in plan(none_known)
        assert none_known.count() == stored.where("actor_id = 1").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_skewed_statistics_match_a_plain_count(skewed, make_actors, make_repos):
    made, df = skewed
    start = datetime(2024, 1, 24, 12)
    actors = make_actors(*({"actor_id": n} for n in range(1, 400)))
    repos = make_repos(*({"repo_id": n} for n in range(1, 300)))
    kinds, partners, week = defaultdict(Counter), defaultdict(set), defaultdict(set)
    for _, kind, at, actor, repo, _ in made:
        kinds[actor][kind] += 1
        partners[actor].add(repo)
        if datetime.fromisoformat(at) >= start:
            kinds[actor][f"{kind}7"] += 1
            week[actor].add(repo)
    expected = [
        (a, k["Push"], k["PullRequest"], k["Issues"], len(partners[a]), k["Watch"], k["Push7"], k["PullRequest7"], len(week[a]))
        for a, k in kinds.items()
        if k["Push"] + k["PullRequest"] + k["Issues"] > 0
    ]
    assert rows(entity_stats.actor_stats(df, actors, AS_OF), "actor_id") == sorted(expected)

    relations = Counter()
    for _, kind, _, actor, repo, _ in made:
        relations[(actor, repo, {"Watch": "star", "Fork": "fork"}.get(kind, "contributor"))] += 1
    found = base_stats.relations(df, actors, repos)
    assert {tuple(r[:3]): r[6] for r in found.collect()} == relations

    daily = defaultdict(lambda: (Counter(), set(), set(), set()))
    for _, kind, at, actor, repo, org in made:
        counted, people, places, teams = daily[(datetime.fromisoformat(at).date(), f"{kind}Event")]
        counted["n"] += 1
        people.add(actor)
        places.add(repo)
        teams.update({org} - {None})
    found = {tuple(r[:2]): tuple(r[2:]) for r in daily_stats.count_by_day(df).collect()}
    assert found == {k: (c["n"], len(a), len(r), len(o)) for k, (c, a, r, o) in daily.items()}


def test_a_third_of_all_rows_being_copies(spark, skewed):
    made, df = skewed
    numbered = df.selectExpr(
        "* except(gh_event_id, created_at_date)",
        "case when gh_event_id % 3 = 0 then -1 else gh_event_id end as gh_event_id",
        "DATE'2024-01-05' as created_at_date",
        "TIMESTAMP_NTZ'2024-01-05 00:00:00' as archive_hour",
        "gh_event_id as line_no",
    )
    kept = rows(events.first_copies(numbered).select("gh_event_id", "line_no"), "line_no")
    assert kept == [(-1, 0)] + [(n, n) for n in range(6000) if n % 3]


def test_scratch_uses_the_cluster_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_lines_are_parsed_once_and_after_they_are_spread(spark, tmp_path):
    write_hour(tmp_path, "2024-01-05-1", [line(1)])
    text = plan(events.usable_lines(archive.read_archive(spark, str(tmp_path)), AS_OF))
    assert text.count("from_json") == 1
    assert text.index("from_json") < text.index("REBALANCE_PARTITIONS_BY_NONE")


def test_facts_are_read_at_most_twice_to_validate(spark, stored, make_actors, make_repos, make_orgs):
    stages = []
    original = joins.staged

    def scans(df):
        return sum("FileScan parquet" in text and "actor_id#" in text for text in plan(df).splitlines())

    def counting(df, label="stage"):
        stages.append(scans(df))
        return original(df, label)

    joins.staged = counting
    try:
        checked = events.validate_events(stored, make_actors({"actor_id": 1}), make_repos({"repo_id": 1}), make_orgs({"org_id": 1}))
    finally:
        joins.staged = original
    assert sum(stages) + scans(checked) == 2


def test_retention_counts_read_only_what_expires(stored):
    tables = {"events": stored, "event_stats_daily": stored.selectExpr("created_at_date as stats_date"),
              "user_repo_relation": stored.selectExpr("created_at as last_event_at")}
    text = plan(sinks.retention_counts(tables, 20, AS_OF))
    assert text.count("FileScan parquet") == 3
    assert text.count("PartitionFilters: [isnotnull(created_at_date") >= 2


def test_retention_prunes_partitions(stored):
    kept = sinks.retain(
        {"events": stored, "event_stats_daily": stored.selectExpr("created_at_date as stats_date"),
         "user_repo_relation": stored.selectExpr("created_at as last_event_at")}, 20, AS_OF,
    )
    assert "PartitionFilters: [((created_at_date" in plan(kept["events"])


def staged_by(module, work):
    """What ``work`` returns, and the plans of what it staged through ``module``."""
    plans, original = [], module.staged

    def noting(df, label="stage"):
        plans.append(plan(df))
        return original(df, label)

    module.staged = noting
    try:
        return work(), plans
    finally:
        module.staged = original


def test_entities_are_found_without_sorting_lines(spark, parsed, make_actors):
    raw = archive.well_formed(staged(parsed(*(line(n, actor=n % 5) for n in range(50)))))
    found, (first,) = staged_by(entities, lambda: entities.extract_actors(raw, make_actors({"actor_id": 1})))
    before_exchange = first[first.index("functions=[partial_min(") :]
    before_exchange = before_exchange[: before_exchange.index("FileScan")]
    assert "SortAggregate" not in first and "Sort [" not in before_exchange and "payload" not in first
    assert found.count() == 3


def test_numbering_moves_neither_payloads_nor_other_kinds(spark, parsed):
    kinds = ("PushEvent", "IssuesEvent")
    raw = archive.well_formed(staged(parsed(*(line(n, kinds[n % 2]) for n in range(50)))))
    numbers, (placed,) = staged_by(numbering, lambda: payloads.payload_numbers(raw))
    assert "payload" not in placed and "PushedFilters" in placed and numbers.count() == 25


def test_relations_read_the_facts_once(stored, make_actors, make_repos):
    known = make_actors({"actor_id": 1}), make_repos({"repo_id": 1})
    found, (grouped,) = staged_by(base_stats, lambda: base_stats.relations(stored, *known))
    assert grouped.count("FileScan parquet") == 1
    assert "event_type" not in plan(found)


def test_loads_broadcast_nothing_that_grows(spark, stored, parsed, make_actors, monkeypatch):
    raw = archive.well_formed(staged(parsed(*(line(n, actor=n % 5) for n in range(50)))))
    numbers = payloads.payload_numbers(raw)
    text = plan(payloads.with_payload_ids(payloads.payload_push(raw), numbers))
    assert "SortMergeJoin" in text[: text.index("BroadcastHashJoin")]  # the shifts, a row a partition
    numbered = stored.selectExpr("*", "created_at as archive_hour", "gh_event_id as line_no")
    assert "Broadcast" not in plan(events.not_stored(numbered, stored))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    found, (first,) = staged_by(entities, lambda: entities.extract_actors(raw, make_actors({"actor_id": 1})))
    assert "Broadcast" not in first + plan(found)
    assert rows(found.select("actor_id"), "actor_id") == [(2,), (3,), (4,)]
