from __future__ import annotations

import json
from datetime import date, datetime

from eventloom.operators import entities, events, payloads
from eventloom.plans.ingest import ingest
from eventloom.sources.archive import LINE_SCHEMA, parse_lines, well_formed
from tests.conftest import line, rows

AS_OF = "2024-01-31 12:00:00"


def changed(text, **parts):
    """A line with some parts replaced as a whole."""
    return json.dumps({**json.loads(text), **parts})


def by_actor(event_id, number, login, **more):
    return changed(line(event_id), actor={"id": number, "login": login, **more})


def test_first_seen_actor_wins_and_defaults_apply(parsed, make_actors):
    raw = parsed(
        line(1, actor=1),
        by_actor(2, 5, "first"),
        by_actor(3, 5, "second", display_login="Five"),
        by_actor(4, 6, "x" * 150, display_login="Six"),
        by_actor(5, 0, "zero"),
        changed(line(6), actor=None),
        changed(line(7), actor={"id": 8}),
    )
    found = rows(entities.extract_actors(raw, make_actors({"actor_id": 1})), "actor_id")
    assert [r[:3] for r in found] == [(5, "first", "first"), (6, "x" * 100, "Six"), (8, "", "")]


def test_taken_names_are_dropped_regardless_of_case(parsed, make_actors):
    raw = parsed(
        by_actor(1, 5, "Taken"), by_actor(2, 7, "FREE"), by_actor(3, 6, "free"), by_actor(4, 9, "own")
    )
    stored = make_actors({"actor_id": 1, "login": "tAKEN"})
    found = rows(entities.extract_actors(raw, stored).select("actor_id", "login"), "actor_id")
    assert found == [(7, "FREE"), (9, "own")]


def test_repos_and_orgs(parsed, make_repos, make_orgs):
    raw = parsed(
        changed(line(1, repo=3), org={"id": 8, "login": "team"}),
        changed(line(2, repo=3), repo={"id": 3, "name": "renamed"}, org=None),
        changed(line(3, repo=4), org={"id": 9, "login": "TEAM"}),
    )
    repos = entities.extract_repos(raw, make_repos({"repo_id": 4}))
    assert rows(repos.select("repo_id", "name")) == [(3, "org/repo-3")]
    orgs = entities.extract_orgs(raw, make_orgs({"org_id": 1}))
    assert rows(orgs.select("org_id", "login")) == [(8, "team")]


def test_payload_defaults(parsed):
    raw = parsed(
        line(1, payload={"push_id": 7}),
        line(2, payload=None),
        line(3, "ForkEvent", payload={"forkee": {"id": 4, "full_name": None}}),
        line(4, "CreateEvent", payload={"ref": None, "ref_type": "x" * 30, "description": None}),
        changed(line(5, "WatchEvent"), repo={"name": "nameless"}),
    )
    push = payloads.payload_push(raw).drop("archive_hour", "line_no")
    assert rows(push, "gh_event_id") == [(1, 7, 0, 0, "", ""), (2, None, 0, 0, "", "")]
    assert rows(payloads.payload_fork(raw).drop("archive_hour", "line_no")) == [(3, 4, "")]
    assert rows(payloads.payload_create(raw).drop("archive_hour", "line_no")) == [(4, "", "x" * 20, None)]
    assert rows(payloads.payload_star(raw).drop("archive_hour", "line_no")) == [(5, "started", 0)]


def test_payload_keys_are_dense_per_kind_also_for_copies(spark):
    """One event makes up a third of the lines; still every line gets its own id."""
    kinds = ["PushEvent", "WatchEvent", "IssuesEvent", "ForkEvent"]
    texts = [line(1 if n % 3 == 0 else n, "PushEvent" if n % 3 == 0 else kinds[n % 4]) for n in range(3000)]
    lines = spark.createDataFrame([(t, datetime(2024, 1, 5, n // 500), n) for n, t in enumerate(texts)], LINE_SCHEMA)
    raw = well_formed(parse_lines(lines.repartition(7)))
    next_id, expected = {"PushEvent": 50}, {}
    for n, text in enumerate(texts):
        kind = json.loads(text)["type"]
        expected[n] = next_id.get(kind, 1) if kind != "IssuesEvent" else 1
        next_id[kind] = next_id.get(kind, 1) + 1
    keys = payloads.payload_keys(raw, {"PushEvent": 50}).select("line_no", "payload_id")
    assert dict(rows(keys)) == expected


def test_projection_rules(parsed, make_actors, make_repos, make_orgs):
    raw = well_formed(
        parsed(
            line(1, time="2024-01-05T23:59:59Z", org={"id": 4, "login": "t"}),
            line(2, org={"id": 5, "login": "unknown"}),
            line(3, actor=2),
            line(4, repo=9),
            line(5, time="whenever"),
            line(6, time="absent"),
            line(7, time="2024-01-05T23:30:00-05:00"),
            line(8, public=False),
            line(9, actor=0),
            changed(line(10), repo=None),
            changed(line(11), org=None),
        )
    )
    found = events.project_events(
        raw, make_actors({"actor_id": 1}), make_repos({"repo_id": 1}), make_orgs({"org_id": 4}), AS_OF
    )
    kept = {r.gh_event_id: r for r in found.collect()}
    assert sorted(kept) == [1, 2, 6, 7, 8, 11]
    assert (kept[1].org_id, kept[2].org_id, kept[11].org_id) == (4, None, None)
    assert kept[1].created_at_date == date(2024, 1, 5)
    assert kept[6].created_at == datetime(2024, 1, 31, 12)
    assert kept[7].created_at == datetime(2024, 1, 5, 23, 30)
    assert (kept[1].public, kept[8].public) == (1, 0)


def test_dedupe_keeps_the_first_copy_per_date(parsed, make_events):
    raw = parsed(
        line(1, "WatchEvent"), line(1, "ForkEvent"), line(1, time="2024-01-06T00:00:00Z"), line(2), line(3)
    )
    batch = events.project_events(raw)
    stored = make_events([(2, "Push", "2024-01-05 01:00:00", 1, 1, None), (3, "Push", "2024-01-04 01:00:00", 1, 1, None)])
    found = events.dedupe_events(batch, stored).select("gh_event_id", "event_type", "created_at_date")
    assert rows(found, "gh_event_id", "created_at_date") == [
        (1, "WatchEvent", date(2024, 1, 5)),
        (1, "PushEvent", date(2024, 1, 6)),
        (3, "PushEvent", date(2024, 1, 5)),
    ]


def test_first_failing_check_names_the_error(make_events, make_actors, make_repos, make_orgs):
    checked = events.validate_events(
        make_events(
            [
                (1, "Push", "2024-01-05", 1, 1, None),
                (2, "Push", "2024-01-05", 7, 8, 9),
                (3, "Push", "2024-01-05", 1, 8, 9),
                (4, "Push", "2024-01-05", 1, 1, 9),
                (5, "Push", "2024-01-05", 1, 1, 4),
            ]
        ),
        make_actors({"actor_id": 1}),
        make_repos({"repo_id": 1}),
        make_orgs({"org_id": 4}),
    )
    assert rows(checked.select("gh_event_id", "is_valid", "error_msg"), "gh_event_id") == [
        (1, 1, ""),
        (2, 0, "Invalid actor_id: 7"),
        (3, 0, "Invalid repo_id: 8"),
        (4, 0, "Invalid org_id: 9"),
        (5, 1, ""),
    ]


def test_ingest_twice_adds_nothing(spark, parsed, make_actors, make_repos, make_orgs):
    lines = parsed(
        by_actor(1, 5, "Taken"), line(2, "WatchEvent"), line(2, "WatchEvent"), line(3, actor=0), "{broken"
    )
    state = {
        "actors": make_actors({"actor_id": 9, "login": "taken"}),
        "repos": make_repos({"repo_id": 77}),
        "organizations": make_orgs({"org_id": 77}),
    }
    first = ingest(lines, state, as_of=AS_OF)
    assert first["metrics"].first().asDict() == {
        "lines_read": 5,
        "lines_malformed": 1,
        "events_inserted": 2,
        "actors_inserted": 1,
        "repos_inserted": 1,
        "skipped": 1,
    }
    # The actor whose name was taken has no row, but its event is kept.
    assert [r.actor_id for r in first["events"].orderBy("gh_event_id").collect()] == [5, 1]
    assert [r.payload_id for r in first["events"].orderBy("gh_event_id").collect()] == [1, 1]
    assert first["payload_star"].count() == 2

    state = {
        "actors": state["actors"].unionByName(first["actors"], allowMissingColumns=True),
        "repos": state["repos"].unionByName(first["repos"], allowMissingColumns=True),
        "organizations": state["organizations"],
        "events": first["events"],
    }
    again = ingest(lines, state, as_of=AS_OF)["metrics"].first()
    assert (again.events_inserted, again.actors_inserted, again.repos_inserted) == (0, 0, 0)
