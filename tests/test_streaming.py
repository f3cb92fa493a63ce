from __future__ import annotations

import os
from datetime import date, datetime

from eventloom.streaming import archive_stream as stream, running_stats as running
from tests.conftest import line, rows, write_hour

AS_OF = "2024-01-31 12:00:00"


def add_hour(folder, hour, lines):
    """A stream takes files in the order of their times, so these are set apart."""
    write_hour(folder, f"2024-01-05-{hour}", lines)
    os.utime(folder / f"2024-01-05-{hour}.json.gz", (1704412800 + hour, 1704412800 + hour))


def hours(tmp_path):
    folder = tmp_path / "archive"
    folder.mkdir()
    first, second = "2024-01-05T01:00:00Z", "2024-01-05T02:00:00Z"
    kinds = ("PushEvent", "WatchEvent")
    add_hour(folder, 1, [line(n, kinds[n % 2], actor=n % 3 + 1, time=first) for n in range(1, 11)])
    # The second hour repeats five events and brings one of the day before.
    repeats = [line(n, "ForkEvent", time=second) for n in range(6, 16)]
    add_hour(folder, 2, repeats + [line(99, "WatchEvent", time="2024-01-04T23:00:00Z")])
    return str(folder)


def run(spark, tmp_path, *after):
    """Run the stream over the archive folder, made at the first call."""
    folder = tmp_path / "archive"
    root = str(folder) if folder.exists() else hours(tmp_path)
    store = stream.event_store(spark, str(tmp_path / "events"))
    steps = tuple(step(store) for step in after)
    lines = stream.line_stream(spark, root)
    progress = str(tmp_path / "progress")
    stream.stream_ingest(lines, store, progress, None, steps, AS_OF).awaitTermination()
    return store


def test_every_event_is_stored_once_over_batches(spark, tmp_path):
    store = run(spark, tmp_path)
    assert [r[0] for r in rows(store.rows().select("gh_event_id"), "gh_event_id")] == [*range(1, 16), 99]
    assert rows(store.read().groupBy("batch_id").count(), "batch_id") == [(0, 10), (1, 6)]


def test_new_files_continue_where_the_stream_stopped(spark, tmp_path):
    run(spark, tmp_path)
    add_hour(tmp_path / "archive", 3, [line(15), line(16, time="2024-01-05T03:00:00Z")])
    store = run(spark, tmp_path)
    assert store.rows().count() == 17
    assert rows(store.read().where("gh_event_id = 16").select("batch_id")) == [(2,)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path, make_actors, make_repos):
    tables = running.increment_tables(spark, str(tmp_path / "increments"))
    steps = (lambda _: running.counters(tables), lambda _: running.relation_updates(tables))
    store = run(spark, tmp_path, *steps)
    actors = make_actors(*({"actor_id": n} for n in (1, 2, 3)))
    repos = make_repos({"repo_id": 1, "total_stars": 5})

    def state():
        return (
            rows(running.current_actors(tables, actors), "actor_id"),
            rows(running.current_repos(tables, repos), "repo_id"),
            rows(running.current_relations(tables, actors, repos), "actor_id", "relation_type"),
        )

    before = state()
    again = store.read().where("batch_id = 1").drop("batch_id")
    copied = spark.createDataFrame(again.collect(), again.schema)
    running.counters(tables)(copied, 1)
    running.relation_updates(tables)(copied, 1)
    store.write(copied, 1)
    assert state() == before
    assert store.rows().count() == 16
    assert sum(r[6] for r in before[0]) == 16
    stars = before[1][0][3]
    assert stars == 5 + 5 + 1


def test_relations_follow_the_order_of_batches(spark, tmp_path, make_actors, make_repos):
    tables = running.increment_tables(spark, str(tmp_path / "increments"))
    run(spark, tmp_path, lambda _: running.relation_updates(tables))
    found = running.current_relations(tables, make_actors({"actor_id": 1}), make_repos({"repo_id": 1}))
    star = found.where("relation_type = 'star'").first()
    # The late event of the day before moves the last time back, not the first.
    assert star.first_event_at == datetime(2024, 1, 5, 1)
    assert star.last_event_at == datetime(2024, 1, 4, 23)
    assert star.event_count == 3


def test_folded_increments_give_the_same_totals(spark, tmp_path, make_actors, make_repos):
    tables = running.increment_tables(spark, str(tmp_path / "increments"))
    steps = (lambda _: running.counters(tables), lambda _: running.relation_updates(tables))
    store = run(spark, tmp_path, *steps)
    add_hour(tmp_path / "archive", 3, [line(60 + n, "WatchEvent", time="2024-01-05T03:00:00Z") for n in range(4)])
    run(spark, tmp_path, *steps)
    actors, repos = make_actors(*({"actor_id": n} for n in (1, 2, 3))), make_repos({"repo_id": 1})

    def state(of):
        return (
            rows(running.current_actors(of, actors), "actor_id"),
            rows(running.current_repos(of, repos), "repo_id"),
            rows(running.current_relations(of, actors, repos), "actor_id", "relation_type"),
        )

    folded = running.compact(tables, str(tmp_path / "folded"))
    assert state(folded) == state(tables)
    assert rows(folded["actors"].read().groupBy("batch_id").count(), "batch_id") == [(1, 3), (2, 1)]
    # The last batch may run again, and the stream goes on, on the folded tables.
    running.counters(folded)(store.read().where("batch_id = 2").drop("batch_id"), 2)
    assert state(folded) == state(tables)
    events = store.compacted(str(tmp_path / "fewer"))
    assert rows(events.rows(), "gh_event_id") == rows(store.rows(), "gh_event_id")
    assert rows(events.read().select("batch_id").distinct(), "batch_id") == [(1,), (2,)]
    empty = running.increment_tables(spark, str(tmp_path / "none"))
    assert running.compact(empty, str(tmp_path / "still-none"))["repos"].rows().count() == 0


def test_daily_statistics_stay_exact(spark, tmp_path):
    path = str(tmp_path / "daily")
    run(spark, tmp_path, lambda store: running.daily_updates(store, path))
    found = running.current_daily(spark, path).select("stats_date", "event_type", "total_count", "unique_actors")
    assert rows(found, "stats_date", "event_type") == [
        (date(2024, 1, 4), "WatchEvent", 1, 1),
        (date(2024, 1, 5), "ForkEvent", 5, 1),
        (date(2024, 1, 5), "PushEvent", 5, 3),
        (date(2024, 1, 5), "WatchEvent", 5, 3),
    ]


def test_repeats_are_dropped_however_late(spark, tmp_path):
    store = stream.event_store(spark, str(tmp_path / "distinct"))
    root = hours(tmp_path)

    def run_on():
        stream.stream_dedupe(stream.line_stream(spark, root), store, str(tmp_path / "progress"), as_of=AS_OF).awaitTermination()
        return [r[0] for r in rows(store.rows().select("gh_event_id"), "gh_event_id")]

    assert run_on() == [*range(1, 16), 99]
    # An hour that comes late, an id on two dates, and lines without an id.
    late = [line(50, time="2024-01-01T00:00:00Z"), line(3), line(3, time="2024-01-06T00:00:00Z"), line(id=None), line(id=None)]
    write_hour(tmp_path / "archive", "2024-01-01-0", late)
    assert run_on() == [0, 1, 2, 3, 3, *range(4, 16), 50, 99]


def test_staging_is_freed_after_every_batch(spark, tmp_path, make_actors):
    from pathlib import Path

    from eventloom.functions.scratch import application_folder

    root = hours(tmp_path)
    for hour in (3, 4, 5):
        add_hour(tmp_path / "archive", hour, [line(100 + hour, time=f"2024-01-05T0{hour}:00:00Z")])
    folder = Path(application_folder(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    store = stream.event_store(spark, str(tmp_path / "events"))
    dimensions = {"actor_id": make_actors(*({"actor_id": n} for n in (1, 2, 3)))}
    daily = running.daily_updates(store, str(tmp_path / "daily"))
    stream.stream_ingest(
        stream.line_stream(spark, root), store, str(tmp_path / "progress"), dimensions, (daily,), AS_OF
    ).awaitTermination()
    assert store.rows().count() == 19
    assert set(folder.iterdir()) == before


def test_invalid_events_go_to_quarantine(spark, tmp_path, make_actors, make_repos, make_orgs):
    valid = stream.event_store(spark, str(tmp_path / "valid"))
    invalid = stream.quarantine_store(spark, str(tmp_path / "invalid"))
    known = make_actors({"actor_id": 1}), make_repos({"repo_id": 1}), make_orgs({"org_id": 1})
    lines = stream.line_stream(spark, hours(tmp_path))
    stream.stream_validate(lines, valid, invalid, str(tmp_path / "progress"), *known).awaitTermination()
    messages = rows(invalid.rows().groupBy("error_msg").count(), "error_msg")
    assert messages == [("Invalid actor_id: 2", 4), ("Invalid actor_id: 3", 3)]
    assert valid.rows().count() == 14
