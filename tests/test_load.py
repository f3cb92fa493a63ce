"""Loads that land in stored tables."""

from __future__ import annotations

from pathlib import Path
from threading import Barrier

import pytest

from eventloom.functions.scratch import application_folder
from eventloom.plans import load
from eventloom.streaming import archive_stream as stream
from tests.conftest import line, rows, write_hour
from tests.test_streaming import AS_OF, add_hour


def archive_of_two_days(tmp_path):
    folder = tmp_path / "archive"
    folder.mkdir()
    for day, first in ((5, 1), (6, 21)):
        lines = [line(n, actor=n % 4 + day, repo=n % 3 + 1, time=f"2024-01-0{day}T01:00:00Z") for n in range(first, first + 20)]
        write_hour(folder, f"2024-01-0{day}-1", [*lines, lines[0]])
    return str(folder)


def contents(tables):
    return {name: sorted(map(repr, rows(table.read().drop("batch_id")))) for name, table in tables.items()}


def test_loads_add_up_and_can_be_repeated(spark, tmp_path):
    root = archive_of_two_days(tmp_path)
    tables = load.stored_tables(spark, str(tmp_path / "tables"))
    report = load.load_archive(spark, root, tables, ["2024-01-05"], 1, as_of=AS_OF)
    assert rows(report.groupBy("state").count(), "state") == [("loaded", 1), ("missing", 23)]
    load.load_archive(spark, root, tables, ["2024-01-06"], 2, as_of=AS_OF)
    before = contents(tables)
    assert len(before["events"]) == 40
    assert [r[0] for r in rows(tables["actors"].read().select("actor_id"), "actor_id")] == [5, 6, 7, 8, 9]
    assert [r[0] for r in rows(tables["payload_push"].read().select("payload_id"), "payload_id")] == list(range(1, 43))
    for batch_id, day in ((1, "2024-01-05"), (2, "2024-01-06")):
        load.load_archive(spark, root, tables, [day], batch_id, as_of=AS_OF)
        assert contents(tables) == before


def test_plan_does_not_grow_with_the_loads(spark, tmp_path):
    root = archive_of_two_days(tmp_path)
    tables = load.stored_tables(spark, str(tmp_path / "tables"))
    sizes = []
    for batch_id, day in enumerate(("2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08")):
        load.load_archive(spark, root, tables, [day], batch_id, as_of=AS_OF)
        sizes.append(len(tables["actors"].read()._jdf.queryExecution().analyzed().toString().splitlines()))
    assert len(set(sizes)) == 1


def test_stream_keeps_events_of_new_actors_and_frees_its_staging(spark, tmp_path):
    folder = tmp_path / "archive"
    folder.mkdir()
    for hour in range(1, 4):
        add_hour(folder, hour, [line(hour * 10 + n, actor=hour * 10 + n, time=f"2024-01-05T0{hour}:00:00Z") for n in range(5)])
    staging = Path(application_folder(spark))
    before = set(staging.iterdir()) if staging.exists() else set()
    tables = load.stored_tables(spark, str(tmp_path / "tables"))
    load.stream_load(stream.line_stream(spark, str(folder)), tables, str(tmp_path / "progress"), AS_OF).awaitTermination()
    assert tables["events"].read().count() == tables["actors"].read().count() == 15
    assert tables["events"].read().select("batch_id").distinct().count() == 3
    left = (set(staging.iterdir()) if staging.exists() else set()) - before
    assert not left


def test_payload_ids_go_on_without_reading_stored_payloads(spark, tmp_path, monkeypatch):
    root = archive_of_two_days(tmp_path)
    tables = load.stored_tables(spark, str(tmp_path / "tables"))
    load.load_archive(spark, root, tables, ["2024-01-05"], 1, as_of=AS_OF)
    asked, real = [], load.next_payload_ids
    monkeypatch.setattr(load, "next_payload_ids", lambda own: asked.append(own) or real(own))
    load.load_archive(spark, root, tables, ["2024-01-06"], 2, as_of=AS_OF)
    assert load.free_payload_ids(tables, 3)["PushEvent"] == 43
    assert len(asked) == 1  # of the load itself, to note its ids
    text = asked[0]["payload_push"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "= 2" in text
    load.load_archive(spark, root, tables, ["2024-01-07"], 3, as_of=AS_OF)  # a day without lines
    assert load.free_payload_ids(tables, 4)["PushEvent"] == 43


def test_tables_are_written_at_the_same_time_and_events_last(spark, tmp_path, monkeypatch):
    root = archive_of_two_days(tmp_path)
    tables = load.stored_tables(spark, str(tmp_path / "tables"))
    together, order, write = Barrier(len(load.LOADED) - 1, timeout=60), [], load.BatchTable.write

    def noting(table, rows, batch_id):
        name = Path(table.path).name
        if name in load.LOADED and name != "events":
            together.wait()  # goes on only when all of them are being written
        write(table, rows, batch_id)
        order.append(name)

    monkeypatch.setattr(load.BatchTable, "write", noting)
    load.load_archive(spark, root, tables, ["2024-01-05"], 1, as_of=AS_OF)
    assert order.index("events") == len(load.LOADED) - 1 and tables["events"].read().count() == 20


def test_a_failed_write_stops_a_load_before_its_events(spark, tmp_path, monkeypatch):
    root = archive_of_two_days(tmp_path)
    tables = load.stored_tables(spark, str(tmp_path / "tables"))
    write = load.BatchTable.write

    def failing(table, rows, batch_id):
        if table.path.endswith("payload_fork"):
            raise OSError("no room")
        write(table, rows, batch_id)

    monkeypatch.setattr(load.BatchTable, "write", failing)
    with pytest.raises(OSError, match="no room"):
        load.load_archive(spark, root, tables, ["2024-01-05"], 1, as_of=AS_OF)
    assert tables["events"].read().count() == 0
