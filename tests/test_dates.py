"""Dates that must neither end nor double a load."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from eventloom.functions import time_windows
from eventloom.operators.events import dedupe_events, usable_lines
from eventloom.sinks import tables as sinks
from eventloom.sources.archive import well_formed
from eventloom.streaming import archive_stream
from tests.conftest import line, write_hour

YEAR_0, YEAR_999 = "0000-01-01T00:00:00Z", "0999-06-15T08:00:00Z"


def test_a_line_of_year_0_is_skipped_and_one_of_year_999_is_not(parsed):
    raw = well_formed(parsed(line(1, time=YEAR_0), line(2, time=YEAR_999), line(2, time=YEAR_999), line(3, time="0001-01-01T00:00:00Z")))
    kept = dedupe_events(usable_lines(raw), usable_lines(raw).limit(0))
    assert sorted((r.gh_event_id, r.created_at_date) for r in kept.collect()) == [(2, date(999, 6, 15)), (3, date(1, 1, 1))]


def test_a_line_without_a_time_gets_its_archive_hour(parsed):
    got = usable_lines(well_formed(parsed(line(1, created_at="absent")))).first()
    assert got.created_at == datetime(2024, 1, 5, 10)


@pytest.fixture
def stream(spark, tmp_path):
    folder = tmp_path / "archive"
    folder.mkdir()

    def run(name, *lines, hour="2024-01-05-10"):
        write_hour(folder, hour, lines)
        store = archive_stream.event_store(spark, str(tmp_path / "events"))
        source = archive_stream.line_stream(spark, str(folder))
        archive_stream.stream_ingest(source, store, str(tmp_path / name)).awaitTermination()
        return store

    return run


def test_a_stream_outlives_odd_dates_and_knows_their_copies(stream):
    lines = line(1, time=YEAR_0), line(2, time=YEAR_999), line(3)
    stream("progress", *lines)
    store = stream("progress", *lines, hour="2024-01-05-11")
    assert sorted(r.gh_event_id for r in store.rows().collect()) == [2, 3]
    assert store.on_dates({date(999, 6, 15)}).count() == 1


def test_a_batch_repeated_on_another_day_stores_the_same_rows(stream, monkeypatch):
    lines = line(1, created_at="absent"), line(2)
    store = stream("first", *lines)
    once = sorted(map(tuple, store.rows().collect()))
    real = time_windows.moment
    monkeypatch.setattr(time_windows, "moment", lambda as_of=None: real(as_of or "2031-05-05"))
    store = stream("second", *lines)  # the same batch number, from the start
    assert sorted(map(tuple, store.rows().collect())) == once


def test_retention_deletes_years_before_1000(spark, tmp_path, make_events):
    path = str(tmp_path / "events")
    events = make_events([(1, "Push", "0999-06-15T08:00:00", 1, 1, None), (2, "Push", "2024-01-05T08:00:00", 1, 1, None)])
    sinks.write_events(events, path)
    sinks.expire_dates(spark, path, "created_at_date", 10, "2024-01-06")
    assert [r.gh_event_id for r in spark.read.schema(events.schema).parquet(path).collect()] == [2]
