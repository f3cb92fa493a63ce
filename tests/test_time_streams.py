"""Streams of sessions and windows: late events, restarts and repeated batches."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import datetime, timedelta

import pytest

from eventloom.operators import sessions
from eventloom.schemas import EVENTS
from eventloom.streaming import session_stream, window_stream

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


class Files:
    """Event files that arrive one after the other."""

    def __init__(self, spark, make_events, folder):
        self.spark, self.make, self.folder, self.n, self.all = spark, make_events, str(folder), 0, []

    def arrive(self, *given):
        made = [(len(self.all) + i, "Push", at(m).isoformat(), actor, 1, None) for i, (actor, m) in enumerate(given)]
        self.all += made
        target, written = f"{self.folder}/{self.n:04d}.parquet", f"{self.folder}-{self.n}"
        self.make(made).coalesce(1).write.parquet(written)
        os.rename(glob.glob(f"{written}/part-*.parquet")[0], target)
        os.utime(target, (1_700_000_000 + self.n,) * 2)
        self.n += 1

    def stream(self):
        return session_stream.event_stream(self.spark, self.folder, EVENTS)

    def events(self):
        return self.make(self.all)


@pytest.fixture
def files(spark, make_events, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return Files(spark, make_events, folder)


def test_late_events_reopen_and_join_sessions_over_restarts(spark, files, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        session_stream.stream_sessions(files.stream(), out, progress).awaitTermination()

    files.arrive((1, 0), (1, 20), (2, 5), (None, 7))
    files.arrive((1, 70), (1, 400))
    run()
    files.arrive((3, 5000))
    run()
    files.arrive((1, 45), (2, 4), (2, 900))  # joins 0..20 with 70; reopens; opens one long closed
    files.arrive((9, 50_000))
    run()
    whole = [tuple(r) for r in sessions.actor_sessions(files.events()).where("actor_id <> 9").collect()]
    got = [tuple(r) for r in session_stream.closed_sessions(spark, out).where("actor_id <> 9").collect()]
    assert Counter(got) == Counter(whole) and (1, at(0), at(70), 4) in got


def test_state_has_rows_for_cells_not_actors(spark, files, tmp_path, monkeypatch):
    monkeypatch.setattr(session_stream, "CELLS", 4, raising=False)
    out = str(tmp_path / "out")
    files.arrive(*((actor, 5 * n) for actor in range(400) for n in range(3)))
    files.arrive(*((actor, 20 + 30 * (actor % 2)) for actor in range(400)))
    files.arrive((-1, 50_000))
    query = session_stream.stream_sessions(files.stream(), out, str(tmp_path / "progress"))
    query.awaitTermination()
    kept = max(state.numRowsTotal for progress in query.recentProgress for state in progress.stateOperators)
    assert 0 < kept <= 4 * 4  # a value and the entries of a timer for each cell
    whole = [tuple(r) for r in sessions.actor_sessions(files.events()).where("actor_id >= 0").collect()]
    got = [tuple(r) for r in session_stream.closed_sessions(spark, out).where("actor_id >= 0").collect()]
    assert Counter(got) == Counter(whole) and len(got) == 600


def test_windows_and_late_rows_add_up_and_batches_can_run_again(spark, files, tmp_path):
    tables = window_stream.window_tables(spark, str(tmp_path / "windows"))
    for n in range(6):
        base = 1440 * n
        files.arrive(*((1, base + m) for m in range(0, 600, 7)), (2, base - 2000 if n else 3), (2, base - 30 if n else 4))

    def run(progress):
        window_stream.stream_windows(files.stream(), tables, str(tmp_path / progress), 60, 30).awaitTermination()

    def state():
        kinds = {"closed": tables.closed.rows(), "open": window_stream.open_windows(tables), "late": window_stream.late_counts(tables)}
        return {k: Counter(tuple(r) for r in df.select("window_start", "window_end", "event_type", "events").collect()) for k, df in kinds.items()}

    run("progress")
    once = state()
    total, exact = Counter(), Counter()
    for own in once.values():
        assert all(n == 1 for n in own.values())  # a window is passed on once
        for start, end, kind, events in own:
            total[start, end, kind] += events
    for start, end, kind, events in window_stream.window_counts(files.events(), 60, 30).collect():
        exact[start, end, kind] += events
    assert total == exact and sum(e for *_, e in once["late"]) > 0
    # state expires: days that were closed before the last batch began hold no increments
    assert tables.open.read().selectExpr("min(end_date)").first()[0] >= at(1440 * 4).date()


def test_a_batch_that_runs_again_changes_nothing(spark, files, tmp_path, monkeypatch):
    tables = window_stream.window_tables(spark, str(tmp_path / "windows"))
    files.arrive((1, 0), (1, 100))
    files.arrive((1, 300), (1, 10))
    files.arrive((1, 5000), (1, 301))
    seen, clear = [], window_stream.clear_dates

    def fail_once(*given):
        clear(*given)
        if not seen:
            seen.append(1)
            raise RuntimeError("lost after all writes")

    monkeypatch.setattr(window_stream, "clear_dates", fail_once)
    progress = str(tmp_path / "progress")
    with pytest.raises(Exception, match="lost after all writes"):
        window_stream.stream_windows(files.stream(), tables, progress).awaitTermination()
    window_stream.stream_windows(files.stream(), tables, progress).awaitTermination()
    parts = [tables.closed.rows(), window_stream.open_windows(tables), window_stream.late_counts(tables)]
    got = Counter()
    for part in parts:
        for r in part.collect():
            got[r.window_start] += r.events
    exact = Counter({r.window_start: r.events for r in window_stream.window_counts(files.events()).collect()})
    assert got == exact and seen
