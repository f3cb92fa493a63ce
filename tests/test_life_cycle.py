"""From empty tables over two days of archive files to leaderboards."""

from __future__ import annotations

from datetime import datetime

from eventloom.functions.scratch import staged
from eventloom.operators import views
from eventloom.plans.ingest import ingest
from eventloom.plans.nightly import update_all
from eventloom.plans.tables import empty_tables, extended
from eventloom.sources.archive import days_between, stage_lines
from tests.conftest import line, rows, write_hour

AS_OF = "2024-01-07 00:00:00"


def load(spark, root, day, state):
    new = ingest(stage_lines(spark, root, days_between(day, day)), state, as_of=AS_OF)
    grown = extended(state, new)
    return {name: staged(df, name) for name, df in grown.items()}, new


def test_two_days(spark, tmp_path):
    def star(n, repo, day):
        return line(n, "WatchEvent", actor=n % 4 + 1, repo=repo, time=f"2024-01-0{day}T10:00:00Z")

    write_hour(tmp_path, "2024-01-05-10", [star(n, 1, 5) for n in range(1, 6)] + [line(50)])
    write_hour(tmp_path, "2024-01-06-10", [star(n, 2, 6) for n in range(6, 9)] + [star(8, 2, 6)])
    state, first = load(spark, str(tmp_path), "2024-01-05", empty_tables(spark))
    first_day = state["events"]
    state = {**state, **update_all(state, AS_OF)}
    assert rows(state["hot_repos"].select("repo_id", "score", "stars_7d")) == [(1, 10.0, 5)]

    state, second = load(spark, str(tmp_path), "2024-01-06", state)
    assert second["events"].count() == 3
    assert rows(state["payload_star"].select("payload_id"), "payload_id") == [(n,) for n in range(1, 10)]
    added = state["events"].join(first_day.select("gh_event_id"), "gh_event_id", "left_anti")
    after = update_all(state, AS_OF, batch=added)
    board = after["hot_repos"].select("repo_id", "score", "rank_position")
    assert rows(board) == [(1, 15.0, 1), (2, 6.0, 2)]
    totals = after["repos"].select("repo_id", "total_stars", "total_events", "last_event_at")
    assert rows(totals, "repo_id") == [
        (1, 5, 6, datetime(2024, 1, 5, 10)),
        (2, 3, 3, datetime(2024, 1, 6, 10)),
    ]
    assert after["user_repo_relation"].agg({"event_count": "sum"}).first()[0] == 9
    shown = views.trending_repos_view(after["hot_repos"], after["repos"])
    assert rows(shown.select("repo_id", "total_stars", "contributors_7d")) == [(1, 5, 0), (2, 3, 0)]
