"""Loading archive lines into the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventloom.functions.scratch import staged_all
from eventloom.operators.entities import extract_actors, extract_orgs, extract_repos
from eventloom.operators.events import dedupe_events, ingest_metrics, project_events
from eventloom.operators.payloads import LINE, PAYLOADS, next_payload_ids, payload_numbers, with_payload_ids
from eventloom.sources.archive import well_formed


def ingest(
    lines: DataFrame, state: dict[str, DataFrame], start_ids: dict[str, int] | None = None, as_of=None
) -> dict[str, DataFrame]:
    """The rows that staged archive lines add to each table, and the counts.

    ``state`` holds the stored actors, repos and organizations, and optionally
    events and payload tables, whose ids are then continued. Every entity of the
    lines counts as known once its row has been offered, also when its name was
    taken, so the events need no further check against the dimensions.
    """
    if start_ids is None:
        start_ids = next_payload_ids(state)
    raw = well_formed(lines)
    numbers = payload_numbers(raw, start_ids)
    projected = project_events(raw, as_of=as_of)
    new, failed = staged_all(
        raw.sparkSession,
        {
            "actors": lambda: extract_actors(raw, state["actors"]),
            "repos": lambda: extract_repos(raw, state["repos"]),
            "organizations": lambda: extract_orgs(raw, state["organizations"]),
            "events": lambda: with_payload_ids(dedupe_events(projected, state.get("events")), numbers),
        },
    )
    for error in failed.values():
        raise error
    new["metrics"] = ingest_metrics(lines, projected, new["events"], new["actors"], new["repos"])
    new["events"] = new["events"].drop(*LINE)
    for name, project in PAYLOADS.items():
        new[name] = with_payload_ids(project(raw), numbers).drop(*LINE)
    return new
