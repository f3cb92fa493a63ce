"""Running totals of actors and repositories, and who relates to what."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.counting import count_kind
from eventloom.functions.joins import keep_known
from eventloom.functions.scratch import staged
from eventloom.functions.time_windows import ntz
from eventloom.operators.entity_stats import relation_type
from eventloom.operators.upsert import ADD, REPLACE, upsert
from eventloom.schemas import FORK, WATCH

EPOCH = datetime(1970, 1, 1)
RELATION_KEY = ["actor_id", "repo_id", "relation_type"]
RELATION_POLICY = {"last_event_at": REPLACE, "event_count": ADD}


def actor_increments(events: DataFrame) -> DataFrame:
    """Per actor: events and last event time in a batch."""
    return events.groupBy("actor_id").agg(
        F.count("*").alias("events"), F.max("created_at").alias("last_at")
    )


def repo_increments(events: DataFrame) -> DataFrame:
    """Per repository: events, stars, forks and last event time in a batch."""
    return events.groupBy("repo_id").agg(
        F.count("*").alias("events"),
        count_kind(WATCH).alias("stars"),
        count_kind(FORK).alias("forks"),
        F.max("created_at").alias("last_at"),
    )


def _add(dimension: DataFrame, increments: DataFrame, key: str, last: str, totals: dict[str, str]):
    """Dimension rows with increments added; increments of unknown keys are lost."""
    found = F.col("last_at").isNotNull()
    changed = {
        last: F.when(
            found, F.greatest(F.coalesce(F.col(last), ntz(EPOCH)), F.col("last_at"))
        ).otherwise(F.col(last))
    }
    for column, counter in totals.items():
        changed[column] = F.col(column) + F.coalesce(F.col(counter), F.lit(0))
    return (
        dimension.join(increments, key, "left").withColumns(changed).select(*dimension.columns)
    )


def add_to_actors(actors: DataFrame, increments: DataFrame) -> DataFrame:
    return _add(actors, increments, "actor_id", "last_active_at", {"total_events": "events"})


def add_to_repos(repos: DataFrame, increments: DataFrame) -> DataFrame:
    totals = {"total_events": "events", "total_stars": "stars", "total_forks": "forks"}
    return _add(repos, increments, "repo_id", "last_event_at", totals)


def merge_actor_stats(actors: DataFrame, batch: DataFrame) -> DataFrame:
    """Actors with a batch of events added to their totals.

    Counts accumulate: merging a batch twice counts it twice.
    """
    return add_to_actors(actors, actor_increments(batch))


def merge_repo_stats(repos: DataFrame, batch: DataFrame) -> DataFrame:
    """Repositories with a batch of events added to their totals."""
    return add_to_repos(repos, repo_increments(batch))


def batch_relations(batch: DataFrame) -> DataFrame:
    """Relations that appear in a batch: first and last time, and events."""
    return batch.groupBy("actor_id", "repo_id", relation_type()).agg(
        F.min("created_at").alias("relation_time"),
        F.min("created_at").alias("first_event_at"),
        F.max("created_at").alias("last_event_at"),
        F.count("*").alias("event_count"),
    )


def relations_of(counted: DataFrame) -> DataFrame:
    """Relations from ``activity`` grouped by actor, repository and relation type."""
    return counted.select(
        *RELATION_KEY,
        F.col("first_at").alias("relation_time"),
        F.col("first_at").alias("first_event_at"),
        F.col("last_at").alias("last_event_at"),
        F.col("events").alias("event_count"),
    )


def merge_relations(found: DataFrame, prior: DataFrame | None) -> DataFrame:
    """``found`` merged into ``prior``.

    A stored relation keeps its first times, takes the new last time even when
    that is earlier, and adds the counts.
    """
    return found if prior is None else upsert(prior, found, RELATION_KEY, RELATION_POLICY)


def relations(
    batch: DataFrame, actors: DataFrame, repos: DataFrame, prior: DataFrame | None = None
) -> DataFrame:
    """Relations of a batch of events, merged into ``prior``.

    Only known actors and known repositories count. Ids are checked once the events
    have shrunk to relations.
    """
    found = staged(batch_relations(batch), "relations")
    return merge_relations(keep_known(found, {"actor_id": actors, "repo_id": repos}), prior)
