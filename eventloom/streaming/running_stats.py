"""Statistics kept current after every insert of the event stream.

A batch leaves only its increments behind. ``compact`` folds them from time to
time, so that they do not grow with the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions.joins import keep_known
from eventloom.operators.base_stats import (
    RELATION_KEY,
    actor_increments,
    add_to_actors,
    add_to_repos,
    batch_relations,
    merge_relations,
    repo_increments,
)
from eventloom.operators.daily_stats import count_by_day
from eventloom.operators.entity_stats import coarser
from eventloom.schemas import DAILY_STATS, RELATIONS
from eventloom.sinks.tables import dates_in, replace_dates
from eventloom.streaming.archive_stream import AfterInsert
from eventloom.streaming.store import BATCH, BatchTable

ACTOR_INCREMENTS = "actor_id bigint, events bigint, last_at timestamp_ntz"
REPO_INCREMENTS = (
    "repo_id bigint, events bigint, stars bigint, forks bigint, last_at timestamp_ntz"
)


def increment_tables(spark: SparkSession, root: str) -> dict[str, BatchTable]:
    schemas = {
        "actors": ACTOR_INCREMENTS,
        "repos": REPO_INCREMENTS,
        "relations": RELATIONS,
    }
    return {n: BatchTable(spark, f"{root}/{n}", s).create() for n, s in schemas.items()}


def compact(tables: dict[str, BatchTable], root: str) -> dict[str, BatchTable]:
    """The increment tables with all batches before the last folded, below ``root``."""
    folds = {
        "actors": lambda rows: coarser(rows.drop(BATCH), "actor_id"),
        "repos": lambda rows: coarser(rows.drop(BATCH), "repo_id"),
        "relations": folded_relations,
    }
    return {name: table.compacted(f"{root}/{name}", folds[name]) for name, table in tables.items()}


def counters(tables: dict[str, BatchTable]) -> AfterInsert:
    """Record what a batch adds to its actors and repositories."""

    def step(inserted: DataFrame, batch_id: int) -> None:
        tables["actors"].write(actor_increments(inserted), batch_id)
        tables["repos"].write(repo_increments(inserted), batch_id)

    return step


def current_actors(tables: dict[str, BatchTable], actors: DataFrame) -> DataFrame:
    """Actors with all batches so far added."""
    return add_to_actors(actors, coarser(tables["actors"].rows(), "actor_id"))


def current_repos(tables: dict[str, BatchTable], repos: DataFrame) -> DataFrame:
    """Repositories with all batches so far added."""
    return add_to_repos(repos, coarser(tables["repos"].rows(), "repo_id"))


def relation_updates(tables: dict[str, BatchTable]) -> AfterInsert:
    """Record the relations of a batch."""

    def step(inserted: DataFrame, batch_id: int) -> None:
        tables["relations"].write(batch_relations(inserted), batch_id)

    return step


def folded_relations(rows: DataFrame) -> DataFrame:
    """One row per relation: first times of its first batch, last time of its latest."""
    return rows.groupBy(*RELATION_KEY).agg(
        F.min_by("relation_time", BATCH).alias("relation_time"),
        F.min_by("first_event_at", BATCH).alias("first_event_at"),
        F.max_by("last_event_at", BATCH).alias("last_event_at"),
        F.sum("event_count").alias("event_count"),
    )


def current_relations(
    tables: dict[str, BatchTable],
    actors: DataFrame,
    repos: DataFrame,
    prior: DataFrame | None = None,
) -> DataFrame:
    """Relations after all batches so far.

    First times come from the first batch that saw the relation, the last time
    from the latest one, as if every batch had been merged in turn.
    """
    known = keep_known(tables["relations"].read(), {"actor_id": actors, "repo_id": repos})
    return merge_relations(folded_relations(known), prior)


def daily_updates(store: BatchTable, path: str) -> AfterInsert:
    """Recompute the dates that a batch touches; distinct counts stay exact."""

    def step(inserted: DataFrame, batch_id: int) -> None:
        touched = dates_in(inserted, "created_at_date")
        if touched:
            replace_dates(count_by_day(store.on_dates(touched)), path, touched)

    return step


def current_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_STATS).parquet(path)
