"""Typed payload rows and the keys that link events to them.

Payload frames have one row per archive line of their kind. ``gh_event_id``
and the input order say which line a row came from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.numbering import numbered
from eventloom.functions.text import clipped
from eventloom.schemas import CREATE, CREATE_PAYLOAD, FORK, FORK_PAYLOAD, PUSH, PUSH_PAYLOAD, WATCH

# The kinds that have a payload table, and the id all others share.
KIND_TABLES = {
    PUSH: "payload_push",
    WATCH: "payload_star",
    FORK: "payload_fork",
    CREATE: "payload_create",
}
LOADED_KINDS = tuple(KIND_TABLES)
SHARED_PAYLOAD_ID = 1
LINE = ("archive_hour", "line_no")


def gh_event_id() -> Column:
    """The archive's event id; a missing or non-numeric one is stored as 0."""
    return F.coalesce(F.col("id").try_cast("bigint"), F.lit(0)).alias("gh_event_id")


def line_columns() -> list:
    """What identifies a line."""
    return [*LINE, gh_event_id()]


def _of_kind(raw: DataFrame, event_type: str, schema: str | None = None) -> DataFrame:
    rows = raw.where(F.col("type") == event_type)
    return rows.withColumn("p", F.from_json("payload", schema)) if schema else rows


def payload_push(raw: DataFrame) -> DataFrame:
    def count(name: str) -> Column:
        return F.coalesce(F.col(f"p.{name}").try_cast("int"), F.lit(0)).alias(name)

    return _of_kind(raw, PUSH, PUSH_PAYLOAD).select(
        *line_columns(),
        F.col("p.push_id").try_cast("bigint").alias("push_id"),
        count("size"),
        count("distinct_size"),
        clipped("p.head", 100).alias("head"),
        clipped("p.ref", 255).alias("ref"),
    )


def payload_star(raw: DataFrame) -> DataFrame:
    return _of_kind(raw, WATCH).select(
        *line_columns(),
        F.lit("started").alias("action"),
        F.coalesce(F.col("repo.id").try_cast("bigint"), F.lit(0)).alias("star_repo_id"),
    )


def payload_fork(raw: DataFrame) -> DataFrame:
    return _of_kind(raw, FORK, FORK_PAYLOAD).select(
        *line_columns(),
        F.col("p.forkee.id").try_cast("bigint").alias("forkee_id"),
        clipped("p.forkee.full_name", 255).alias("forkee_name"),
    )


def payload_create(raw: DataFrame) -> DataFrame:
    return _of_kind(raw, CREATE, CREATE_PAYLOAD).select(
        *line_columns(),
        clipped("p.ref", 255).alias("ref"),
        clipped("p.ref_type", 20).alias("ref_type"),
        F.col("p.description").alias("description"),
    )


PAYLOADS = {
    "payload_push": payload_push,
    "payload_star": payload_star,
    "payload_fork": payload_fork,
    "payload_create": payload_create,
}


def payload_numbers(raw: DataFrame, start_ids: dict[str, int] | None = None) -> DataFrame:
    """The payload id of every archive line of a loaded kind.

    Each kind is numbered without gaps in input order, from ``start_ids[kind]``
    (default 1). Only the places of these lines are sorted: no payload moves, and
    lines of other kinds stay where they are.
    """
    first = F.lit(1)
    for event_type, value in (start_ids or {}).items():
        first = F.when(F.col("group") == event_type, F.lit(value)).otherwise(first)
    places = raw.where(F.col("type").isin(*LOADED_KINDS)).select(*LINE, "type")
    return numbered(places, F.col("type"), *LINE).select(
        *LINE, (first + F.col("number")).cast("bigint").alias("payload_id")
    )


def with_payload_ids(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows that name their line, with its payload id; kinds without a table share id 1.

    There are about as many numbers as lines, so they are never broadcast, however well
    their files compress.
    """
    found = numbers.select(*(F.col(c).alias(f"of_{c}") for c in LINE), "payload_id")
    same = F.lit(True)
    for c in LINE:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    payload_id = F.coalesce("payload_id", F.lit(SHARED_PAYLOAD_ID).cast("bigint"))
    return rows.join(found.hint("merge"), same, "left").select(*rows.columns, payload_id.alias("payload_id"))


def next_payload_ids(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Per loaded kind, the first payload id that its stored table leaves free."""
    stored = {kind: tables[name] for kind, name in KIND_TABLES.items() if name in tables}
    if not stored:
        return {}
    last = (
        df.agg(F.max("payload_id").alias("last")).select(F.lit(kind).alias("kind"), "last")
        for kind, df in stored.items()
    )
    return {row.kind: (row.last or 0) + 1 for row in reduce(DataFrame.union, last).collect()}


def payload_keys(raw: DataFrame, start_ids: dict[str, int] | None = None) -> DataFrame:
    """The payload id of every archive line."""
    keys = with_payload_ids(raw.select(*LINE, "id", "type"), payload_numbers(raw, start_ids))
    return keys.select(
        *LINE, gh_event_id(), F.coalesce("type", F.lit("")).alias("event_type"), "payload_id"
    )
