"""The event fact rows: projection, duplicates, validation, ingest counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventloom.functions.counting import one_row, row_counts
from eventloom.functions.joins import unknown_ids
from eventloom.functions.text import as_id, clipped
from eventloom.functions.time_windows import dates_in, day, moment, ntz
from eventloom.operators.payloads import LINE, line_columns

EVENT_KEY = ["gh_event_id", "created_at_date"]
FALSE_TEXTS = ("false", "0", "")
#: A full date of a year from 1 on, and optionally a time, its fraction and its offset.
WRITTEN_TIME = r"^(?!0000)\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def usable_lines(raw: DataFrame, as_of=None) -> DataFrame:
    """Fact rows of the lines that have an actor, a repository and a time.

    A line without a time gets the reference time, by default the archive hour, so that
    a load that runs again on another day stores the same rows. A line whose time is
    null, less than a full date, or before year 1 has none. The written time is taken
    as it stands, without shifting its zone.
    """
    given = F.col("archive_hour") if as_of is None else ntz(moment(as_of))
    now = F.date_format(given, "yyyy-MM-dd'T'HH:mm:ss")
    created_at = F.when(F.col("created_at").isNull() & ~F.col("null_time"), now).otherwise(F.col("created_at"))
    time = F.when(created_at.rlike(WRITTEN_TIME), created_at.try_cast("timestamp_ntz"))
    rows = raw.select(
        *line_columns(),
        clipped("type", 50).alias("event_type"),
        F.when(F.coalesce("public", F.lit("")).isin(*FALSE_TEXTS), 0).otherwise(1).alias("public"),
        time.alias("created_at"),
        F.to_date(time).alias("created_at_date"),
        as_id("actor.id").alias("actor_id"),
        as_id("repo.id").alias("repo_id"),
        as_id("org.id").alias("org_id"),
        clipped("actor.login", 100).alias("actor_login"),
        clipped("repo.name", 255).alias("repo_name"),
    )
    return rows.where("actor_id is not null and repo_id is not null and created_at is not null")


def check_ids(rows: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Rows of known actors and repositories, with unknown organizations set to NULL.

    ``dimensions`` maps key columns to tables; a key that is not given is not
    checked.
    """
    columns = rows.columns
    for key, unknown in unknown_ids(rows, dimensions).items():
        if key == "org_id":
            marked = unknown.withColumn("unknown", F.lit(True))
            known_org = F.when(F.col("unknown").isNull(), F.col(key))
            rows = rows.join(marked, key, "left").withColumn(key, known_org)
        else:
            rows = rows.join(unknown, key, "left_anti")
    return rows.select(*columns)


def project_events(
    raw: DataFrame,
    actors: DataFrame | None = None,
    repos: DataFrame | None = None,
    orgs: DataFrame | None = None,
    as_of=None,
) -> DataFrame:
    """Archive lines as fact rows, checked against the dimensions that are given."""
    given = {"actor_id": actors, "repo_id": repos, "org_id": orgs}
    dimensions = {key: table for key, table in given.items() if table is not None}
    rows = usable_lines(raw, as_of)
    return check_ids(rows, dimensions) if dimensions else rows


def first_copies(batch: DataFrame) -> DataFrame:
    """The first row per event key in input order.

    The row-number filter is also applied on the map side, so copies of one
    event are dropped before the shuffle.
    """
    by_input = Window.partitionBy(*EVENT_KEY).orderBy(*LINE)
    return batch.withColumn("copy", F.row_number().over(by_input)).where("copy = 1").drop("copy")


def not_stored(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The first copies of events that are not stored.

    They are dealt by their key already; the stored keys join them there and are never broadcast.
    """
    return first_copies(batch).join(stored.select(*EVENT_KEY).hint("merge"), EVENT_KEY, "left_anti")


def dedupe_events(batch: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Batch rows that are neither copies within the batch nor stored already.

    Only the stored dates that occur in the batch are read.
    """
    if stored is None:
        return first_copies(batch)
    dates = sorted(dates_in(batch, "created_at_date"))
    return not_stored(batch, stored.where(F.col("created_at_date").isin(*map(day, dates))))


def validate_events(
    events: DataFrame, actors: DataFrame, repos: DataFrame, orgs: DataFrame
) -> DataFrame:
    """Events with ``is_valid`` and ``error_msg``; the first failing check wins."""
    checked, message = events, F.lit("")
    unknown = unknown_ids(events, {"org_id": orgs, "repo_id": repos, "actor_id": actors})
    for key, ids in unknown.items():
        mark = f"unknown_{key}"
        checked = checked.join(ids.withColumn(mark, F.lit(True)), key, "left")
        missing = F.col(key).isNull() if key != "org_id" else F.lit(False)
        text = F.concat(F.lit(f"Invalid {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        message = F.when(missing | F.col(mark).isNotNull(), text).otherwise(message)
    return checked.select(
        *events.columns,
        F.when(message == "", 1).otherwise(0).alias("is_valid"),
        message.alias("error_msg"),
    )


def ingest_metrics(
    lines: DataFrame, projected: DataFrame, events: DataFrame, actors: DataFrame, repos: DataFrame
) -> DataFrame:
    """One row of ingest counts.

    ``lines`` are the parsed lines with the malformed ones, ``projected`` the
    rows that passed the checks, ``events`` those left without copies, and
    ``actors`` and ``repos`` the new dimension rows. A line is skipped when it
    parses but fails the checks; a copy is neither inserted nor skipped.
    """
    read = lines.agg(F.count("*").alias("lines_read"), F.count_if("malformed").alias("lines_malformed"))
    frames = {
        "projected": projected,
        "events_inserted": events,
        "actors_inserted": actors,
        "repos_inserted": repos,
    }
    return read.crossJoin(one_row(row_counts(frames), frames)).select(  # one row each
        "lines_read",
        "lines_malformed",
        "events_inserted",
        "actors_inserted",
        "repos_inserted",
        (F.col("lines_read") - F.col("lines_malformed") - F.col("projected")).alias("skipped"),
    )
