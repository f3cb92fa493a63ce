"""Writing, replacing and ageing out tables of Parquet files."""

from __future__ import annotations

import uuid
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.counting import one_row, row_counts
from eventloom.functions.scratch import delete_folders, staged
from eventloom.functions.text import iso_datetimes
from eventloom.functions.time_windows import date_text, dates_in, day, moment, ntz


def write_events(events: DataFrame, path: str) -> None:
    """Append events, one folder per date.

    The rebalance gathers each date into few files and splits a date that is
    too large for one task. Within a file, events lie by repository, so that a
    look-up of one repository skips most row groups.
    """
    spread = events.hint("rebalance", "created_at_date")
    ordered = spread.sortWithinPartitions("created_at_date", "repo_id")
    ordered.write.mode("append").partitionBy("created_at_date").parquet(path)


def replace_table(df: DataFrame, root: str) -> str:
    """Write a full refresh beside earlier versions and return its path.

    Readers of an earlier version are not disturbed, and ``df`` may read one;
    the caller switches to the new path once the write is complete.
    """
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def clear_dates(spark: SparkSession, path: str, date_column: str, dates) -> None:
    """Delete the folders of some dates, one call to the file system for each and no job."""
    delete_folders(spark, (f"{path}/{date_column}={date_text(d)}" for d in sorted(dates)))


def replace_dates(
    rows: DataFrame, path: str, dates=None, since: date | None = None, date_column: str = "stats_date"
) -> None:
    """Replace some dates, or all from ``since`` on, of a date-partitioned table.

    Dynamic overwrite replaces the dates that have new rows. It leaves the
    others alone, so dates that have become empty are cleared afterwards.
    """
    column = F.col(date_column)
    replaced = column >= day(since) if dates is None else column.isin(*(day(d) for d in dates))
    new = staged(rows.where(replaced), "dates")
    (
        new.hint("rebalance", date_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    emptied = dates_in(table.where(replaced), date_column) - dates_in(new, date_column)
    clear_dates(rows.sparkSession, path, date_column, emptied)


RETAINED = {
    "events": "created_at_date",
    "event_stats_daily": "stats_date",
    "user_repo_relation": "last_event_at",
}


def cutoff_date(days: int, as_of=None) -> date:
    return moment(as_of).date() - timedelta(days=days)


def expired(column: str, days: int, as_of=None) -> Column:
    """Whether a retention of ``days`` deletes a row; a NULL time is kept."""
    cutoff = cutoff_date(days, as_of)
    first = ntz(datetime.combine(cutoff, time())) if column == "last_event_at" else day(cutoff)
    return F.col(column) < first


def retain(tables: dict[str, DataFrame], days: int, as_of=None) -> dict[str, DataFrame]:
    """The rows that a retention of ``days`` keeps."""
    kept = {}
    for name, column in RETAINED.items():
        gone = expired(column, days, as_of)
        kept[name] = tables[name].where(~gone | F.col(column).isNull())
    return kept


def retention_counts(tables: dict[str, DataFrame], days: int, as_of=None) -> DataFrame:
    """One row: how many rows of each table a retention of ``days`` deletes.

    Only those rows are read; on a table stored by date, only their folders.
    """
    labels = {
        "events": "deleted_events",
        "event_stats_daily": "deleted_stats",
        "user_repo_relation": "deleted_relations",
    }
    frames = {
        label: tables[name].where(expired(RETAINED[name], days, as_of)) for name, label in labels.items()
    }
    return one_row(row_counts(frames), frames)


def expire_relations(spark: SparkSession, path: str, root: str, days: int, as_of=None) -> str:
    """Write the relations at ``path`` that a retention keeps as a new version below ``root``."""
    stored = spark.read.parquet(path)
    column = RETAINED["user_repo_relation"]
    return replace_table(stored.where(~expired(column, days, as_of) | F.col(column).isNull()), root)


def expire_dates(spark: SparkSession, path: str, date_column: str, days: int, as_of=None) -> None:
    """Age out whole date folders of a stored table without rewriting the rest."""
    table = spark.read.schema(f"{date_column} date").parquet(path)  # folders may all be gone
    old = table.where(F.col(date_column) < day(cutoff_date(days, as_of)))
    clear_dates(spark, path, date_column, dates_in(old, date_column))


def export_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header; quotes inside values are doubled."""
    options = {"header": True, "escape": '"', "emptyValue": ""}
    iso_datetimes(df).write.options(**options).csv(path)
