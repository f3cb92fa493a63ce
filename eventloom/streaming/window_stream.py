"""Counts of tumbling and sliding windows with a watermark, and what came too late for them.

The watermark of a batch is the latest event of all batches before it, less a delay. A
window that ends at or before it is closed: its count was passed on, once, and events
that still come for it go to a side table, window by window. Counts of open windows are
increments per batch; those of days that are all closed are deleted. Everything that a
batch does follows from its number and the tables of the batches before, so a batch that
runs again does the same, and a hot window is added up on the map side.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.functions.scratch import staged
from eventloom.functions.time_windows import dates_in, ntz
from eventloom.schemas import EVENTS
from eventloom.sinks.tables import clear_dates
from eventloom.streaming.archive_stream import freeing, start
from eventloom.streaming.store import BATCH, BatchTable

WINDOW = "window_start timestamp_ntz, window_end timestamp_ntz"
COUNT = f"{WINDOW}, event_type string, events bigint"


@dataclass(frozen=True)
class WindowTables:
    """``clock`` has the latest event of each batch, ``open`` increments by the day a window ends."""

    clock: BatchTable
    open: BatchTable
    closed: BatchTable
    late: BatchTable

    def watermark(self, batch_id: int, delay: timedelta) -> datetime | None:
        """Of all batches before ``batch_id``; None before the first."""
        latest = self.clock.read().where(F.col(BATCH) < batch_id).agg(F.max("latest")).first()[0]
        return latest - delay if latest is not None else None


def window_tables(spark: SparkSession, root: str) -> WindowTables:
    return WindowTables(
        BatchTable(spark, f"{root}/clock", "latest timestamp_ntz").create(),
        BatchTable(spark, f"{root}/open", f"{COUNT}, end_date date", ("end_date",)).create(),
        BatchTable(spark, f"{root}/closed", COUNT).create(),
        BatchTable(spark, f"{root}/late", f"{WINDOW}, {EVENTS}").create(),
    )


def placed(events: DataFrame, width_minutes: int, slide_minutes: int) -> DataFrame:
    """Every event once for each window that holds it."""
    known = events.where("created_at is not null").withColumn(
        "window", F.window("created_at", f"{width_minutes} minutes", f"{slide_minutes} minutes")
    )
    return known.select("*", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")).drop("window")


def ended(watermark: datetime | None) -> Column:
    return F.lit(False) if watermark is None else F.col("window_end") <= ntz(watermark)


def totals(increments: DataFrame) -> DataFrame:
    return increments.groupBy("window_start", "window_end", "event_type").agg(F.sum("events").alias("events"))


def window_counts(events: DataFrame, width_minutes: int = 60, slide_minutes: int = 60) -> DataFrame:
    """The exact counts, in batch: window_start, window_end, event_type, events."""
    return totals(placed(events, width_minutes, slide_minutes).withColumn("events", F.lit(1)))


def stream_windows(
    events: DataFrame, tables: WindowTables, progress: str,
    width_minutes: int = 60, slide_minutes: int = 60, delay_minutes: int = 120, **trigger,
) -> StreamingQuery:
    """Count the events of each window and type; windows may overlap.

    Closed windows never change; their counts and the late rows add up to the batch counts.
    """
    delay = timedelta(minutes=delay_minutes)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = staged(batch.select(*(f.split()[0] for f in EVENTS.replace("\n", " ").split(","))), "rows")
        before = tables.watermark(batch_id, delay)
        each = placed(rows, width_minutes, slide_minutes)
        counts = totals(each.where(~ended(before)).withColumn("events", F.lit(1)))
        tables.open.write(counts.withColumn("end_date", F.to_date("window_end")), batch_id)
        tables.late.write(each.where(ended(before)), batch_id)
        tables.clock.write(rows.agg(F.max("created_at").alias("latest")).where("latest is not null"), batch_id)
        after = tables.watermark(batch_id + 1, delay)
        if after is None:
            return
        increments = tables.open.read().where(F.col(BATCH) <= batch_id)
        if before is not None:  # windows up to there were passed on by the batches before
            increments = increments.where((F.col("end_date") >= F.to_date(ntz(before))) & ~ended(before))
        tables.closed.write(totals(increments.where((F.col("end_date") <= F.to_date(ntz(after))) & ended(after))), batch_id)
        if before is not None:
            stale = tables.open.read().where(F.col("end_date") < F.to_date(ntz(before)))
            clear_dates(rows.sparkSession, tables.open.path, "end_date", dates_in(stale, "end_date"))

    return start(events.writeStream.foreachBatch(freeing(events.sparkSession, handle)), progress, trigger)


def open_windows(tables: WindowTables, delay_minutes: int = 120) -> DataFrame:
    """Counts so far of the windows that are still open."""
    watermark = tables.watermark(1 << 62, timedelta(minutes=delay_minutes))
    return totals(tables.open.read().where(~ended(watermark)))


def late_counts(tables: WindowTables) -> DataFrame:
    """Events that came too late, by window and type."""
    return totals(tables.late.rows().withColumn("events", F.lit(1)))
