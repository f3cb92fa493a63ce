"""Hour files as a stream of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventloom.functions.scratch import staged, staging_freed
from eventloom.functions.time_windows import dates_in
from eventloom.operators.events import check_ids, not_stored, usable_lines, validate_events
from eventloom.schemas import EVENTS
from eventloom.sources.archive import ARCHIVE_FILES, number_lines, parse_lines, well_formed, with_hour
from eventloom.streaming.store import BATCH, BatchTable

INVALID_ROWS = f"{EVENTS}, error_msg string"

AfterInsert = Callable[[DataFrame, int], None]


def line_stream(spark: SparkSession, root: str, max_files: int = 1) -> DataFrame:
    """Lines of the hour files as they arrive, ``max_files`` per micro-batch."""
    files = spark.readStream.option("pathGlobFilter", ARCHIVE_FILES)
    return with_hour(files.option("maxFilesPerTrigger", max_files).text(root))


def event_store(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, EVENTS, ("created_at_date",)).create()


def batch_rows(batch: DataFrame, as_of=None) -> DataFrame:
    """The usable fact rows of a micro-batch of lines, parsed once and staged."""
    lines = number_lines(batch).hint("rebalance")  # one task has read a whole hour
    return staged(usable_lines(well_formed(parse_lines(lines)), as_of), "batch")


def freeing(spark: SparkSession, handle: AfterInsert) -> AfterInsert:
    """``handle`` for ``foreachBatch``; what it stages is freed after each batch."""

    def handled(batch: DataFrame, batch_id: int) -> None:
        with staging_freed(spark):
            handle(batch, batch_id)

    return handled


def start(writer: DataStreamWriter, progress: str, trigger: dict) -> StreamingQuery:
    """Start a stream; by default it stops once all present files are done."""
    trigger = trigger or {"availableNow": True}
    return writer.option("checkpointLocation", progress).trigger(**trigger).start()


def stream_ingest(
    lines: DataFrame,
    store: BatchTable,
    progress: str,
    dimensions: dict[str, DataFrame] | None = None,
    after_insert: tuple[AfterInsert, ...] = (),
    as_of=None,
    **trigger,
) -> StreamingQuery:
    """Add the new events of every micro-batch to ``store``.

    Events that an earlier batch stored are left out, exactly; the comparison
    reads only the dates that the batch touches. ``dimensions`` maps key columns
    to the tables they must exist in. Each ``after_insert`` step gets the
    inserted rows and the batch id.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch_rows(batch, as_of)
        dates = dates_in(rows, "created_at_date")
        if not dates:
            return
        checked = check_ids(rows, dimensions) if dimensions else rows
        earlier = store.on_dates(dates).where(F.col(BATCH) < batch_id)
        inserted = not_stored(checked, earlier)
        if after_insert:
            inserted = staged(inserted, "inserted")
        store.write(inserted, batch_id)
        for step in after_insert:
            step(inserted, batch_id)

    return start(lines.writeStream.foreachBatch(freeing(store.spark, handle)), progress, trigger)


def stream_dedupe(
    lines: DataFrame, store: BatchTable, progress: str, as_of=None, **trigger
) -> StreamingQuery:
    """Keep the first copy of every event, by id and date, as the batch form does.

    No row is lost for being late: copies are looked up among the stored events of
    the dates that a batch touches, not in state that expires. Within a batch,
    copies are dropped on the map side, before any shuffle.
    """
    return stream_ingest(lines, store, progress, as_of=as_of, **trigger)


def stream_validate(
    lines: DataFrame,
    valid: BatchTable,
    quarantine: BatchTable,
    progress: str,
    actors: DataFrame,
    repos: DataFrame,
    orgs: DataFrame,
    as_of=None,
    **trigger,
) -> StreamingQuery:
    """Send events with unknown ids to ``quarantine`` and the others to ``valid``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = staged(validate_events(batch_rows(batch, as_of), actors, repos, orgs), "checked")
        valid.write(checked.where("is_valid = 1"), batch_id)
        quarantine.write(checked.where("is_valid = 0"), batch_id)

    return start(lines.writeStream.foreachBatch(freeing(valid.spark, handle)), progress, trigger)


def quarantine_store(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, INVALID_ROWS).create()
