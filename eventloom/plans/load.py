"""Landing archive lines in stored tables, for a directory of hours and as a stream.

Every load is a batch with a number. It writes only folders that carry its number,
by overwriting them, so a load can be repeated: it finds what the other batches
stored and puts back its own rows. Entities and payloads are written at the same time,
and before events.
Tables are read from their folders, so the plan of a load does not grow with the
number of loads before it. Load batches in the order of their numbers.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.functions.scratch import at_once, staged
from eventloom.operators.payloads import PAYLOADS, next_payload_ids
from eventloom.plans.ingest import ingest
from eventloom.plans.tables import completed
from eventloom.schemas import TABLES
from eventloom.sources.archive import HOURS, hour_report, load_hours, number_lines, parse_lines
from eventloom.streaming.archive_stream import freeing, start
from eventloom.streaming.store import BATCH, BatchTable

ENTITIES = ("actors", "repos", "organizations")
LOADED = (*ENTITIES, *PAYLOADS, "events")
#: After each load, the first payload id of each kind that is free.
FREE_IDS = "free_payload_ids"


def stored_tables(spark: SparkSession, root: str) -> dict[str, BatchTable]:
    """The tables that loads write, below ``root``; made when they do not exist."""
    parts = {"events": ("created_at_date",)}
    tables = {
        name: BatchTable(spark, f"{root}/{name}", TABLES[name], parts.get(name, ())).create()
        for name in LOADED
    }
    tables[FREE_IDS] = BatchTable(spark, f"{root}/{FREE_IDS}", "kind string, next_id bigint").create()
    return tables


def free_payload_ids(tables: dict[str, BatchTable], batch_id: int) -> dict[str, int]:
    """The first free payload id of each kind before a load, from a few rows per load.

    Stored payloads are looked through only where no load has noted its ids.
    """
    noted = tables[FREE_IDS].read().where(F.col(BATCH) < batch_id)
    found = {row.kind: row.next_id for row in noted.groupBy("kind").agg(F.max("next_id").alias("next_id")).collect()}
    return found or next_payload_ids({name: tables[name].read().where(F.col(BATCH) < batch_id) for name in PAYLOADS})


def note_payload_ids(tables: dict[str, BatchTable], before: dict[str, int], batch_id: int) -> None:
    """Store what ``before`` has become by a load, from the rows of that load alone."""
    own = next_payload_ids({name: tables[name].read().where(F.col(BATCH) == batch_id) for name in PAYLOADS})
    free = [(kind, max(next_id, before.get(kind, 1))) for kind, next_id in own.items()]
    spark = tables[FREE_IDS].spark
    tables[FREE_IDS].write(spark.createDataFrame(free, "kind string, next_id bigint").coalesce(1), batch_id)


def load_batch(tables: dict[str, BatchTable], lines: DataFrame, batch_id: int, as_of=None) -> None:
    """Add what staged, parsed lines bring to every table.

    An event of an actor or repository that is new in these lines is kept.
    """
    others = {name: tables[name].read().where(F.col(BATCH) != batch_id).drop(BATCH) for name in LOADED}
    free = free_payload_ids(tables, batch_id)
    new = ingest(lines, others, free, as_of)

    def write(name: str) -> None:
        tables[name].write(completed(new[name], name), batch_id)

    _, failed = at_once(lines.sparkSession, {name: partial(write, name) for name in LOADED if name != "events"})
    for error in failed.values():
        raise error
    write("events")
    note_payload_ids(tables, free, batch_id)


def load_archive(
    spark: SparkSession, root: str, tables: dict[str, BatchTable], days, batch_id: int, hours=HOURS, as_of=None
) -> DataFrame:
    """Load the hours of some days as one batch; returns what became of every hour."""
    lines, damaged = load_hours(spark, root, days, hours)
    load_batch(tables, lines, batch_id, as_of)
    return hour_report(lines, damaged, days, hours)


def stream_load(
    lines: DataFrame, tables: dict[str, BatchTable], progress: str, as_of=None, **trigger
) -> StreamingQuery:
    """Load every micro-batch of a line stream as a batch of its own."""
    spark = lines.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = staged(parse_lines(number_lines(batch).hint("rebalance")), "lines")
        load_batch(tables, parsed, batch_id, as_of)

    return start(lines.writeStream.foreachBatch(freeing(spark, handle)), progress, trigger)
