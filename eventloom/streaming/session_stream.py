"""Sessions of a stream of events, open ones in the state store.

The state is the pieces of sessions that may still grow. A call of the state store takes
as long for one actor as for thousands, so actors are kept in cells, by a hash of their id,
and the pieces of a cell are one value, handled as whole columns. A piece is passed on when
the watermark has gone a gap beyond it, by an event-time timer of its cell. An event
that comes later than that opens a piece of its own, which is passed on at once; reading
joins pieces, so a late event reopens its session, or makes two of them one, and no
event is lost however late it is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from eventloom.functions.cells import micros
from eventloom.operators.sessions import GAP_MINUTES, PIECE, joined
from eventloom.streaming.archive_stream import start

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE = 60_000_000
MICROS = "actor_id bigint, first bigint, last bigint, n bigint"
COLUMNS = ["actor_id", "first", "last", "n"]
#: The cells of actors in the state. A stream that goes on needs the number it began with.
CELLS = 1024
#: The events that a task joins to pieces at once.
JOINED_ROWS = 500_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, path: str, schema: str, max_files: int = 1) -> DataFrame:
    """Events of a stored table as their files arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def joined_pieces(rows: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Pieces of ``actor_id``, ``first``, ``last`` (microseconds) and ``n``, joined where they lie within ``gap``."""
    rows = rows.sort_values(["actor_id", "first", "last"], ignore_index=True)
    reached = rows.groupby("actor_id")["last"].cummax().shift()
    begins = (rows["actor_id"] != rows["actor_id"].shift()) | (rows["first"] > reached + gap)
    at = np.flatnonzero(begins)
    return pd.DataFrame(
        {
            "actor_id": rows["actor_id"].to_numpy()[at],
            "first": rows["first"].to_numpy()[at],
            "last": np.maximum.reduceat(rows["last"].to_numpy(), at),
            "n": np.add.reduceat(rows["n"].to_numpy(), at),
        }
    )


def combiner(gap: int):
    """Pieces of the events of a task, so that a hot actor sends a few rows from each."""

    def combine(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            held.append(pd.DataFrame({"actor_id": batch["actor_id"], "first": batch["at"], "last": batch["at"], "n": 1}))
            rows += len(batch)
            if rows >= JOINED_ROWS:
                yield joined_pieces(pd.concat(held), gap)
                held, rows = [], 0
        if rows:
            yield joined_pieces(pd.concat(held), gap)

    return combine


class OpenSessions(StatefulProcessor):
    """The open pieces of one cell of actors."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "pieces binary")

    def pass_on(self, held: pd.DataFrame, timers) -> Iterator[pd.DataFrame]:
        """Passes on what the watermark has closed, keeps the rest, and sets one timer for it."""
        watermark = timers.getCurrentWatermarkInMs() * 1000
        closed = held["last"] + self.gap < watermark
        kept = held[~closed]
        if len(kept):
            self.open.update((kept[COLUMNS].to_numpy(np.int64).tobytes(),))
        else:
            self.open.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(kept):
            next_close = int(kept["last"].min()) + self.gap
            self.handle.registerTimer(max(next_close // 1000 + 1, watermark // 1000 + 1))
        if closed.any():
            yield held.loc[closed, COLUMNS]

    def held(self) -> pd.DataFrame:
        stored = bytes(self.open.get()[0]) if self.open.exists() else b""
        return pd.DataFrame(np.frombuffer(stored, np.int64).reshape(-1, len(COLUMNS)), columns=COLUMNS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = (part[COLUMNS].astype(np.int64) for part in rows)
        yield from self.pass_on(joined_pieces(pd.concat((self.held(), *new)), self.gap), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.held()
        if len(held):
            yield from self.pass_on(held, timerValues)

    def close(self) -> None:
        pass


def stream_sessions(
    events: DataFrame, path: str, progress: str, gap_minutes: int = GAP_MINUTES, delay_minutes: int = 120, **trigger
) -> StreamingQuery:
    """Write the closed pieces of sessions to ``path``, once each, whatever fails in between.

    The watermark follows the latest event by ``delay_minutes``. It closes pieces and frees
    state, and drops nothing. Read with ``closed_sessions``.
    """
    spark, gap = events.sparkSession, gap_minutes * MINUTE
    known = events.where("actor_id is not null and created_at is not null").select(
        "actor_id", micros(F.col("created_at")).alias("at"), F.timestamp_micros(micros(F.col("created_at"))).alias("clock")
    )
    combined = known.withWatermark("clock", f"{delay_minutes} minutes").mapInPandas(combiner(gap), MICROS)
    cell = F.pmod(F.xxhash64("actor_id"), F.lit(CELLS)).alias("cell")
    found = combined.select(cell, *COLUMNS).groupBy("cell").transformWithStateInPandas(
        statefulProcessor=OpenSessions(gap), outputStructType=MICROS, outputMode="Append", timeMode="EventTime"
    )
    pieces = found.select(
        "actor_id",
        *(F.expr(f"timestampadd(MICROSECOND, {c}, TIMESTAMP_NTZ'1970-01-01')").alias(name)
          for c, name in (("first", "session_start"), ("last", "session_end"))),
        F.col("n").alias("events"),
    )
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # timers need it; a stream keeps the settings it began with
    try:
        return start(pieces.writeStream.format("parquet").option("path", path).outputMode("append"), progress, trigger)
    finally:
        spark.conf.set(STATE_STORE, before)


def closed_sessions(spark: SparkSession, path: str, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """The sessions that the stream has passed on so far, pieces joined."""
    return joined(spark.read.schema(PIECE).parquet(path), gap_minutes)
