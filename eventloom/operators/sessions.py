"""Sessions of actors: runs of events with no pause longer than a gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.cells import micros

GAP_MINUTES = 30
#: A piece of a session; pieces that lie within a gap of each other are one session.
PIECE = "actor_id bigint, session_start timestamp_ntz, session_end timestamp_ntz, events bigint"


def gap(minutes: int) -> Column:
    return F.make_dt_interval(mins=F.lit(minutes))


def pieces(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Pieces of sessions: the events of an actor in one stretch of ``gap_minutes``.

    Such events are never further apart than the gap, so a plain aggregate, combined on
    the map side, leaves a hot actor with a row for each stretch.
    """
    stretch = F.floor(micros(F.col("created_at")) / (gap_minutes * 60_000_000)).alias("stretch")
    known = events.where("actor_id is not null and created_at is not null")
    return (
        known.groupBy("actor_id", stretch)
        .agg(
            F.min("created_at").alias("session_start"),
            F.max("created_at").alias("session_end"),
            F.count("*").alias("events"),
        )
        .drop("stretch")
    )


def joined(parts: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Whole sessions from pieces, which may come in any number and overlap.

    The pieces of an actor are ordered in one task: after ``pieces`` they are as many as
    there are stretches of time, not events.
    """
    by_time = Window.partitionBy("actor_id").orderBy("session_start", "session_end")
    reached = F.max("session_end").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    begins = reached.isNull() | (F.col("session_start") > reached + gap(gap_minutes))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        parts.withColumn("begins", begins.cast("int"))
        .withColumn("session", F.sum("begins").over(so_far))
        .groupBy("actor_id", "session")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events").alias("events"),
        )
        .drop("session")
    )


def actor_sessions(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """actor_id, session_start, session_end (times of the first and last event) and events.

    An event exactly a gap after the one before still belongs to its session. Events
    without actor or time are left out.
    """
    return joined(pieces(events, gap_minutes), gap_minutes)
