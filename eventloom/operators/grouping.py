"""Statistics of all grouping sets of date and event type, from one scan of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.scratch import staged

COUNTED = {"actor": "actor_id", "repo": "repo_id", "org": "org_id"}
SETS = (("stats_date", "event_type"), ("stats_date",), ("event_type",), ())
MEASURES = ("total_count", *(f"unique_{name}s" for name in COUNTED))


def counted_ids(events: DataFrame) -> DataFrame:
    """stats_date, event_type, kind, id, n: how often each id occurs; kind '' counts the events.

    Every event gives one row of each kind, but they are added up on the map side before
    the one shuffle, so the facts are scanned once and a hot id is a row per task.
    """
    ids = [F.struct(F.lit("").alias("kind"), F.lit(None).cast("long").alias("id"))]
    ids += [F.struct(F.lit(name).alias("kind"), F.col(column).cast("long").alias("id")) for name, column in COUNTED.items()]
    each = events.select(F.col("created_at_date").alias("stats_date"), "event_type", F.explode(F.array(*ids)).alias("who"))
    each = each.select("stats_date", "event_type", "who.kind", "who.id").where("kind = '' or id is not null")
    return each.groupBy("stats_date", "event_type", "kind", "id").agg(F.count("*").alias("n"))


def measured(counted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The measures of one grouping set of ``counted_ids``."""
    total = F.sum(F.when(F.col("kind") == "", F.col("n")).otherwise(0)).alias("total_count")
    unique = [F.count_if(F.col("kind") == name).alias(f"unique_{name}s") for name in COUNTED]
    distinct = counted.groupBy(*keys, "kind", "id").agg(F.sum("n").alias("n"))
    return distinct.groupBy(*keys).agg(total, *unique)


def grouping_sets(events: DataFrame, sets: tuple[tuple[str, ...], ...] = SETS) -> DataFrame:
    """stats_date, event_type, level and the measures, for each of ``sets``; what a set leaves out is null.

    ``level`` tells a left-out column from a null one, as GROUPING_ID does: 1 for a left-out
    event_type, 2 for a left-out stats_date, 3 for both. Distinct counts are exact: ids are
    counted anew for each set, from the counted ids, not the events. The set of neither is
    one row only if there are events.
    """
    counted = staged(counted_ids(events), "counted-ids")
    result = None
    for keys in sets:
        level = sum(bit for bit, column in ((2, "stats_date"), (1, "event_type")) if column not in keys)
        absent = {"stats_date": "date", "event_type": "string"}
        columns = [F.col(c) if c in keys else F.lit(None).cast(kind).alias(c) for c, kind in absent.items()]
        part = measured(counted, keys).where("total_count > 0").select(*columns, F.lit(level).alias("level"), *MEASURES)
        result = part if result is None else result.union(part)
    return result
