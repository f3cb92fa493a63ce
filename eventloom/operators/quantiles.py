"""Exact quantiles by refining histograms, without a sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.cells import micros, with_previous
from eventloom.functions.scratch import staged

#: Bits of a value that one pass settles: a histogram has at most 2 to this power buckets.
BITS = 16


def exact_quantiles(rows: DataFrame, group: str, value: str, shares: tuple[float, ...], bits: int = BITS) -> DataFrame:
    """``group``, share and ``value``: the least value that so many of its group's values do not exceed.

    Values are non-negative longs; nulls do not count, and a group of nulls only gives no
    row. A first pass finds how many bits the values have. Each further pass counts
    values by their next ``bits`` bits among those that agree with what earlier passes
    found, so it shuffles counted buckets, combined on the map side, and never values.
    """
    known = staged(rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("long").alias("v")), "values")
    size = known.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("most"))
    size = staged(size, "sizes")
    width = int(size.agg(F.max("most")).first()[0] or 0).bit_length()
    wanted = F.explode(F.array(*(F.struct(F.lit(s).alias("share"), F.lit(str(s)).alias("name")) for s in shares)))
    # as many rows as groups times shares; the rank is of the values that are still possible
    found = size.select("g", "n", wanted.alias("w")).select(
        "g", F.col("w.share").alias("share"), F.greatest(F.ceil(F.col("w.share") * F.col("n")), F.lit(1)).alias("rank"),
        F.lit(0).cast("long").alias("prefix"),
    )
    for low in reversed(range(0, max(width, 1), bits)):
        prefix = F.shiftright("v", min(low + bits, 63)).alias("prefix")
        bucket = F.shiftright("v", low).alias("bucket")
        asked = staged(found, "asked")
        possible = known.select("g", prefix, bucket).join(asked.select("g", "prefix").distinct(), ["g", "prefix"])
        counts = possible.groupBy("g", "prefix", "bucket").agg(F.count("*").alias("n"))
        so_far = Window.partitionBy("g", "prefix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        summed = counts.withColumn("upto", F.sum("n").over(so_far))
        hit = (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
        found = summed.join(asked, ["g", "prefix"]).where(hit).select(
            "g", "share", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("bucket").alias("prefix")
        )
    return found.select(F.col("g").alias(group), "share", F.col("prefix").alias(value))


def pauses(events: DataFrame, key: str = "repo_id") -> DataFrame:
    """event_type and pause: seconds from the event of the same ``key`` before, null for the first."""
    seen = with_previous(events.select(key, "event_type", "created_at"), [key], "created_at", "before")
    pause: Column = F.floor((micros(F.col("created_at")) - micros(F.col("before"))) / 1_000_000)
    return seen.select("event_type", pause.alias("pause"))


def pause_quantiles(events: DataFrame, shares: tuple[float, ...] = (0.1, 0.5, 0.9, 0.99), key: str = "repo_id") -> DataFrame:
    """Exact quantiles of the pauses before events, per event type."""
    return exact_quantiles(pauses(events, key), "event_type", "pause", shares)
