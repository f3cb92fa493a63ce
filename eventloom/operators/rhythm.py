"""How an actor's events spread over the hours of the week, by an aggregate of its own in Arrow."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOURS = 24 * 7


@F.arrow_udf(DoubleType())
def entropy(counts: pa.Array) -> float:
    """Entropy in bits of a group's counts; 0 for a single one."""
    n = counts.to_numpy(zero_copy_only=False).astype(float)
    share = n[n > 0] / n.sum()
    return float(-(share * np.log2(share)).sum()) + 0.0


def rhythms(events: DataFrame) -> DataFrame:
    """actor_id, events, hours (distinct ones of the week) and entropy of their profile in bits.

    Events are counted per actor and hour of the week first, on the map side too; the Arrow
    aggregate then gets at most HOURS numbers for an actor, however many events it has.
    """
    hour = ((F.weekday("created_at") * 24) + F.hour("created_at")).alias("hour")
    known = events.where("actor_id is not null and created_at is not null")
    profile = known.groupBy("actor_id", hour).agg(F.count("*").alias("n"))
    by_actor = profile.groupBy("actor_id")
    totals = by_actor.agg(F.sum("n").alias("events"), F.count("*").alias("hours"))
    return totals.join(by_actor.agg(entropy("n").alias("entropy")), "actor_id")
