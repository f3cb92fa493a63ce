"""The full statistics refresh."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.joins import keep_known
from eventloom.functions.scratch import staged, staged_all
from eventloom.functions.time_windows import CALENDAR, day, moment, ntz, window_start
from eventloom.operators.base_stats import (
    add_to_actors,
    add_to_repos,
    merge_relations,
    relations_of,
)
from eventloom.operators.browse import stats_summary
from eventloom.operators.daily_stats import daily_stats_recent
from eventloom.operators.entity_stats import (
    activity,
    actor_stats_of,
    coarser,
    relation_type,
    repo_stats_of,
)
from eventloom.operators.leaderboards import active_developers, hot_repos
from eventloom.schemas import TABLES
from eventloom.sinks.tables import replace_table
from eventloom.sinks.versions import point_to

DAILY_DAYS = 30


log = logging.getLogger(__name__)


def update_all(
    state: dict[str, DataFrame], as_of=None, batch: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Leaderboards, caches, daily statistics and the base totals.

    Scores use the totals of the previous run, those in ``state``, which
    holds events, actors and repos, and optionally the stored statistics
    tables. ``batch`` are the events not yet in the totals; without it the
    whole history is added once more.

    Leaderboards and daily statistics read only their window of the facts. All
    history-wide results come from one scan, counted per (actor, repository,
    relation type). A table whose update fails keeps its stored rows, if it has
    any, and the remaining tables are still updated; ``failures`` has its name and
    error.
    """
    now = moment(as_of)
    events, actors, repos = state["events"], state["actors"], state["repos"]
    by_relation = ("actor_id", "repo_id", relation_type())
    counted = staged(activity(events, *by_relation, as_of=now), "activity")
    pairs = staged(coarser(counted, "actor_id", "repo_id"), "pairs")
    added = counted
    if batch is not None:
        added = staged(activity(batch, *by_relation, as_of=now), "batch-activity")

    def stamped(df: DataFrame) -> DataFrame:
        return df.withColumn("updated_at", ntz(now))

    def daily() -> DataFrame:
        fresh = daily_stats_recent(events, DAILY_DAYS, now).withColumn("stats_time", ntz(now))
        if "event_stats_daily" not in state:
            return fresh
        first = window_start(now, DAILY_DAYS, CALENDAR)
        older = state["event_stats_daily"].where(F.col("stats_date") < day(first))
        return fresh.unionByName(older, allowMissingColumns=True)

    def related() -> DataFrame:
        known = keep_known(relations_of(added), {"actor_id": actors, "repo_id": repos})
        return merge_relations(known, state.get("user_repo_relation"))

    results, failed = staged_all(
        events.sparkSession,
        {
            "hot_repos": lambda: stamped(hot_repos(events, repos, now)),
            "active_developers": lambda: stamped(active_developers(events, actors, now)),
            "actor_stats_cache": lambda: stamped(actor_stats_of(pairs, actors)),
            "repo_stats_cache": lambda: stamped(repo_stats_of(pairs, repos)),
            "event_stats_daily": daily,
            "actors": lambda: add_to_actors(actors, coarser(added, "actor_id")),
            "repos": lambda: add_to_repos(repos, coarser(added, "repo_id")),
            "user_repo_relation": related,
        },
    )
    for name, error in failed.items():
        log.error("update of %s failed: %s", name, error)
        if name in state:
            results[name] = state[name]
    results["summary"] = stats_summary(results)
    results["failures"] = events.sparkSession.createDataFrame(
        [(name, str(error).splitlines()[0]) for name, error in sorted(failed.items())], "name string, error string"
    )
    return results


def publish(results: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Store the tables that a refresh updated, each as a new version; returns their paths.

    Once all are written they become current together, and ``versions.current`` finds them
    by name. A table whose update failed is not written, so its stored version stays.
    Readers of earlier versions go on undisturbed; ``versions.clean`` deletes these.
    """
    failed = {row["name"] for row in results["failures"].collect()}
    kept = [name for name in results if name in TABLES and name not in failed]
    paths = {name: replace_table(results[name], f"{root.rstrip('/')}/{name}") for name in kept}
    if paths:
        point_to(results["failures"].sparkSession, root, paths)
    return paths
