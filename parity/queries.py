"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions.scratch import new_path, staged
from eventloom.functions.text import iso_datetimes
from eventloom.operators import (
    asof,
    base_stats,
    browse,
    daily_stats,
    difference,
    entities,
    entity_stats,
    events as event_rows,
    forks,
    grouping,
    intervals,
    leaderboards,
    moving,
    overview,
    payloads,
    quantiles,
    rhythm,
    sessions,
    sketches,
    upsert,
    views,
)
from eventloom.plans import load
from eventloom.plans.ingest import ingest
from eventloom.plans.nightly import publish, update_all
from eventloom.plans.tables import completed
from eventloom.sinks import tables as sinks, versions
from eventloom.sources import archive
from eventloom.schemas import EVENTS, FORK, PUSH, WATCH
from eventloom.streaming import archive_stream, running_stats, session_stream, window_stream
from parity.adapter import (
    ARRIVALS_PER_BATCH,
    AS_OF,
    CLOSING,
    STREAM_FILES,
    damaged_archive,
    spark_table,
    write_archive,
    write_arrivals,
)

FIRST_DAY, LAST_DAY, ONE_DAY, ONE_HOUR = "2024-01-01", "2024-01-30", "2024-01-15", 6
CUT_OFF_HOUR, ABSENT_HOUR = 6, 12
RETENTION_DAYS = 20
PAGES = 12
_archives: dict[tuple[str, str], str] = {}
_arrivals: dict[tuple[str, str], str] = {}
_loads: dict[tuple[str, str], dict] = {}
_refreshes: dict[tuple[str, str], str] = {}


def archive_of(spark: SparkSession, sf_dir: str) -> str:
    """The hour files of a table folder, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _archives:
        _archives[key] = write_archive(spark, sf_dir)
    return _archives[key]


def arrivals_of(spark: SparkSession, sf_dir: str) -> str:
    """The events as files in the order of their arrival, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _arrivals:
        _arrivals[key] = write_arrivals(spark, sf_dir)
    return _arrivals[key]


class Given:
    """The domain tables of one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return spark_table(self.spark, self.sf_dir, name)

    @property
    def events(self) -> DataFrame:
        return self.gh_events

    @cached_property
    def parsed(self) -> DataFrame:
        """The parsed lines, staged as at the start of every ingest."""
        return staged(archive.parse_lines(self.lines))

    @cached_property
    def raw(self) -> DataFrame:
        return archive.well_formed(self.parsed)

    @cached_property
    def archive(self) -> str:
        return archive_of(self.spark, self.sf_dir)

    def path(self, label: str) -> str:
        return new_path(self.spark, label)

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {"actor_id": self.actors, "repo_id": self.repos, "org_id": self.orgs}

    @property
    def stored(self) -> dict[str, DataFrame]:
        return {
            "actors": self.stored_actors,
            "repos": self.stored_repos,
            "organizations": self.stored_orgs,
        }

    @property
    def hot(self) -> DataFrame:
        return leaderboards.hot_repos(self.events, self.repos, AS_OF)

    @property
    def developers(self) -> DataFrame:
        return leaderboards.active_developers(self.events, self.actors, AS_OF)

    @property
    def repo_cache(self) -> DataFrame:
        return entity_stats.repo_stats(self.events, self.repos, AS_OF)

    @property
    def actor_cache(self) -> DataFrame:
        return entity_stats.actor_stats(self.events, self.actors, AS_OF)

    @property
    def daily(self) -> DataFrame:
        return daily_stats.daily_stats_recent(self.events, 30, AS_OF)

    @property
    def relations(self) -> DataFrame:
        return base_stats.relations(self.events, self.actors, self.repos)

    @property
    def earlier(self) -> DataFrame:
        return self.events.where("created_at_date < DATE'2024-01-16'")

    @property
    def later(self) -> DataFrame:
        return self.events.where("created_at_date >= DATE'2024-01-16'")


Query = Callable[[Given], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__.rstrip("_")] = function
    return function


def as_callable(function: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: function(Given(spark, sf_dir))


# --- sources and ingest ----------------------------------------------------


def flat(raw: DataFrame) -> DataFrame:
    return raw.select(
        "archive_hour",
        "id",
        "type",
        "public",
        F.col("created_at").alias("created_text"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("org.id").alias("org_id"),
        "payload",
    )


@query
def read_archive(t: Given) -> DataFrame:
    return flat(archive.read_archive(t.spark, t.archive))


@query
def ingest_day(t: Given) -> DataFrame:
    return flat(archive.ingest_day(t.spark, t.archive, ONE_DAY))


@query
def ingest_hour(t: Given) -> DataFrame:
    return flat(archive.ingest_hour(t.spark, t.archive, ONE_DAY, ONE_HOUR))


@query
def ingest_range(t: Given) -> DataFrame:
    return flat(archive.ingest_range(t.spark, t.archive, FIRST_DAY, LAST_DAY))


@query
def ingest_report(t: Given) -> DataFrame:
    """A day of which one hour is cut off and another is absent."""
    root = damaged_archive(t.spark, t.archive, ONE_DAY, cut_off=CUT_OFF_HOUR, absent=ABSENT_HOUR)
    return archive.ingest_report(t.spark, root, ONE_DAY, ONE_DAY).select("archive_hour", "state", "lines")


@query
def extract_actors(t: Given) -> DataFrame:
    return entities.extract_actors(t.raw, t.stored_actors)


@query
def extract_repos(t: Given) -> DataFrame:
    return entities.extract_repos(t.raw, t.stored_repos)


@query
def extract_orgs(t: Given) -> DataFrame:
    return entities.extract_orgs(t.raw, t.stored_orgs)


@query
def payload_push(t: Given) -> DataFrame:
    return payloads.payload_push(t.raw)


@query
def payload_star(t: Given) -> DataFrame:
    return payloads.payload_star(t.raw)


@query
def payload_fork(t: Given) -> DataFrame:
    return payloads.payload_fork(t.raw)


@query
def payload_create(t: Given) -> DataFrame:
    return payloads.payload_create(t.raw)


@query
def payload_keys(t: Given) -> DataFrame:
    return payloads.payload_keys(t.raw, {"PushEvent": 1000})


@query
def project_events(t: Given) -> DataFrame:
    return event_rows.project_events(t.raw, t.actors, t.repos, t.stored_orgs, AS_OF)


@query
def dedupe_events(t: Given) -> DataFrame:
    """Half of the month is stored already."""
    return event_rows.dedupe_events(event_rows.project_events(t.raw, as_of=AS_OF), t.earlier)


@query
def ingest_metrics(t: Given) -> DataFrame:
    return ingest(t.parsed, t.stored, as_of=AS_OF)["metrics"]


@query
def ingest_lines(t: Given) -> DataFrame:
    """The event rows that the whole ingest adds from the hour files, payload ids included."""
    lines = archive.stage_lines(t.spark, t.archive, archive.days_between(FIRST_DAY, LAST_DAY))
    return ingest(lines, t.stored, as_of=AS_OF)["events"]


def loaded(t: Given) -> dict:
    """Tables with earlier dimensions, then both halves of the month, loaded one after the other."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _loads:
        tables = load.stored_tables(t.spark, t.path("loaded"))
        for name, rows in t.stored.items():
            tables[name].write(completed(rows, name), 0)
        days = archive.days_between(FIRST_DAY, LAST_DAY)
        for batch_id, half in ((1, days[:15]), (2, days[15:])):
            load.load_archive(t.spark, t.archive, tables, half, batch_id, as_of=AS_OF)
        _loads[key] = tables
    return _loads[key]


EVENT_ROW = ("payload_id", "gh_event_id", "event_type", "public", "created_at", "created_at_date", "actor_id", "repo_id", "org_id", "actor_login", "repo_name")


@query
def load_archive_events(t: Given) -> DataFrame:
    return loaded(t)["events"].read().select(*EVENT_ROW)


@query
def load_archive_actors(t: Given) -> DataFrame:
    return loaded(t)["actors"].read().select("actor_id", "login", "display_login", "url", "avatar_url")


@query
def load_archive_repos(t: Given) -> DataFrame:
    return loaded(t)["repos"].read().select("repo_id", "name", "url")


@query
def load_archive_organizations(t: Given) -> DataFrame:
    return loaded(t)["organizations"].read().select("org_id", "login")


@query
def load_archive_payloads(t: Given) -> DataFrame:
    kinds = {"payload_push": "PushEvent", "payload_star": "WatchEvent", "payload_fork": "ForkEvent", "payload_create": "CreateEvent"}
    parts = (
        loaded(t)[name].read().select(F.lit(kind).alias("event_type"), "payload_id", "gh_event_id")
        for name, kind in kinds.items()
    )
    return reduce(DataFrame.union, parts)


@query
def stream_load(t: Given) -> DataFrame:
    """Event rows after the whole ingest as a stream; events of new actors are kept."""
    tables = load.stored_tables(t.spark, t.path("stream-loaded"))
    for name, rows in t.stored.items():
        tables[name].write(completed(rows, name), -1)
    lines = archive_stream.line_stream(t.spark, t.archive, STREAM_FILES)
    load.stream_load(lines, tables, t.path("progress"), AS_OF).awaitTermination()
    return tables["events"].read().select(*EVENT_ROW)


@query
def validate_events(t: Given) -> DataFrame:
    checked = event_rows.validate_events(t.events, t.stored_actors, t.stored_repos, t.stored_orgs)
    return checked.select("gh_event_id", "is_valid", "error_msg")


# --- sinks and maintenance ---------------------------------------------------


@query
def append_events(t: Given) -> DataFrame:
    path = t.path("events")
    sinks.write_events(t.earlier, path)
    sinks.write_events(t.later, path)
    return t.spark.read.schema(t.events.schema).parquet(path)


@query
def upsert_table(t: Given) -> DataFrame:
    keys = ["actor_id", "repo_id", "relation_type"]
    policy = {
        "relation_time": upsert.KEEP,
        "first_event_at": upsert.GREATEST,
        "last_event_at": upsert.REPLACE,
        "event_count": upsert.ADD,
    }
    prior, new = base_stats.batch_relations(t.earlier), base_stats.batch_relations(t.later)
    return upsert.upsert(prior, new, keys, policy)


@query
def replace_table(t: Given) -> DataFrame:
    """Refresh the relations of half a month by those of the whole month."""
    root = t.path("relations")
    sinks.replace_table(base_stats.batch_relations(t.earlier), root)
    path = sinks.replace_table(base_stats.batch_relations(t.events), root)
    return t.spark.read.parquet(path)


@query
def replace_dates(t: Given) -> DataFrame:
    """Recompute ten dates after the events of two of them are gone."""
    path = t.path("daily")
    full = daily_stats.count_by_day(t.events)
    dates = [date(2024, 1, d) for d in range(10, 20)]
    sinks.replace_dates(full, path, [date(2024, 1, d) for d in range(1, 31)])
    left = t.events.where("created_at_date not in (DATE'2024-01-12', DATE'2024-01-13')")
    sinks.replace_dates(daily_stats.count_by_day(left.where("event_type <> 'ForkEvent'")), path, dates)
    return running_stats.current_daily(t.spark, path)


@query
def replace_recent_dates(t: Given) -> DataFrame:
    """Recompute from the 21st on, with the 25th gone, over half a day's statistics."""
    path = t.path("daily")
    mornings = t.events.where("hour(created_at) < 12")
    sinks.replace_dates(daily_stats.count_by_day(mornings), path, since=date(2024, 1, 1))
    left = t.events.where("created_at_date <> DATE'2024-01-25'")
    sinks.replace_dates(daily_stats.count_by_day(left), path, since=date(2024, 1, 21))
    return running_stats.current_daily(t.spark, path)


def retained_tables(t: Given) -> dict[str, DataFrame]:
    return {"events": t.events, "event_stats_daily": t.daily, "user_repo_relation": t.relations}


@query
def cleanup_old_data(t: Given) -> DataFrame:
    return sinks.retention_counts(retained_tables(t), RETENTION_DAYS, AS_OF)


@query
def retained_events(t: Given) -> DataFrame:
    """Stored events after their old date folders have been emptied."""
    path = t.path("events")
    sinks.write_events(t.events, path)
    sinks.expire_dates(t.spark, path, "created_at_date", RETENTION_DAYS, AS_OF)
    return t.spark.read.schema(t.events.schema).parquet(path)


@query
def export_csv(t: Given) -> DataFrame:
    path = t.path("csv")
    sinks.export_csv(t.events, path)
    types = "gh_event_id bigint, event_type string, public int, created_at timestamp_ntz, created_at_date date, actor_id bigint, repo_id bigint, org_id bigint, actor_login string, repo_name string"
    return t.spark.read.options(header=True, escape='"').schema(types).csv(path)


# --- browsing ------------------------------------------------------------------


@query
def table_page(t: Given) -> DataFrame:
    events = browse.table({"events": t.events}, "events")
    return iso_datetimes(browse.table_page(events, 7, 50, "gh_event_id"))


@query
def table_page_deep(t: Given) -> DataFrame:
    """A page in the second half of the table, numbered in parallel."""
    half = t.events.count() // 2
    return browse.table_page(t.events, half // 40 + 1, 40, ["repo_id", "gh_event_id"], deep=0)


@query
def page_info(t: Given) -> DataFrame:
    return browse.page_info(t.events, 7, 30)


def all_tables(t: Given) -> dict[str, DataFrame]:
    return {
        "actors": t.actors,
        "repos": t.repos,
        "organizations": t.orgs,
        "events": t.events,
        "payload_push": payloads.payload_push(t.raw),
        "payload_star": payloads.payload_star(t.raw),
        "payload_fork": payloads.payload_fork(t.raw),
        "payload_create": payloads.payload_create(t.raw),
        "user_repo_relation": t.relations,
        **statistics_tables(t),
    }


def statistics_tables(t: Given) -> dict[str, DataFrame]:
    return {
        "hot_repos": t.hot,
        "active_developers": t.developers,
        "actor_stats_cache": t.actor_cache,
        "repo_stats_cache": t.repo_cache,
        "event_stats_daily": t.daily,
    }


@query
def table_inventory(t: Given) -> DataFrame:
    return browse.table_inventory(all_tables(t))


@query
def stats_summary(t: Given) -> DataFrame:
    """Of the tables as the full refresh leaves them, with its time of update."""
    return update_all({"events": t.events, "actors": t.actors, "repos": t.repos}, AS_OF)["summary"]


@query
def run_sql(t: Given) -> DataFrame:
    t.events.createOrReplaceTempView("gh_events")
    t.repos.createOrReplaceTempView("gh_repos")
    return browse.run_sql(
        t.spark,
        """
        SELECT r.repo_id, r.name, count(*) AS created_events, max(e.created_at) AS last_created_at
        FROM gh_events e JOIN gh_repos r ON r.repo_id = e.repo_id
        WHERE e.event_type = 'CreateEvent' OR r.language = 'DROP TABLE'
        GROUP BY r.repo_id, r.name;
        """,
    )


@query
def run_sql_limited(t: Given) -> DataFrame:
    """A limit of the query's own, above the cap, holds."""
    t.events.createOrReplaceTempView("gh_events")
    return browse.run_sql(t.spark, "SELECT gh_event_id, actor_id FROM gh_events ORDER BY gh_event_id DESC LIMIT 3000")


@query
def run_sql_capped(t: Given) -> DataFrame:
    t.events.createOrReplaceTempView("gh_events")
    return browse.run_sql(t.spark, "WITH e AS (SELECT * FROM gh_events) SELECT gh_event_id FROM e ORDER BY gh_event_id")


@query
def table_pages(t: Given) -> DataFrame:
    """All events, page by page, by a key that many rows share, across the change of method."""
    rows = t.events.count()
    size = -(-rows // PAGES)
    pages = (
        browse.table_page(t.events, n, size, "repo_id", deep=rows // 2).select(F.lit(n).alias("page"), "gh_event_id")
        for n in range(1, PAGES + 1)
    )
    return reduce(DataFrame.union, pages)


# --- statistics ------------------------------------------------------------------


@query
def daily_stats_for_date(t: Given) -> DataFrame:
    return daily_stats.daily_stats(t.events, date.fromisoformat(ONE_DAY))


@query
def daily_stats_recent(t: Given) -> DataFrame:
    return t.daily


@query
def hot_repos_calendar(t: Given) -> DataFrame:
    return leaderboards.hot_repos(t.events, t.repos, AS_OF, leaderboards.WEIGHTED)


@query
def hot_repos(t: Given) -> DataFrame:
    return t.hot


@query
def active_developers_calendar(t: Given) -> DataFrame:
    return leaderboards.active_developers(t.events, t.actors, AS_OF, leaderboards.WEIGHTED)


@query
def active_developers(t: Given) -> DataFrame:
    return t.developers


@query
def actor_stats(t: Given) -> DataFrame:
    return t.actor_cache


@query
def repo_stats(t: Given) -> DataFrame:
    return t.repo_cache


@query
def repo_stats_one(t: Given) -> DataFrame:
    return entity_stats.repo_stats_one(t.events, 42, AS_OF)


@query
def refresh_repo_stats(t: Given) -> DataFrame:
    return entity_stats.refresh_repo_stats(t.repo_cache, t.events, 42, AS_OF)


@query
def repo_stats_summary(t: Given) -> DataFrame:
    return entity_stats.repo_stats_summary(t.repo_cache)


@query
def top_repos_by_stars(t: Given) -> DataFrame:
    top = entity_stats.top_n(t.repo_cache, "total_stars")
    return top.select(
        "repo_id", "total_stars", "total_watchers", "stars_7d", "total_commits", "total_prs"
    )


@query
def leaderboard_top3(t: Given) -> DataFrame:
    repos = leaderboards.leaderboard_top(t.hot).select(
        F.lit("hot_repos").alias("board"), "rank_position", F.col("repo_name").alias("name"), "score"
    )
    developers = leaderboards.leaderboard_top(t.developers).select(
        F.lit("active_developers").alias("board"),
        "rank_position",
        F.col("actor_login").alias("name"),
        F.col("activity_score").alias("score"),
    )
    return repos.union(developers)


@query
def recent_daily_summary(t: Given) -> DataFrame:
    return daily_stats.recent_daily_summary(t.daily, AS_OF)


@query
def base_stats_actors(t: Given) -> DataFrame:
    return base_stats.merge_actor_stats(t.actors, t.events).select(
        "actor_id", "total_events", "last_active_at"
    )


@query
def base_stats_repos(t: Given) -> DataFrame:
    return base_stats.merge_repo_stats(t.repos, t.events).select(
        "repo_id", "total_events", "total_stars", "total_forks", "last_event_at"
    )


@query
def user_repo_relation(t: Given) -> DataFrame:
    """Half a month merged into the relations of the other half."""
    prior = base_stats.relations(t.later, t.actors, t.repos)
    return base_stats.relations(t.earlier, t.actors, t.repos, prior)


@query
def overview_(t: Given) -> DataFrame:
    return overview.overview(t.events, t.actors, t.repos, t.orgs)


@query
def event_type_distribution(t: Given) -> DataFrame:
    return overview.event_types(t.events)


@query
def event_type_share(t: Given) -> DataFrame:
    return overview.event_type_share(t.events)


@query
def trending_repos_realtime(t: Given) -> DataFrame:
    return leaderboards.trending_repos_realtime(t.events, t.repos, 50, AS_OF)


@query
def trending_repos(t: Given) -> DataFrame:
    """The stored leaderboard, read back from a table."""
    return leaderboards.trending_repos(staged(t.hot), t.events, t.repos, 10, AS_OF)


@query
def trending_repos_fallback(t: Given) -> DataFrame:
    """No repository scores below zero, so the stored leaderboard is empty."""
    none = staged(t.hot.where("score < 0"))
    return leaderboards.trending_repos(none, t.events, t.repos, 10, AS_OF)


@query
def trending_developers_realtime(t: Given) -> DataFrame:
    return leaderboards.trending_developers_realtime(t.events, t.actors, 50, AS_OF)


@query
def trending_developers(t: Given) -> DataFrame:
    return leaderboards.trending_developers(staged(t.developers), t.events, t.actors, 10, AS_OF)


@query
def trending_developers_fallback(t: Given) -> DataFrame:
    """No developer scores below zero, so the stored leaderboard is empty."""
    none = staged(t.developers.where("activity_score < 0"))
    return leaderboards.trending_developers(none, t.events, t.actors, 10, AS_OF)


@query
def update_all_(t: Given) -> DataFrame:
    """Rows and column sums of every table after the full refresh."""
    state = {"events": t.events, "actors": t.actors, "repos": t.repos}
    after = update_all(state, AS_OF)
    measured = {
        "hot_repos": "score",
        "active_developers": "activity_score",
        "actor_stats_cache": "total_commits",
        "repo_stats_cache": "stars_30d",
        "event_stats_daily": "unique_actors",
        "actors": "total_events",
        "repos": "total_stars",
        "user_repo_relation": "event_count",
    }
    rows = [
        after[name].agg(
            F.lit(name).alias("name"),
            F.count("*").alias("row_count"),
            F.sum(F.col(column).cast("double")).alias("total"),
        )
        for name, column in measured.items()
    ]
    result = rows[0]
    for row in rows[1:]:
        result = result.union(row)
    return result


def refreshed(t: Given) -> str:
    """Where a full refresh published its tables."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _refreshes:
        after = update_all({"events": t.events, "actors": t.actors, "repos": t.repos}, AS_OF)
        _refreshes[key] = t.path("published")
        publish(after, _refreshes[key])
    return _refreshes[key]


#: The columns that a refresh changes in tables that have others as well.
REFRESHED = {
    "hot_repos": ("*",),
    "active_developers": ("*",),
    "actor_stats_cache": ("*",),
    "repo_stats_cache": ("*",),
    "event_stats_daily": ("*",),
    "actors": ("actor_id", "total_events", "last_active_at"),
    "repos": ("repo_id", "total_events", "total_stars", "total_forks", "last_event_at"),
    "user_repo_relation": ("*",),
}


def published(name: str, columns: tuple[str, ...]) -> Query:
    return lambda t: versions.current(t.spark, refreshed(t), name).select(*columns)


REGISTRY |= {f"update_all_{name}": published(name, columns) for name, columns in REFRESHED.items()}


# --- views -------------------------------------------------------------------------


@query
def recent_events_summary(t: Given) -> DataFrame:
    return views.recent_events_summary(t.events, t.actors, t.repos, AS_OF)


@query
def trending_repos_view(t: Given) -> DataFrame:
    board = leaderboards.hot_repos(t.events, t.repos, AS_OF, leaderboards.WEIGHTED)
    return views.trending_repos_view(board, t.repos)


@query
def active_developers_view(t: Given) -> DataFrame:
    board = leaderboards.active_developers(t.events, t.actors, AS_OF, leaderboards.WEIGHTED)
    return views.active_developers_view(board, t.actors)


@query
def repo_detail_stats(t: Given) -> DataFrame:
    return views.repo_detail_stats(t.repos, t.repo_cache)


@query
def actor_detail_stats(t: Given) -> DataFrame:
    return views.actor_detail_stats(t.actors, t.actor_cache)


@query
def daily_event_trends(t: Given) -> DataFrame:
    trends = views.daily_event_trends(t.daily, AS_OF)
    ratios = ("avg_events_per_actor", "avg_events_per_repo")
    return trends.withColumns({c: F.col(c).cast("double") for c in ratios})


# --- streaming ----------------------------------------------------------------------


def run_stream(t: Given, *after) -> archive_stream.BatchTable:
    store = archive_stream.event_store(t.spark, t.path("stream-events"))
    lines = archive_stream.line_stream(t.spark, t.archive, STREAM_FILES)
    steps = tuple(step(store) for step in after)
    archive_stream.stream_ingest(
        lines, store, t.path("progress"), t.dimensions, steps, as_of=AS_OF
    ).awaitTermination()
    return store


@query
def stream_ingest(t: Given) -> DataFrame:
    return run_stream(t).rows()


@query
def stream_dedupe(t: Given) -> DataFrame:
    lines = archive_stream.line_stream(t.spark, t.archive, STREAM_FILES)
    store = archive_stream.event_store(t.spark, t.path("distinct"))
    archive_stream.stream_dedupe(lines, store, t.path("progress"), as_of=AS_OF).awaitTermination()
    return store.rows().select("gh_event_id", "event_type", "created_at", "actor_id", "repo_id")


@query
def stream_validate(t: Given) -> DataFrame:
    valid = archive_stream.event_store(t.spark, t.path("valid"))
    invalid = archive_stream.quarantine_store(t.spark, t.path("invalid"))
    lines = archive_stream.line_stream(t.spark, t.archive, STREAM_FILES)
    archive_stream.stream_validate(
        lines, valid, invalid, t.path("progress"), t.actors, t.repos, t.orgs, as_of=AS_OF
    ).awaitTermination()
    columns = ["gh_event_id", "event_type", "created_at", "error_msg"]
    good = valid.rows().withColumn("error_msg", F.lit("")).select(*columns)
    return good.unionByName(invalid.rows().select(*columns))


@query
def stream_counters(t: Given) -> DataFrame:
    """Totals of actors and repositories after the stream, in one frame."""
    tables = running_stats.increment_tables(t.spark, t.path("increments"))
    run_stream(t, lambda _: running_stats.counters(tables))
    actors = running_stats.current_actors(tables, t.actors).select(
        F.lit("actor").alias("entity"),
        F.col("actor_id").alias("id"),
        "total_events",
        F.lit(None).cast("bigint").alias("total_stars"),
        F.lit(None).cast("bigint").alias("total_forks"),
        F.col("last_active_at").alias("last_at"),
    )
    repos = running_stats.current_repos(tables, t.repos).select(
        F.lit("repo").alias("entity"),
        F.col("repo_id").alias("id"),
        "total_events",
        "total_stars",
        "total_forks",
        F.col("last_event_at").alias("last_at"),
    )
    return actors.unionByName(repos)


@query
def stream_relations(t: Given) -> DataFrame:
    tables = running_stats.increment_tables(t.spark, t.path("increments"))
    run_stream(t, lambda _: running_stats.relation_updates(tables))
    return running_stats.current_relations(tables, t.actors, t.repos)


@query
def stream_relations_compacted(t: Given) -> DataFrame:
    """The same relations once the increments have been folded."""
    tables = running_stats.increment_tables(t.spark, t.path("increments"))
    run_stream(t, lambda _: running_stats.relation_updates(tables))
    folded = running_stats.compact(tables, t.path("folded"))
    return running_stats.current_relations(folded, t.actors, t.repos)


@query
def stream_daily_stats(t: Given) -> DataFrame:
    path = t.path("stream-daily")
    run_stream(t, lambda store: running_stats.daily_updates(store, path))
    return running_stats.current_daily(t.spark, path)


# --- time, distinct counts, distributions ---------------------------------------------


@query
def actor_sessions(t: Given) -> DataFrame:
    return sessions.actor_sessions(t.events)


@query
def stream_sessions(t: Given) -> DataFrame:
    """The same sessions from a stream in which every eleventh event comes three days late."""
    events = session_stream.event_stream(t.spark, arrivals_of(t.spark, t.sf_dir), EVENTS, ARRIVALS_PER_BATCH)
    path = t.path("sessions")
    session_stream.stream_sessions(events, path, t.path("progress")).awaitTermination()
    return session_stream.closed_sessions(t.spark, path).where(F.col("actor_id") != CLOSING)


@query
def window_counts(t: Given) -> DataFrame:
    return window_stream.window_counts(t.events, 60, 30)


@query
def stream_windows(t: Given) -> DataFrame:
    """Counts of sliding windows, on time and late, each with what the stream made of it."""
    tables = window_stream.window_tables(t.spark, t.path("windows"))
    events = session_stream.event_stream(t.spark, arrivals_of(t.spark, t.sf_dir), EVENTS, ARRIVALS_PER_BATCH)
    window_stream.stream_windows(events.where(F.col("actor_id") != CLOSING), tables, t.path("progress"), 60, 30).awaitTermination()
    kinds = {"closed": tables.closed.rows(), "open": window_stream.open_windows(tables), "late": window_stream.late_counts(tables)}
    parts = [rows.select(F.lit(kind).alias("kind"), "window_start", "window_end", "event_type", "events") for kind, rows in kinds.items()]
    return reduce(DataFrame.union, parts)


@query
def asof_daily_stats(t: Given) -> DataFrame:
    """Each event with its repository's latest statistics of a day before."""
    daily = t.events.groupBy("repo_id", "created_at_date").agg(
        F.count("*").alias("day_events"), F.count_if(F.col("event_type") == WATCH).alias("day_stars")
    )
    known = daily.select(
        "repo_id", F.expr("timestampadd(DAY, 1, CAST(created_at_date AS TIMESTAMP_NTZ))").alias("known_at"),
        F.col("created_at_date").alias("stats_date"), "day_events", "day_stars",
    )
    events = t.events.select("gh_event_id", "repo_id", "created_at")
    return asof.asof_join(events, known, "repo_id", "created_at", "known_at").drop("known_at")


@query
def star_push_pairs(t: Given) -> DataFrame:
    """A star and a push of one actor within the hour after it."""

    def of_kind(kind: str, name: str) -> DataFrame:
        rows = t.events.where(F.col("event_type") == kind)
        return rows.select("actor_id", *(F.col(c).alias(f"{name}_{c}") for c in ("gh_event_id", "repo_id", "created_at")))

    return intervals.interval_join(
        of_kind(WATCH, "star"), of_kind(PUSH, "push"), "actor_id", "star_created_at", "push_created_at", 3600
    )


def stored_sketches(t: Given) -> DataFrame:
    return staged(sketches.daily_sketches(t.events), "sketches")


@query
def sketch_distincts(t: Given) -> DataFrame:
    return sketches.distinct_between(stored_sketches(t), date(2024, 1, 1), date(2024, 1, 30))


@query
def returning_actors(t: Given) -> DataFrame:
    ranges = (date(2024, 1, 1), date(2024, 1, 15)), (date(2024, 1, 16), date(2024, 1, 30))
    return sketches.returning(stored_sketches(t), *ranges)


@query
def pause_quantiles(t: Given) -> DataFrame:
    return quantiles.pause_quantiles(t.events)


@query
def grouping_sets(t: Given) -> DataFrame:
    return grouping.grouping_sets(t.events)


@query
def moving_sums(t: Given) -> DataFrame:
    return moving.moving_sums(moving.repo_days(t.events))


@query
def leading_developers(t: Given) -> DataFrame:
    return moving.leading_developers(t.events)


def totals_of(events: DataFrame) -> DataFrame:
    return events.groupBy("actor_id", "event_type").agg(F.count("*").alias("events"), F.max("created_at").alias("last_at"))


@query
def refresh_difference(t: Given) -> DataFrame:
    """What the second half of the month changed in a table of totals; the key is the actor."""
    return difference.difference(totals_of(t.earlier), totals_of(t.events), ["actor_id", "event_type"])


@query
def refresh_applied(t: Given) -> DataFrame:
    """The later version, from the earlier one and the difference."""
    old = staged(totals_of(t.earlier), "old")
    return difference.applied(old, difference.difference(old, totals_of(t.events), ["actor_id", "event_type"]))


@query
def fork_trees(t: Given) -> DataFrame:
    """Forks among the given repositories; several of them lie on cycles."""
    made = t.events.where(F.col("event_type") == FORK).select(
        F.col("repo_id").alias("parent"), (F.col("actor_id") * 7 % 397 + 1).alias("child"), F.col("created_at").alias("forked_at")
    )
    return forks.fork_trees(made)


@query
def actor_rhythms(t: Given) -> DataFrame:
    return rhythm.rhythms(t.events).withColumn("entropy", F.round("entropy", 9))
