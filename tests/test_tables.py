"""Upserts, sinks, retention, browsing."""

from __future__ import annotations

import csv
import io
from datetime import date, datetime
from pathlib import Path

import pytest

from eventloom.operators import browse
from eventloom.operators.upsert import ADD, GREATEST, KEEP, REPLACE, upsert
from eventloom.plans.nightly import publish, update_all
from eventloom.sinks import tables as sinks, versions
from tests.conftest import rows

AS_OF = "2024-01-31 12:00:00"
DAILY = "stats_date date, event_type string, total_count bigint, unique_actors bigint, unique_repos bigint, unique_orgs bigint"


def test_upsert_policies(spark):
    schema = "k bigint, a bigint, b bigint, c bigint, d bigint, untouched string"
    prior = spark.createDataFrame([(1, 1, None, 5, 5, "x"), (2, 2, 2, 2, 2, "y")], schema)
    new = spark.createDataFrame([(1, 9, 9, 4, 3), (3, 7, 7, 7, 7)], "k bigint, a bigint, b bigint, c bigint, d bigint")
    policy = {"a": REPLACE, "b": KEEP, "c": ADD, "d": GREATEST}
    merged = upsert(prior, new, ["k"], policy)
    assert rows(merged, "k") == [(1, 9, None, 9, 5, "x"), (2, 2, 2, 2, 2, "y"), (3, 7, 7, 7, 7, None)]
    with pytest.raises(ValueError):
        upsert(prior, new, ["k"], {"a": "latest"})


@pytest.fixture(scope="module")
def month(make_events):
    return make_events(
        [(n, "Push" if n % 2 else "Watch", f"2024-01-{n % 28 + 1:02d} 05:00:00", n % 7, n % 5, None) for n in range(280)]
    )


def test_events_are_appended_by_date_and_pruned(spark, month, tmp_path):
    path = str(tmp_path / "events")
    sinks.write_events(month.where("gh_event_id < 100"), path)
    sinks.write_events(month.where("gh_event_id >= 100"), path)
    stored = spark.read.schema(month.schema).parquet(path)
    assert rows(stored.select(*month.columns), "gh_event_id") == rows(month, "gh_event_id")
    assert (tmp_path / "events" / "created_at_date=2024-01-05").is_dir()


def test_replace_table_leaves_the_earlier_version(spark, month, tmp_path):
    first = sinks.replace_table(month, str(tmp_path))
    second = sinks.replace_table(spark.read.parquet(first).where("gh_event_id < 10"), str(tmp_path))
    assert spark.read.parquet(first).count() == 280
    assert spark.read.parquet(second).count() == 10


def test_replaced_dates_may_become_empty(spark, tmp_path):
    def daily(*pairs):
        return spark.createDataFrame([(d, "PushEvent", n, 1, 1, 0) for d, n in pairs], DAILY)

    path = str(tmp_path / "daily")
    days = [date(2024, 1, d) for d in range(1, 5)]
    sinks.replace_dates(daily(*((d, 1) for d in days)), path, days)
    sinks.replace_dates(daily((days[1], 5), (days[3], 9)), path, days[1:3])
    stored = spark.read.schema(DAILY).parquet(path).select("stats_date", "total_count")
    assert rows(stored, "stats_date") == [(days[0], 1), (days[1], 5), (days[3], 1)]
    sinks.replace_dates(daily(), path, days[:1])
    assert spark.read.schema(DAILY).parquet(path).count() == 2
    sinks.replace_dates(daily((date(2024, 2, 1), 7)), path, since=days[2])
    stored = spark.read.schema(DAILY).parquet(path).select("stats_date", "total_count")
    assert rows(stored, "stats_date") == [(days[1], 5), (date(2024, 2, 1), 7)]


def test_retention_keeps_the_cutoff_and_null_times(spark, month):
    relations = spark.createDataFrame(
        [(1, datetime(2024, 1, 10, 23)), (2, datetime(2024, 1, 11)), (3, None)], "k bigint, last_event_at timestamp_ntz"
    )
    daily = spark.createDataFrame([(date(2024, 1, 10),), (date(2024, 1, 11),)], "stats_date date")
    tables = {"events": month, "event_stats_daily": daily, "user_repo_relation": relations}
    assert rows(sinks.retention_counts(tables, 20, AS_OF)) == [(100, 1, 1)]
    kept = sinks.retain(tables, 20, AS_OF)
    assert rows(kept["user_repo_relation"].select("k"), "k") == [(2,), (3,)]


def test_stored_dates_expire(spark, month, tmp_path):
    path = str(tmp_path / "events")
    sinks.write_events(month, path)
    sinks.expire_dates(spark, path, "created_at_date", 20, AS_OF)
    kept = spark.read.schema(month.schema).parquet(path).select(*month.columns)
    assert rows(kept, "gh_event_id") == rows(month.where("created_at_date >= '2024-01-11'"), "gh_event_id")
    for _ in range(2):  # all dates, then none that are left
        sinks.expire_dates(spark, path, "created_at_date", 0, AS_OF)
    assert spark.read.schema(month.schema).parquet(path).count() == 0


def test_csv_survives_quotes_commas_and_line_breaks(spark, tmp_path):
    texts = ["plain", 'a "quoted", word', "two\nlines", ""]
    df = spark.createDataFrame([(n, t, datetime(2024, 1, 5, 6)) for n, t in enumerate(texts)], "k int, t string, at timestamp_ntz")
    sinks.export_csv(df.coalesce(1), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in Path(tmp_path / "csv").glob("*.csv"))
    found = list(csv.reader(io.StringIO(text)))
    assert found[0] == ["k", "t", "at"]
    assert found[1:] == [[str(n), t, "2024-01-05T06:00:00"] for n, t in enumerate(texts)]


def test_pages(spark, month):
    page = browse.table_page(month, 3, 20, "gh_event_id").select("gh_event_id")
    assert rows(page) == [(n,) for n in range(40, 60)]
    for number in (1, 2, 7, 14, 15):
        shallow = browse.table_page(month, number, 20, ["repo_id", "gh_event_id"])
        deep = browse.table_page(month, number, 20, ["repo_id", "gh_event_id"], deep=-1)
        assert rows(deep) == rows(shallow)
    assert rows(browse.page_info(month.limit(41))) == [(1, 20, 41, 3)]
    assert rows(browse.page_info(month.limit(0))) == [(1, 20, 0, 0)]
    with pytest.raises(ValueError):
        browse.table({"secrets": month}, "secrets")


def test_column_listing(month):
    listed = rows(browse.table_columns(month, keys=["gh_event_id"]))
    assert listed[0] == ("gh_event_id", "bigint", "PRI")
    assert [r[0] for r in listed] == month.columns


def test_inventory_and_summary(spark, month):
    daily = spark.createDataFrame([(1, datetime(2024, 1, 2))], "k int, stats_time timestamp_ntz")
    assert rows(browse.table_inventory({"repos": month, "actors": daily})) == [("actors", 1), ("repos", 280)]
    summary = browse.stats_summary({"hot_repos": month, "event_stats_daily": daily})
    assert rows(summary) == [("hot_repos", 280, None), ("event_stats_daily", 1, datetime(2024, 1, 2))]


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT created_at FROM month_events",
        "SELECT 'DROP TABLE x; DELETE' AS t, updated_at FROM (SELECT created_at AS updated_at FROM month_events);",
        "WITH e AS (SELECT * FROM month_events) SELECT count(*) FROM e -- limit",
        "SELECT x.* FROM (SELECT * FROM month_events LIMIT 200) x",
    ],
)
def test_queries_are_accepted_and_capped(spark, month, sql):
    month.createOrReplaceTempView("month_events")
    assert 0 < browse.run_sql(spark, sql, max_rows=100).count() <= 100


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT * FROM month_events ORDER BY created_at DESC LIMIT 200",
        "WITH e AS (SELECT * FROM month_events) SELECT * FROM e LIMIT 200",
        "(SELECT * FROM month_events) LIMIT 200;",
    ],
)
def test_a_limit_of_the_query_holds(spark, month, sql):
    month.createOrReplaceTempView("month_events")
    assert browse.run_sql(spark, sql, max_rows=100).count() == 200
    assert browse.run_sql(spark, "SELECT * FROM month_events", max_rows=None).count() == 280


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT TRANSFORM(gh_event_id) USING 'cat' FROM month_events",
        "SELECT * FROM (SELECT TRANSFORM(gh_event_id) USING 'cat' AS x FROM month_events) t",
        "WITH t AS (SELECT TRANSFORM(gh_event_id) USING 'cat' AS x FROM month_events) SELECT count(*) FROM t",
        "SELECT reflect('java.lang.System', 'getenv', 'HOME')",
        "SELECT java_method('java.lang.System', 'getenv', 'HOME') FROM month_events",
        "SELECT try_reflect('java.lang.System', 'getenv', 'HOME')",
        "SELECT 1 WHERE 'x' IN (SELECT reflect('java.lang.System', 'getenv', 'HOME'))",
        "SELECT (SELECT upper(reflect('java.lang.System', 'getenv', 'HOME'))) AS h FROM month_events",
        "WITH t AS (SELECT 1 AS x WHERE reflect('java.lang.System', 'getenv', 'HOME') = 'x') SELECT * FROM t",
    ],
)
def test_programs_are_refused(spark, month, sql):
    month.createOrReplaceTempView("month_events")
    with pytest.raises(ValueError):
        browse.run_sql(spark, sql)


def test_words_in_texts_are_no_programs(spark):
    assert rows(browse.run_sql(spark, "SELECT 'reflect(TRANSFORM)' AS t")) == [("reflect(TRANSFORM)",)]
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


def test_pages_of_equal_keys_join_up(month):
    pages = [rows(browse.table_page(month, n, 30, "repo_id", deep=120).select("gh_event_id")) for n in range(1, 11)]
    assert sorted(r for page in pages for r in page) == [(n,) for n in range(280)]
    first = [rows(browse.table_page(month.select("actor_id", "gh_event_id"), n, 30).select("gh_event_id")) for n in range(1, 11)]
    assert len({r for page in first for r in page}) == 280


def test_large_pages_are_not_brought_together_in_one_task(spark, month, monkeypatch):
    monkeypatch.setattr(browse, "DEEP_OFFSET", 50)
    small, large = (browse.table_page(month, 1, size, "repo_id", deep=10_000) for size in (50, 60))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (small, large)]
    assert "TakeOrderedAndProject" in plans[0]
    assert not any(word in plans[1] for word in ("TakeOrdered", "GlobalLimit", "SinglePartition"))
    pages = [rows(browse.table_page(month, n, 60, "repo_id", deep=10_000).select("gh_event_id")) for n in range(1, 7)]
    assert [r for page in pages for r in page] == rows(month.orderBy("repo_id", *month.columns).select("gh_event_id"))


def test_large_pages_of_nulls_and_one_value(spark, monkeypatch):
    monkeypatch.setattr(browse, "DEEP_OFFSET", 0)
    values = [None] * 7 + [float("nan")] * 3 + [1.5] * 11 + [-2.0] * 2
    df = spark.createDataFrame([(v, n) for n, v in enumerate(values)], "v double, k int").repartition(4)
    pages = [rows(browse.table_page(df, n, 5, "v").select("k")) for n in range(1, 7)]
    assert pages == [rows(df.orderBy("v", "k").offset(5 * n).limit(5).select("k")) for n in range(6)]
    assert [len(page) for page in pages] == [5, 5, 5, 5, 3, 0]


def test_stored_relations_expire(spark, tmp_path):
    stored = spark.createDataFrame(
        [(1, datetime(2024, 1, 10, 23)), (2, datetime(2024, 1, 11)), (3, None)], "k bigint, last_event_at timestamp_ntz"
    )
    first = sinks.replace_table(stored, str(tmp_path))
    second = sinks.expire_relations(spark, first, str(tmp_path), 20, AS_OF)
    assert rows(spark.read.parquet(second).select("k"), "k") == [(2,), (3,)]
    assert spark.read.parquet(first).count() == 3


def test_order_survives_the_cap(spark, month):
    month.createOrReplaceTempView("month_events")
    found = browse.run_sql(spark, "SELECT gh_event_id FROM month_events ORDER BY 1 DESC", 3)
    assert rows(found) == [(279,), (278,), (277,)]


@pytest.mark.parametrize(
    "sql",
    [
        "",
        ";",
        "DROP TABLE events",
        "CREATE TABLE t AS SELECT 1",
        "INSERT INTO t SELECT 1",
        "SELECT 1; DROP TABLE events",
        "SELECT 1) x; DROP VIEW month_events --",
        "SHOW TABLES",
        "SET spark.sql.ansi.enabled=false",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/events.parquet`",
    ],
)
def test_other_statements_are_refused(spark, sql):
    with pytest.raises(Exception):
        browse.run_sql(spark, sql)


@pytest.fixture(scope="module")
def dimensions(make_actors, make_repos):
    return {
        "actors": make_actors(*({"actor_id": n} for n in range(7))),
        "repos": make_repos(*({"repo_id": n} for n in range(5))),
    }


def test_refresh_keeps_old_dates_and_adds_only_the_batch(spark, month, dimensions):
    old = spark.createDataFrame(
        [(date(2023, 1, 1), "PushEvent", 1, 1, 1, 0), (date(2024, 1, 5), "PushEvent", 99, 1, 1, 0)], DAILY
    )
    state = {"events": month, "event_stats_daily": old, **dimensions}
    after = update_all(state, AS_OF, batch=month.where("gh_event_id < 70"))
    daily = {(r.stats_date, r.event_type): r.total_count for r in after["event_stats_daily"].collect()}
    assert daily[(date(2023, 1, 1), "PushEvent")] == 1
    assert (date(2024, 1, 5), "PushEvent") not in daily
    assert after["actors"].agg({"total_events": "sum"}).first()[0] == 70
    assert after["user_repo_relation"].agg({"event_count": "sum"}).first()[0] == 70
    assert {r.name for r in after["summary"].collect()} == set(browse.SUMMARY_TABLES)


def test_a_refresh_is_published_beside_the_earlier_one(spark, month, dimensions, tmp_path):
    state = {"events": month, **dimensions}
    first = publish(update_all(state, AS_OF), str(tmp_path))
    assert set(first) == {
        "hot_repos", "active_developers", "actor_stats_cache", "repo_stats_cache", "event_stats_daily",
        "actors", "repos", "user_repo_relation",
    }
    stored = spark.createDataFrame([(1,)], "unexpected bigint")
    second = publish(update_all({**state, "user_repo_relation": stored}, AS_OF), str(tmp_path))
    assert set(first) - set(second) == {"user_repo_relation"} and not set(first.values()) & set(second.values())
    assert spark.read.parquet(first["actors"]).agg({"total_events": "sum"}).first()[0] == 280
    later = spark.newSession()  # one that was given no paths
    assert versions.current(later, str(tmp_path), "actors").agg({"total_events": "sum"}).first()[0] == 280
    assert versions.folders(later, str(tmp_path)) == {**first, **second}
    with pytest.raises(ValueError, match="not published"):
        versions.current(later, str(tmp_path), "nothing")

    third = publish(update_all(state, AS_OF), str(tmp_path))
    assert set(versions.clean(spark, str(tmp_path), keep=1)) == {*first.values(), *second.values()}
    assert versions.folders(spark, str(tmp_path)) == third
    assert all(versions.current(later, str(tmp_path), name).columns for name in third)


def test_one_of_two_publishers_fails_and_leaves_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert versions.folders(spark, root) == {} and versions.clean(spark, root) == []
    assert versions.point_to(spark, root, {"a": f"{root}/a/1", "b": f"{root}/b/1"}) == 1
    monkeypatch.setattr(versions, "publications", lambda *_: [])  # has not seen the other one
    with pytest.raises(RuntimeError, match="another job"):
        versions.point_to(spark, root, {"a": f"{root}/a/2"})
    monkeypatch.undo()
    assert versions.folders(spark, root) == {"a": f"{root}/a/1", "b": f"{root}/b/1"}
    assert versions.point_to(spark, root, {"a": f"{root}/a/3"}) == 2
    assert versions.clean(spark, root, keep=1) == [f"{root}/a/1"]


def test_refresh_survives_a_failing_table(spark, month, dimensions):
    stored = spark.createDataFrame([(1,)], "unexpected bigint")
    state = {"events": month, "user_repo_relation": stored, **dimensions}
    after = update_all(state, AS_OF)
    assert after["user_repo_relation"] is stored
    assert [r.name for r in after["failures"].collect()] == ["user_repo_relation"]
    assert after["actors"].agg({"total_events": "sum"}).first()[0] == 280
