"""Sessions, as-of and interval joins, sketches, quantiles and grouping sets: brute force, hot keys, plans."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest

from eventloom.operators import asof, grouping, intervals, quantiles, sessions, sketches
from eventloom.sinks import tables as sinks
from tests.conftest import rows
from tests.test_plans_and_skew import plan

NOON = datetime(2024, 1, 1, 12)
TIMED = "id long, k long, at timestamp_ntz, kind string"


def at(minutes):
    return NOON + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def skewed(make_events):
    """3000 events; actor and repository 1 hold a third."""
    draw = random.Random(11)
    made = []
    for n in range(3000):
        one = n % 3 == 0
        when = datetime(2024, 1, 1) + timedelta(seconds=draw.randrange(20 * 24 * 3600))
        kind = draw.choice(["Watch", "Push", "Fork"])
        made.append((n, kind, when.isoformat(), 1 if one else draw.randrange(2, 90), 1 if one else draw.randrange(2, 60), n % 7 or None))
    return make_events(made)


@pytest.fixture(scope="module")
def stored(spark, skewed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("timed") / "events")
    sinks.write_events(skewed, path)
    return spark.read.schema(skewed.schema).parquet(path)


def runs(times, gap):
    found = []
    for t in sorted(times):
        if found and t - found[-1][1] <= gap:
            found[-1] = (found[-1][0], t, found[-1][2] + 1)
        else:
            found.append((t, t, 1))
    return found


def test_sessions_of_a_hot_actor(skewed):
    by_actor = defaultdict(list)
    for r in skewed.collect():
        by_actor[r.actor_id].append(r.created_at)
    for minutes in (1, 30, 600):
        expected = sorted((a, *run) for a, times in by_actor.items() for run in runs(times, timedelta(minutes=minutes)))
        got = sessions.actor_sessions(skewed, minutes).select("actor_id", "session_start", "session_end", "events")
        assert sorted(map(tuple, got.collect())) == expected


def test_a_pause_of_exactly_the_gap_does_not_end_a_session(make_events):
    events = make_events([(n, "Push", at(m).isoformat(), 1, 1, None) for n, m in enumerate((0, 30, 60, 91, 91))])
    got = sessions.actor_sessions(events).orderBy("session_start").select("session_start", "session_end", "events")
    assert rows(got) == [(at(0), at(60), 3), (at(91), at(91), 2)]


def test_sessions_join_in_any_order_of_pieces(skewed):
    halves = [sessions.pieces(skewed.where(f"gh_event_id % 2 = {n}")) for n in (0, 1)]
    whole = sessions.actor_sessions(skewed)
    assert Counter(map(tuple, sessions.joined(halves[0].union(halves[1])).collect())) == Counter(map(tuple, whole.collect()))


def test_sessions_combine_before_the_shuffle_and_leave_odd_rows_out(stored, make_events):
    text = plan(sessions.actor_sessions(stored))
    assert text.rindex("partial_count") > text.rindex("Exchange hashpartitioning")
    assert "repo_name" not in text
    odd = make_events([(1, "Push", at(0).isoformat(), None, 1, None)])
    assert sessions.actor_sessions(odd).count() == sessions.actor_sessions(odd.limit(0)).count() == 0


def asof_brute(left, right):
    for i, k, t, kind in left:
        own = [(at2, rest) for k2, at2, *rest in right if k is not None and t is not None and k2 == k and at2 is not None and at2 <= t]
        yield (i, k, t, kind, *(max(own) if own else (None, (None,)))[1])


def test_asof_join_with_ties_nulls_and_a_hot_key(spark):
    draw = random.Random(3)
    left = [(i, 1 if i % 3 == 0 else draw.choice((2, 3, 4, None)), draw.choice((None, at(draw.randrange(4000)))) if i % 20 == 0 else at(draw.randrange(4000)), "x") for i in range(600)]
    right = [(draw.choice((1, 2, 3, 9, None)), at(draw.randrange(4000)), n) for n in range(150)]
    right += [(k, t, n + 1000) for k, t, n in right[:20]] + [(1, None, 5)]
    got = asof.asof_join(
        spark.createDataFrame(left, TIMED), spark.createDataFrame(right, "k long, since timestamp_ntz, value long"), "k", "at", "since"
    )
    assert got.columns == ["id", "k", "at", "kind", "since", "value"]
    assert Counter(map(tuple, got.drop("since").collect())) == Counter(asof_brute(left, right))


def test_asof_join_needs_no_pairs_and_refuses_clashing_names(spark, stored):
    daily = stored.selectExpr("repo_id", "created_at as known_at", "event_type as last_type")
    text = plan(asof.asof_join(stored, daily, "repo_id", "created_at", "known_at"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    with pytest.raises(ValueError, match="both"):
        asof.asof_join(stored, daily.withColumnRenamed("last_type", "event_type"), "repo_id", "created_at", "known_at")
    assert asof.asof_join(stored.limit(0), daily, "repo_id", "created_at", "known_at").count() == 0
    alone = asof.asof_join(stored, daily.limit(0), "repo_id", "created_at", "known_at")
    assert alone.count() == alone.where("known_at is null").count() == stored.count()


def test_interval_join_salts_hot_buckets_and_loses_no_pair(spark, skewed):
    kinds = {k: skewed.where(f"event_type = '{k}Event'") for k in ("Watch", "Push")}
    left = kinds["Watch"].selectExpr("actor_id", "gh_event_id as star", "created_at as starred_at")
    right = kinds["Push"].selectExpr("actor_id", "gh_event_id as push", "created_at as pushed_at")
    stars, pushes = left.collect(), right.collect()
    for seconds in (600, 86_400):
        expected = {
            (s.star, p.push)
            for s in stars for p in pushes
            if s.actor_id == p.actor_id and 0 <= (p.pushed_at - s.starred_at).total_seconds() <= seconds
        }
        for most in (3, 100_000):
            got = intervals.interval_join(left, right, "actor_id", "starred_at", "pushed_at", seconds, most)
            found = [(r.star, r.push) for r in got.collect()]
            assert len(found) == len(set(found)) and set(found) == expected
    text = plan(intervals.interval_join(left, right, "actor_id", "starred_at", "pushed_at", 600))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_interval_join_bounds_repeats_and_nulls(spark):
    left = spark.createDataFrame([(1, at(0)), (1, at(0)), (None, at(0)), (2, None)], "k long, a timestamp_ntz")
    right = spark.createDataFrame([(1, at(0)), (1, at(60)), (1, at(61)), (1, at(-1)), (None, at(0)), (2, None)], "k long, b timestamp_ntz")
    got = intervals.interval_join(left, right, "k", "a", "b", 3600)
    assert Counter(map(tuple, got.collect())) == Counter({(1, at(0), at(0)): 2, (1, at(0), at(60)): 2})


def test_sketches_are_close_when_ids_are_many(spark):
    events = spark.range(200_000).selectExpr(
        "id as gh_event_id", "date_add(DATE'2024-01-01', cast(id % 10 as int)) as created_at_date",
        "case when id % 4 = 0 then 'PushEvent' else 'WatchEvent' end as event_type", "id % 60000 as actor_id", "id % 50 as repo_id",
    )
    first, last = date(2024, 1, 2), date(2024, 1, 7)
    small = sketches.daily_sketches(events, 12)
    inside = events.where(events.created_at_date.between(first, last)).select("event_type", "actor_id").distinct()
    truth = {r.event_type: r["count"] for r in inside.groupBy("event_type").count().collect()}
    for r in sketches.distinct_between(small, first, last, 12).collect():
        assert abs(r.actors - truth[r.event_type]) < 4 * truth[r.event_type] / math.sqrt(2**12) and r.repos <= 50


def test_a_month_of_distincts_reads_sketches_only(spark, stored, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.daily_sketches(stored).write.parquet(path)
    kept = spark.read.parquet(path)
    text = plan(sketches.distinct_between(kept, date(2024, 1, 2), date(2024, 1, 9)))
    assert text.count("FileScan parquet") == 1 and "actor_id" not in text and "repo_sketch" in text
    assert kept.count() <= 20 * 3
    got = sketches.returning(kept, (date(2030, 1, 1), date(2030, 1, 2)), (date(2024, 1, 1), date(2024, 1, 30)))
    assert all(r.returning == 0 and r.new > 0 for r in got.collect())


def quantile_brute(values, share):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(share * len(ordered))) - 1]


@pytest.mark.parametrize("bits", [3, 16, 62])
def test_quantiles_of_any_width_and_with_ties(spark, bits):
    draw = random.Random(bits)
    values = {"a": [draw.randrange(2**40) for _ in range(101)], "b": [7] * 50, "c": [0], "e": [draw.randrange(4) for _ in range(40)]}
    made = [(g, v) for g, own in values.items() for v in own] + [("d", None), (None, 5)]
    shares = (0.0, 0.1, 0.5, 0.99, 1.0)
    got = quantiles.exact_quantiles(spark.createDataFrame(made, "g string, v long"), "g", "v", shares, bits)
    found = {(r.g, r.share): r.v for r in got.where("g is not null").collect()}
    assert found == {(g, s): quantile_brute(own, s) for g, own in values.items() for s in shares}


def test_pauses_look_across_time_cells(spark, skewed):
    last, expected = {}, []
    for r in sorted(skewed.collect(), key=lambda r: r.created_at):
        before = last.get(r.repo_id)
        expected.append(None if before is None else int((r.created_at - before).total_seconds()))
        last[r.repo_id] = r.created_at
    got = [r.pause for r in quantiles.pauses(skewed).collect()]
    assert Counter(got) == Counter(expected)


def test_grouping_sets_scan_facts_once_and_count_exactly(stored):
    got = {(r.stats_date, r.event_type, r.level): tuple(r)[3:] for r in grouping.grouping_sets(stored).collect()}
    all_rows = stored.collect()
    for d, kind, level in got:
        own = [
            r for r in all_rows
            if (level & 2 or r.created_at_date == d) and (level & 1 or r.event_type == kind)
        ]
        distinct = [len({getattr(r, c) for r in own} - {None}) for c in ("actor_id", "repo_id", "org_id")]
        assert got[d, kind, level] == (len(own), *distinct)
    assert plan(grouping.counted_ids(stored)).count("FileScan parquet") == 1
    assert "partial_count" in plan(grouping.counted_ids(stored))
    assert grouping.grouping_sets(stored.limit(0)).collect() == []
