"""Moving frames, leading developers, differences, fork trees and rhythms: brute force, hot keys, plans."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest

from eventloom.operators import difference, forks, moving, rhythm
from tests.test_plans_and_skew import plan
from tests.test_time_operators import skewed, stored  # noqa: F401


def test_moving_sums_count_missing_days_as_empty(skewed):  # noqa: F811
    per_day = Counter((r.repo_id, r.created_at_date) for r in skewed.where("created_at_date <> DATE'2024-01-09'").collect())
    got = moving.moving_sums(moving.repo_days(skewed.where("created_at_date <> DATE'2024-01-09'")), (1, 3, 28)).collect()
    assert len(got) == len(per_day)
    for r in got:
        for n in (1, 3, 28):
            assert r[f"events_{n}"] == sum(per_day[r.repo_id, r.stats_date - timedelta(days=d)] for d in range(n))
    on = [r for r in got if r.stats_date == date(2024, 1, 8)]
    assert [r.rank_3 for r in sorted(on, key=lambda r: (-r.events_3, r.repo_id))] == list(range(1, len(on) + 1))


def test_moving_sums_group_before_they_look_back(stored):  # noqa: F811
    text = plan(moving.moving_sums(moving.repo_days(stored)))
    assert text.count("FileScan parquet") == 1 and "SinglePartition" not in text


def test_leading_developers_are_limited_before_the_shuffle(skewed, stored):  # noqa: F811
    per_pair = Counter((r.repo_id, r.actor_id) for r in skewed.collect())
    by_repo = defaultdict(list)
    for (repo, actor), n in per_pair.items():
        by_repo[repo].append((-n, actor))
    expected = {(repo, i + 1, a, -n) for repo, own in by_repo.items() for i, (n, a) in enumerate(sorted(own)[:3])}
    got = moving.leading_developers(skewed)
    assert {(r.repo_id, r.place, r.actor_id, r.events) for r in got.collect()} == expected
    text = plan(moving.leading_developers(stored))
    limits = [i for i in range(len(text)) if text.startswith("WindowGroupLimit", i)]
    assert len(limits) == 2 and limits[0] < text.index("Exchange hashpartitioning") < limits[1]


VERSION = "id long, name string, n int"


@pytest.mark.parametrize("seed", range(3))
def test_differences_applied_give_the_new_version_exactly(spark, seed):
    draw = random.Random(seed)

    def version(size):
        return [(draw.choice((None, *range(8))), draw.choice((None, "a", "b")), draw.choice((None, 1, 2))) for _ in range(size)]

    before, after = version(120), version(150 if seed else 0) + [(1, "copy", 1)] * 500
    old, new = spark.createDataFrame(before, VERSION), spark.createDataFrame(after, VERSION)
    found = difference.difference(old, new, ["id"])
    assert Counter(map(tuple, difference.applied(old, found).collect())) == Counter(after)
    won, lost = Counter(after) - Counter(before), Counter(before) - Counter(after)
    both = {r[0] for r in won} & {r[0] for r in lost}
    expected = {("updated-to" if r[0] in both else "inserted", n, *r) for r, n in won.items()}
    expected |= {("updated-from" if r[0] in both else "deleted", n, *r) for r, n in lost.items()}
    assert set(map(tuple, found.collect())) == expected


def test_no_difference_and_empty_versions(spark):
    some, none = spark.createDataFrame([(1, "a", 1), (1, "a", 1)], VERSION), spark.createDataFrame([], VERSION)
    assert difference.difference(some, some, ["id"]).count() == 0
    assert [tuple(r) for r in difference.difference(some, none, ["id"]).collect()] == [("deleted", 2, 1, "a", 1)]
    assert difference.applied(some, difference.difference(some, none, ["id"])).count() == 0


def walked(edges):
    parent = {}
    for child, p, at in sorted((e for e in edges if None not in e[:2] and e[0] != e[1]), key=lambda e: (e[2], e[1])):
        parent.setdefault(child, p)
    for node in parent.keys() | set(parent.values()):
        at, depth, seen = node, 0, set()
        while at in parent and at not in seen:
            seen.add(at)
            at, depth = parent[at], depth + 1
        yield (node, None, None) if at in parent else (node, at, depth)


def test_fork_trees_with_deep_chains_cycles_and_a_hot_parent(spark, monkeypatch):
    edges = [(n + 1, n, n) for n in range(100, 400)]  # a chain 300 deep
    edges += [(1000 + n, 1, n) for n in range(3000)]  # a third of all rows and more
    edges += [(11, 12, 0), (12, 13, 0), (13, 11, 0), (14, 11, 0), (15, 14, 0)]  # a cycle and what hangs on it
    edges += [(20, 20, 0), (21, None, 0), (None, 22, 0), (30, 31, 5), (30, 32, 4), (30, 33, 4)]
    moments = [(c, p, datetime(2024, 1, 1) + timedelta(minutes=m)) for c, p, m in edges]
    made = spark.createDataFrame(moments, "child long, parent long, forked_at timestamp_ntz")
    rounds, real = [], forks.staged
    monkeypatch.setattr(forks, "staged", lambda df, label: rounds.append(label) or real(df, label))
    got = [tuple(r) for r in forks.fork_trees(made).collect()]
    assert Counter(got) == Counter(walked(moments))
    assert rounds.count("ancestors") <= math.log2(300) + 4
    assert forks.fork_trees(made.limit(0)).count() == 0


def test_rhythms(skewed, stored):  # noqa: F811
    hours = defaultdict(Counter)
    for r in skewed.collect():
        hours[r.actor_id][r.created_at.weekday(), r.created_at.hour] += 1
    for r in rhythm.rhythms(skewed).collect():
        own = hours[r.actor_id]
        shares = [n / sum(own.values()) for n in own.values()]
        assert (r.events, r.hours) == (sum(own.values()), len(own))
        assert abs(r.entropy + sum(p * math.log2(p) for p in shares)) < 1e-9
    text = plan(rhythm.rhythms(stored))
    assert "ArrowAggregatePython" in text or "AggregateInPandas" in text or "ArrowAggregate" in text
    assert rhythm.rhythms(skewed.limit(0)).count() == 0
