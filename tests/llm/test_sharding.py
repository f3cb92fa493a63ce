from __future__ import annotations

import struct
from collections import Counter, defaultdict
from math import ceil, floor, sqrt

import pytest
import xxhash
from pyspark.sql import functions as F

from eventloom.llm import sharding


def check_law(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def chained(*values):
    """Spark's xxhash64 of (format, value) pairs; nulls are passed over."""
    h = 42
    for form, value in values:
        if value is not None:
            data = value.encode() if form == "s" else struct.pack("<" + form, value)
            h = xxhash.xxh64_intdigest(data, seed=h)
    return h - (1 << 64) if h >> 63 else h


def plain_draw(g, n, d, u):
    """How many of d rows out of n are among g, by inversion."""
    if g == 0 or d == 0:
        return 0
    mean = d * g / n
    reach = sharding.REACH + sharding.REACH * sqrt(d * g / n * (1 - g / n) * (n - d) / max(n - 1, 1))
    low, high = max(0, d - (n - g), floor(mean - reach)), min(d, g, ceil(mean + reach))
    weights, w = [], 1.0
    for k in range(low, high + 1):
        weights.append(w)
        w *= float(g - k) * (d - k) / ((k + 1.0) * (n - g - d + k + 1))
    total, running, passed = sum(weights), 0.0, 0
    for w in weights:
        running += w
        passed += running <= u * total
    return min(high, low + passed)


def plain_shards(rows, shards, seed, blocks):
    """(row, shard, slot) of (doc_id, text) rows: the whole draw on Python lists."""
    per_shard = max(1, blocks // shards)
    sizes = sharding.cell_sizes(len(rows), shards, per_shard)
    of_block, seen = defaultdict(list), Counter()
    for doc, text in rows:
        content = chained(("q", doc), ("s", text))
        chunk, twin = divmod(seen[doc, content], sharding.COPIES)
        seen[doc, content] += 1
        named = (("q", doc), ("q", content), ("q", chunk))
        of_block[chained(("i", seed), *named) % blocks].append((named, twin + 1, (doc, text)))

    def split(depth, node, members, room):
        if len(members) == 1:
            return [(members[0], room)]
        half = len(members) // 2
        d, n, left = sum(len(of_block[b]) for b in members[:half]), sum(len(of_block[b]) for b in members), []
        for j, size in enumerate(room):
            h = chained(("q", seed), ("i", depth), ("q", node), ("i", j)) % (1 << 64)
            left.append(plain_draw(size, n, d, ((h >> 11) + 0.5) / (1 << 53)))
            d, n = d - left[-1], n - size
        right = [a - b for a, b in zip(room, left)]
        return split(depth + 1, 2 * node, members[:half], left) + split(depth + 1, 2 * node + 1, members[half:], right)

    cells = defaultdict(list)
    for block, sent in split(0, 0, list(range(blocks)), sizes):
        queue = iter(sorted(of_block[block], key=lambda r: chained(("i", seed + 1), *r[0], ("i", r[1]))))
        for cell, n in enumerate(sent):
            cells[cell] += [next(queue) for _ in range(n)]
    out, slots = [], Counter()
    for cell in range(len(sizes)):
        for row in sorted(cells[cell], key=lambda r: chained(("i", seed + 2), *r[0], ("i", r[1]))):
            out.append((*row[2], cell // per_shard, slots[cell // per_shard]))
            slots[cell // per_shard] += 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("copies", [4096, 7])
@pytest.mark.parametrize("shards, seed", [(16, 1), (5, 9)])
def test_draw_is_replayed_in_plain_python(spark, monkeypatch, copies, shards, seed):
    monkeypatch.setattr(sharding, "COPIES", copies)
    rows = [(i % 400, f"text {i}") for i in range(900)] + [(None, f"é {i}") for i in range(500)]
    rows += [(None, None)] * 60 + [(3, "same")] * 45 + [(4, "")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = [tuple(r) for r in sharding.into_shards(docs, shards, seed).collect()]
    assert sorted(got, key=repr) == plain_shards(rows, shards, seed, sharding.LEAST_BLOCKS)


def test_null_ids_and_copies_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 16)
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 > 0, F.lit("one text")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("key"), F.xxhash64("doc_id", "text").alias("content"))
    rows, counts = sharding.in_chunks(held)
    block = F.pmod(F.xxhash64(F.lit(1), "key", "content", "chunk"), F.lit(64)).alias("block")
    placed = {r["block"]: r["count"] for r in rows.groupBy(block).count().collect()}
    assert placed == {r["block"]: r["n"] for r in counts.groupBy(block).agg(F.sum("n").alias("n")).collect()}
    assert sum(placed.values()) == 6000 and max(placed.values()) < 3 * 6000 / 64  # 1000 copies, 2000 null ids
    got = sharding.into_shards(docs)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r.doc_id, r.text) for r in docs.collect())


def test_whole_rows_move_twice(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    plan = sharding.into_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "CartesianProduct" not in plan


@pytest.mark.parametrize("n, shards", [(0, 16), (5, 16), (1000, 16), (997, 7)])
def test_exact_sizes_and_gapless_slots(spark, n, shards):
    got = sharding.into_shards(spark.range(n).withColumnRenamed("id", "doc_id"), shards).collect()
    assert len(got) == n and len({r.doc_id for r in got}) == n
    check_law(got, shards)


def test_draws_follow_the_hypergeometric_distribution(spark):
    from math import comb

    draws = spark.range(40_000).select(
        F.expr(sharding.hypergeometric("7L", "30L", "12L", "(pmod(xxhash64(id), 1000003) + 0.5D) / 1000003", "t")).alias("k")
    )
    seen = Counter(r.k for r in draws.collect())
    for k in range(8):
        chance = comb(7, k) * comb(23, 12 - k) / comb(30, 12)
        assert abs(seen[k] / 40_000 - chance) < 5 * (chance / 40_000) ** 0.5 + 1e-4


def test_matrix_rows_and_columns_add_up(spark):
    counts = spark.createDataFrame([(i, (i * 37) % 50) for i in range(60)], "block long, n long")
    total = sum((i * 37) % 50 for i in range(60))
    sizes = sharding.cell_sizes(total, 16, 4)
    rows = {r.block: r.ends for r in sharding.communication_matrix(counts, 64, sizes, 5).collect()}
    cells = {b: [e - s for s, e in zip([0, *ends], ends)] for b, ends in rows.items()}
    assert all(sum(c) == ((b * 37) % 50 if b < 60 else 0) and min(c) >= 0 for b, c in cells.items())
    assert [sum(column) for column in zip(*cells.values())] == sizes


def test_shuffle_is_uniform_and_repeatable(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    got = sharding.into_shards(docs).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in sharding.into_shards(docs.repartition(3)).collect()}
    first = Counter(r.shard for r in got if r.doc_id < 5000)
    assert all(abs(first[s] - 312.5) < 5 * 312.5**0.5 for s in range(16))
    moved = sum(r.slot for r in got if r.doc_id < 5000) / 5000
    assert abs(moved - 625) < 5 * 361 / 5000**0.5
    other = {(r.doc_id, r.shard, r.slot) for r in sharding.into_shards(docs, seed=2).collect()}
    assert len(other & {(r.doc_id, r.shard, r.slot) for r in got}) < 100


def test_odd_and_repeated_rows(odd, none):
    many = odd.where("doc_id = 1").union(odd).union(odd.where("doc_id is null"))
    got = sharding.into_shards(many.withColumn("slot", F.lit("old")))
    assert got.columns == [*odd.columns, "shard", "slot"]
    rows = got.collect()
    check_law(rows, 16)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in many.collect())
    assert sharding.into_shards(none).count() == 0
