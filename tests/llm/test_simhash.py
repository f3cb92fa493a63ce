from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash
from eventloom.llm import simhash
from eventloom.llm.components import components
from eventloom.llm.simhash import fingerprints, near_duplicates, probes


def plain_fingerprint(text, n=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def smallest_reachable(prints: dict[int, int], distance: int) -> dict[int, int]:
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(prints, 2):
        if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in prints}


def test_documents_against_brute_force(documents, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(documents).collect()}
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    assert {d: f for d, (f, _) in got.items()} == prints
    assert {d: c for d, (_, c) in got.items()} == smallest_reachable(prints, 3)


@pytest.mark.parametrize("chunk", [1024, 3])
@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_links_against_brute_force(spark, monkeypatch, chunk, distance):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(distance)
    values = set()
    for centre in (rng.getrandbits(64) for _ in range(25)):
        for _ in range(12):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                value ^= 1 << bit
            values.add(value - (1 << 64) if value >= 1 << 63 else value)
    entries = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    got = {r.node: r.root for r in components(simhash.links(entries, distance)).collect()}
    prints = {v: v for v in values}
    expected = {v: root for v, root in smallest_reachable(prints, distance).items() if v != root}
    assert got == expected


def test_probe_sets_cover_every_choice_of_shared_bytes():
    for distance in range(8):
        for shared in combinations(range(8), 8 - distance):
            assert any(set(probe) <= set(shared) for probe in probes(distance))
    with pytest.raises(ValueError):
        probes(8)


def test_chain_star_and_loop_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (6001, 6000), (6000, 6001)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1400)} | {6001: 6000}
    assert got == expected
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == by_id[3].fingerprint == 0 and by_id[3].component_id == 2
    assert by_id[8].component_id == 1  # case does not count
    assert by_id[None].component_id is None
    assert near_duplicates(none).count() == 0
    assert fingerprints(odd, 2).count() == odd.count()
