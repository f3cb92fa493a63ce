from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import md5

from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from eventloom.llm import mixing


def sized(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_force(rows, weights=(5, 2, 1), most=3, seed=1):
    """(doc_id, source, size, source_size, target, copies) by the definition."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += sized(text)
    sources = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, free = {}, set(sources)
    while free:
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= most * sizes[s]}
        target |= {s: most * sizes[s] for s in over} or {s: weight[s] * level for s in free}
        free = free - over if over else set()
    out = []
    for source in sources:
        own = [(d, sized(t)) for d, t, s in rows if s == source]
        due = min(most, target[source] / sizes[source]) if sizes[source] else 0
        p = due - int(due)
        ranked = []
        twins = Counter()
        for (doc, size), text in zip(own, (t for _, t, s in rows if s == source)):
            mark = 42 if text is None else xxh64_intdigest(text.encode(), 42)
            mark -= (1 << 64) if mark >= 1 << 63 else 0
            name = f"{seed}:{'null' if doc is None else doc}:{mark}:{twins[doc, mark]}"
            u = (int(md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            ranked.append((u / (1 - u) * (1 - p) / p if p else 0, doc is not None, doc or 0, size, mark, twins[doc, mark]))
            twins[doc, mark] += 1
        gap, chosen, after = p * sizes[source], Counter(), 0
        for r in sorted(ranked) if p else ():
            if r[3] <= gap and not after:
                chosen[r], gap = chosen[r] + 1, gap - r[3]
            else:
                after += 1
                if r[3] <= gap:
                    chosen[r], gap = chosen[r] + 1, gap - r[3]
        for (doc, size), r in zip(own, ranked):
            out.append((doc, source, size, sizes[source], target[source], int(due) + (chosen[r] > 0)))
    return out


def rows_of(df):
    return [(r.doc_id, r.source, r.size, r.source_size, r.target, r.copies) for r in df.collect()]


def test_documents_against_brute_force(documents, monkeypatch):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    expected = sorted(brute_force(rows))
    assert sorted(rows_of(mixing.mix(documents))) == expected
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    assert sorted(rows_of(mixing.mix(documents))) == expected


def test_words_are_near_targets_and_rank_follows_odds(spark):
    rows = [(i, "w " * (1 + i % 37), f"s{min(i % 10, 4)}") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(mixing.mix(docs))
    for source in {r[1] for r in got}:
        own = [r for r in got if r[1] == source]
        taken = sum(r[2] * r[5] for r in own)
        assert 0 <= own[0][4] - taken < 5  # of documents of 1 to 37 words
        due = own[0][4] / own[0][3]
        for size in (1, 20, 37):  # every size has the same chance
            copies = [r[5] for r in own if r[2] == size]
            assert abs(sum(copies) / len(copies) - due) < 0.25


def test_boost_makes_chances_unequal(spark):
    rows = [(i, "w w w", "a", 1.0 + 2 * (i % 2)) for i in range(4000)] + [(i, "w w w", "b", 1.0) for i in range(4000, 8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    got = {r.doc_id: r.copies for r in mixing.mix(docs, weights=(1, 3), boost=F.col("quality")).collect()}
    low, high = (sum(got[i] for i in range(first, 4000, 2)) / 2000 for first in (0, 1))
    assert abs(low - 0.25) < 0.03 and abs(high - 0.75) < 0.03


def test_mixture_repeats_rows_and_keeps_columns(odd, none):
    counts = Counter()
    for r in mixing.mix(odd).collect():
        counts[r.doc_id] += r.copies
    mixture = mixing.mixed(odd)
    assert mixture.columns == odd.columns
    assert Counter(r.doc_id for r in mixture.collect()) == +counts
    assert mixing.mix(none).count() == mixing.mixed(none).count() == 0


def test_odd_rows_have_results(odd):
    got = rows_of(mixing.mix(odd))
    assert len(got) == odd.count()
    assert [r for r in got if r[0] == 2] == [(2, None, 0, 0, 0.0, got[[g[0] for g in got].index(2)][5])]
    assert sorted(got, key=repr) == sorted(rows_of(mixing.mix(odd)), key=repr)


def test_gap_of_one_dominant_document_is_filled(spark, monkeypatch):
    long, weights = 30_000, (1, 3)  # "s" has 60,000 words at p = 0.5
    rows = [(0, "w " * long, "s"), *((i, "w " * (1 + i % 19), "s") for i in range(1, 3001)), (4000, "w " * 60_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed, bucket, ahead in ((5, 1024, 64), (1, 16, 2)):
        monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
        monkeypatch.setattr(mixing, "PASS_ROWS", ahead)
        all_rows = rows_of(mixing.mix(docs, weights, seed=seed))
        assert sorted(all_rows) == sorted(brute_force([(d, t, s) for d, t, s in rows], weights, seed=seed))
        got = [r for r in all_rows if r[1] == "s"]
        lacking = got[0][4] - sum(r[2] * r[5] for r in got)
        assert 0 <= lacking < min(r[2] for r in got if r[5] < 1)


def test_repeated_rows_and_rows_without_ids_take_what_the_target_says(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    monkeypatch.setattr(mixing, "CHUNK", 30)
    rows = [(1, "w " * 10, "s")] * 1000 + [(None, f"w{i} " * 7, "t") for i in range(400)] + [(None, "w w", "t")] * 300
    rows += [(i, "w " * 20_000, "u") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(mixing.mix(docs, (1, 1, 16)))
    assert Counter(got) == Counter(brute_force(rows, (1, 1, 16)))
    mixture = Counter(r.text for r in mixing.mixed(docs, (1, 1, 16)).collect())
    for source in "st":
        own = [r for r in got if r[1] == source]
        taken = sum(r[2] * r[5] for r in own)
        assert own[0][4] - 10 < taken <= own[0][4]
        texts = {t for _, t, s in rows if s == source}
        assert sum(n * sized(t) for t, n in mixture.items() if t in texts) == taken
