from __future__ import annotations

import random
import re

import pytest

from eventloom.llm import decontaminate
from eventloom.llm.decontaminate import matched

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(texts, items, window=10):
    windows = {}
    for item, text in items:
        own = words(text)
        width = min(window, len(own))
        for i in range(len(own) - width + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + width]), set()).add(item)
    out = []
    for doc, text in texts:
        own, hit, found = words(text), set(), set()
        for width in {len(w) for w in windows}:
            for i in range(len(own) - width + 1):
                if of := windows.get(tuple(own[i : i + width])):
                    hit |= set(range(i, i + width))
                    found |= of
        out.append((doc, len(own), len(hit), sorted(map(str, found))))
    return sorted(out, key=repr)


def compare(spark, texts, items, **more):
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts], "doc_id long, text string, row string")
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.items) for r in matched(docs, benchmark, **more).collect()]
    assert sorted(got, key=repr) == brute_force(texts, items, more.get("window", 10))


@pytest.mark.parametrize("most", [1 << 28, 64, 1])
def test_random_texts_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BITS", most)  # few bits let most or all words through
    rng = random.Random(11)
    vocabulary = ["a", "b", "c", "É", "d1", "漢字", "e"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(0, 16))) for i in range(12)]
    texts = [(i, text(rng.randint(0, 60)) + "! " + rng.choice(items)[1].upper() + " " + text(5)) for i in range(60)]
    compare(spark, texts, items)


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_bitmap_holds_every_shingle(spark, n):
    own = [[f"w{i}", f"é{i % 7}", "x"][: 1 + i % 3] for i in range(n)]
    bitmap, bits = decontaminate.bitmap_of(spark.createDataFrame([(s,) for s in own], "shingle array<string>"))
    wanted = {
        int(decontaminate.probed(decontaminate.codes(decontaminate.hashes_of([w.encode() for w in s]), len(s)), i, bits)[0])
        for s in own
        for i in range(decontaminate.PROBES)
    }
    assert {8 * i + j for i, byte in enumerate(bitmap) for j in range(8) if byte >> j & 1} == wanted
    assert bits >= decontaminate.SPARSE * n and bits & (bits - 1) == 0


def test_documents_are_read_once_however_large_the_benchmark(spark, monkeypatch):
    labels = []
    staged = decontaminate.staged
    monkeypatch.setattr(decontaminate, "staged", lambda df, label: labels.append(label) or staged(df, label))
    items = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(3000)]
    compare(spark, [(1, items[7][1]), (2, "clean"), (3, "so " + items[2999][1][9:])], items)
    assert labels.count("stretches") == 1


def test_short_items_overlaps_and_separators(spark):
    items = [(1, "Alpha"), (2, "one two"), (3, "x " * 30), (4, None), (5, "..."), (6, "one two"), (70, "q-r_s`t{u")]
    texts = [
        (1, "ALPHA beta alpha"), (2, "one, two\x01one\x02two"), (3, "x " * 25), (4, None), (5, ""), (6, "q r s t u v"),
        (7, "one two" * 2), (8, "x " * 9), (8, "x " * 9), (8, "alpha"),
    ]
    compare(spark, texts, items)
    compare(spark, texts, items, window=3, shingle=2)


def test_odd_rows_and_empty_tables(spark, odd, none):
    benchmark = spark.createDataFrame([(None, "two three four five six seven eight nine ten eleven")], "item_id long, text string")
    rows = matched(odd, benchmark).collect()
    assert len(rows) == odd.count()
    assert sorted(r.n_hit for r in rows)[-3:] == [10, 10, 10]
    assert {tuple(r.items) for r in rows if r.n_hit} == {("null",)}
    assert matched(none, benchmark).count() == 0
    assert [r.n_hit for r in matched(odd, benchmark.limit(0)).collect()] == [0] * odd.count()
