from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import suffix_dedup
from eventloom.llm.suffix_dedup import LENGTH, deduplicated


def brute_force(texts: dict[int, bytes], length: int) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc in sorted(texts):
        text, covered, last = texts[doc], [], 0
        for i in range(len(text) - length + 1):
            string = text[i : i + length]
            if string in seen:
                if covered and i <= covered[-1][1]:
                    covered[-1][1] = i + length
                else:
                    covered.append([i, i + length])
            seen.add(string)
        kept = b""
        for a, b in covered:
            kept, last = kept + text[last:a], b
        out[doc] = (len(text), covered, kept + text[last:])
    return out


def found(df, length=LENGTH, **more):
    rows = deduplicated(df, length, **more).collect()
    return {r.doc_id: (r.n_bytes, [list(s) for s in r.removed], bytes(r.kept)) for r in rows}


def test_documents_against_brute_force(documents, texts):
    assert found(documents) == brute_force({d: t.encode() for d, t in texts.items()}, LENGTH)


@pytest.mark.parametrize("hot, piece, block", [(512, 1 << 22, 1 << 20), (1, 700, 300), (3, 1 << 22, 500)])
def test_edited_copies_periods_and_small_blocks(spark, monkeypatch, hot, piece, block):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "é", "delta", "\n", "x"]
    base = " ".join(rng.choice(words) for _ in range(400))
    texts = {}
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice("qwz")
        texts[rng.randrange(10**9)] = "".join(copy[rng.randint(0, 300) : rng.randint(500, len(copy))])
    texts |= {1: "a" * 1000, 2: "ab" * 400, 3: "\x00" * 300, 4: "", 5: base[:99], 6: base[:100], 7: "a" * 150 + base}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert found(df) == brute_force({d: t.encode() for d, t in texts.items()}, LENGTH)


@pytest.mark.parametrize("jumps", [64, 1, 0])
@pytest.mark.parametrize("length", [16, 40, 100, 210])
def test_longest_previous_factors_against_brute_force(monkeypatch, length, jumps):
    monkeypatch.setattr(suffix_dedup, "JUMPS", jumps)
    rng = random.Random(length)
    phrase = bytes(rng.choice(b"abc\x00") for _ in range(3 * length))
    text = b"".join(
        rng.choice((phrase[rng.randrange(length) :], b"a" * length, bytes(rng.choices(b"ab\x00\xff", k=50)))) for _ in range(8)
    )
    n = len(text) - length + 1
    places = np.array(rng.sample(range(n), n))
    position = np.array(rng.sample(range(n), n))
    position[:20] = position[20:40]  # repeated rows
    places[:20] = places[20:40]
    got = suffix_dedup.longest_previous_factors(np.frombuffer(text, np.uint8), places, position, length)
    prefixes = [text[p : p + length] for p in places.tolist()]
    least: dict[bytes, int] = {}  # the least position of every prefix of every suffix
    for prefix, at in zip(prefixes, position.tolist()):
        for k in range(1, length + 1):
            least[prefix[:k]] = min(at, least.get(prefix[:k], at))
    for prefix, at, factor in zip(prefixes, position.tolist(), got.tolist()):
        assert factor == max((k for k in range(1, length + 1) if least[prefix[:k]] < at), default=0)


def test_positions_follow_text_order():
    doc, start, count = np.array([[2, 1], [1, 9], [2, 1], [1, 3], [2, 1]]), np.array([5, 0, 0, 7, 5]), np.array([3, 4, 5, 6, 3])
    assert suffix_dedup.text_positions(doc, start, count).tolist() == [15, 6, 10, 0, 15]


def test_other_lengths(documents, texts):
    short = {d: t.encode() for d, t in texts.items()}
    assert found(documents, 40, core=16) == brute_force(short, 40)
    assert found(documents, 210, core=64) == brute_force(short, 210)
    with pytest.raises(ValueError):
        deduplicated(documents, 60)


def test_odd_rows(odd, none):
    rows = deduplicated(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_bytes == by_id[3].n_bytes == 0 and by_id[None].n_bytes == 26
    assert by_id[7].removed[0][1] == 300_003 - 0 or by_id[7].n_bytes == 300_003
    assert [r.removed for r in rows if r.doc_id == 1] == [[], []]
    assert deduplicated(none).count() == 0


@pytest.mark.parametrize("hot, piece, block", [(512, 1 << 22, 1 << 20), (1, 700, 300)])
def test_texts_that_share_an_id_or_have_none_are_told_apart(spark, monkeypatch, hot, piece, block):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(3)

    def clean(n):
        return "".join(rng.choice("abcdefghijkl ") for _ in range(n))

    copy, texts = clean(200), []
    for i in range(40):  # the copy at one place, at others, and in every second text not at all
        middle = chr(33 + i) + copy * (i % 2) + chr(33 + i)  # other bytes around each copy
        texts.append(clean(300) + middle + clean(50 + i) if i < 20 else clean(10 * i) + middle + clean(300))
    for ids in ([None] * 40, [5] * 40, [-(1 << 63)] * 40, [None, -(1 << 63)] * 20):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
        rows = deduplicated(df).collect()
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in rows)
        kept = sorted(bytes(r.kept).decode() for r in rows)
        whole = [text for text in texts if copy in text and text in kept]
        assert len(whole) == 1  # the first of the copies, and clean bytes, stay
        assert kept == sorted(text if text in whole else text.replace(copy, "") for text in texts)


def dealt(batches):
    """The rows in the order in which a task gets them."""
    columns = ("anchor", "whole", "doc_id", "digest", "start")
    table = pa.Table.from_batches(list(batches))
    return table.sort_by([(c, "ascending") for c in columns]).combine_chunks().to_batches()


def marked(texts, marks):
    mark = pa.list_(pa.struct([("place", pa.int64()), ("anchor", pa.int64())]))
    place = lambda start, hot: ((start << suffix_dedup.SUFFIX_BITS | 20) << 1) | hot  # noqa: E731  20 suffixes each
    rows = [[{"place": place(start, hot), "anchor": 5} for start, hot in of] for of in marks]
    ids = pa.array(range(len(texts)), pa.int64())
    columns = [ids, ids, pa.array(texts), pa.array(rows, mark)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "text", "marks"])


def test_strings_of_a_hot_anchor_are_dealt_without_their_bytes():
    rng = random.Random(8)
    phrase = "".join(rng.choices("abcdefgh", k=110))
    texts = ["".join(rng.choices("abcdefgh", k=30)) + phrase + "".join(rng.choices("abcdefgh", k=30)) for _ in range(50)]
    batches = [marked([text], [[(i % 20 + 20, 1)]]) for i, text in enumerate(texts)]  # each in a task of its own
    batches = [b.set_column(0, "doc_id", pa.array([i])) for i, b in enumerate(batches)]
    rows = [b for batch in batches for b in suffix_dedup.fetched([batch], LENGTH, 32)]
    assert sum(b.num_rows for b in rows) == 50 * 20
    assert all(not bytes for b in rows for bytes in b.column("bytes").to_pylist())
    spans = pa.Table.from_batches(suffix_dedup.sorted_out(dealt(rows), LENGTH, 32)).to_pydict()
    starts = sorted((doc, span >> suffix_dedup.SPAN_BITS) for doc, span in zip(spans["doc_id"], spans["span"]))
    seen, expected = set(), []
    for i, text in enumerate(texts):
        for start in range(i % 20 + 20, i % 20 + 40):
            string = text[start : start + LENGTH]
            if string in seen:
                expected.append((i, start))
            seen.add(string)
    assert expected and starts == expected


def test_only_rows_with_a_repeated_string_are_sorted(monkeypatch):
    sorted_suffixes = []
    factors = suffix_dedup.longest_previous_factors
    monkeypatch.setattr(
        suffix_dedup, "longest_previous_factors", lambda o, places, *a: sorted_suffixes.append(len(places)) or factors(o, places, *a)
    )
    rng = random.Random(9)
    short, phrase = ("".join(rng.choices("abcdefgh", k=k)) for k in (60, 103))
    around = lambda k: "".join(rng.choices("ijklmnop", k=k))
    texts = [around(30) + short + around(60) for _ in range(40)] + [around(25) + phrase + around(30) for _ in range(2)]
    batch = marked(texts, [[(15, 0)]] * 42)
    spans = pa.Table.from_batches(suffix_dedup.sorted_out(dealt(suffix_dedup.fetched([batch], LENGTH, 32)), LENGTH, 32)).to_pydict()
    assert [(d, s >> suffix_dedup.SPAN_BITS, s & 0xFFFFFFFF) for d, s in zip(spans["doc_id"], spans["span"])] == [(41, 25, 128)]
    assert sorted_suffixes == [2 * 4]  # of 42 * 20


def test_spans_are_not_gathered_before_they_are_dealt(documents):
    plan = deduplicated(documents)._jdf.queryExecution().executedPlan().toString()
    dealt = [below for above, below in zip(plan.splitlines(), plan.splitlines()[1:]) if "Exchange hashpartitioning(doc_id" in above]
    assert dealt and not any("collect_list" in line for line in dealt)


def test_hashes_of_strings_tell_strings_apart():
    rng = random.Random(10)
    octets = np.array(rng.choices(range(3), k=40_000), np.uint8)
    octets[30_000:] = octets[5_003:15_003]
    hashes = suffix_dedup.all_hashes(octets, 32)
    first, size = np.array(rng.choices(range(39_800), k=20_000)), np.array(rng.choices(range(100, 169), k=20_000))
    names = suffix_dedup.string_hashes(hashes, first, size, 32).tolist()
    strings = [octets[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist())]
    assert len(set(zip(names, strings))) == len(set(names)) == len(set(strings)) < 20_000
