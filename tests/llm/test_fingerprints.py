from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from eventloom.llm import fingerprints
from eventloom.llm.fingerprints import IDF_BAND, LEVELS, REPEATS, SUBSETS, compared, lexicon_of, likeness, signatures, terms_of


def plain_lexicon(texts):
    counts = {}
    for text in texts:
        for term in terms_of(text):
            counts[term] = counts.get(term, 0) + 1
    return sorted(t for t, n in counts.items() if IDF_BAND[0] <= math.log(len(texts) / n) <= IDF_BAND[1])


def in_subset(term, s):
    """The definition, on Python numbers."""
    whole = (1 << 64) - 1
    x = xxhash.xxh64_intdigest(term.encode()) + s * 0x9E3779B97F4A7C15 & whole
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & whole
    x = (x ^ x >> 27) * 0x94D049BB133111EB & whole
    return s == 0 or (x ^ x >> 31) >> 64 - 2 * ((s - 1) // REPEATS + 1) == 0


def plain_fingerprint(text, lexicon):
    terms = sorted(terms_of(text))
    terms = [t for t in terms if t in lexicon] or terms
    out = []
    for s in range(SUBSETS):
        own = b"".join(xxhash.xxh64_intdigest(t.encode()).to_bytes(8, "little") for t in terms if in_subset(t, s))
        out.append(f"{xxhash.xxh64_intdigest(own) % 0xFFFF + 1 if own else 0:04x}")
    return "".join(out)


def test_documents_against_brute_force(documents, texts):
    lexicon = set(plain_lexicon(list(texts.values())))
    found = lexicon_of(documents)
    assert set(found.terms) == lexicon
    got = {r.doc_id: r for r in compared(documents, found).collect()}
    order = sorted(texts, reverse=True)
    for doc, following in zip(order, [*order[1:], order[0]]):
        text, after, row = texts[doc], texts[following], got[doc]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert row.fingerprint == plain_fingerprint(text, lexicon)
        assert row.edited_fingerprint == plain_fingerprint(edited, lexicon)
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
    near = [np.mean([getattr(r, name) for r in got.values()]) for name in ("near_edited", "near_next")]
    assert near[0] > near[1] + 0.1


def test_likeness_grows_with_shared_terms():
    lexicon = fingerprints.lexicon_with([f"t{i}" for i in range(2000)])
    index = lexicon.index()
    base = signatures(" ".join(f"t{i}" for i in range(400)), lexicon, index)
    shared = [likeness(base, signatures(" ".join(f"t{i}" for i in range(n, n + 400)), lexicon, index)) for n in (0, 20, 200, 400)]
    assert shared[0] == 1 and shared[1] > 0.7 and shared[1] > shared[2] > shared[3] == 0


def test_order_repeats_and_terms_outside_the_lexicon():
    lexicon = fingerprints.lexicon_with(["a", "b", "c"])
    index = lexicon.index()
    same = [signatures(t, lexicon, index).tolist() for t in ("a b", "B a A b", "b, a zzz")]
    assert same[0] == same[1] == same[2]
    assert signatures("zzz", lexicon, index).any()  # taken by all of its terms
    assert not signatures(None, lexicon, index).any() and not signatures("!?", lexicon, index).any()
    assert likeness(np.zeros(SUBSETS, np.uint16), np.zeros(SUBSETS, np.uint16)) == 1.0
    assert len(same[0]) == 1 + LEVELS * REPEATS


def test_odd_rows(odd, none):
    lexicon = lexicon_of(odd)
    rows = compared(odd, lexicon).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_chars == 0 and by_id[2].fingerprint == by_id[3].fingerprint == "0000" * SUBSETS
    copies = [r for r in rows if r.doc_id == 1]
    assert copies[0].fingerprint == copies[1].fingerprint and {r.near_next for r in copies} >= {1.0}
    # The last in descending order, without an id, is followed by the first.
    after = "ONE TWO three FOUR five six seven eight nine ten eleven twelve."
    text = "a text whose id is missing"
    assert by_id[None].edited_sha256 == sha256((text[:13] + after[:13]).encode()).hexdigest()
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd, lexicon).collect()}
    assert plain == {r.doc_id: r.fingerprint for r in rows}
    assert compared(none, lexicon_of(none)).count() == 0


def test_an_id_of_many_rows_is_cut(spark):
    rows = [(i if i % 3 else None, f"text number {i}") for i in range(1200)] + [(5, f"five {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    placed = fingerprints.in_neighbour_order(docs).collect()
    own, cells = [r for r in placed if not r.guest], {}
    for r in placed:
        cells.setdefault(r.cell, []).append(r)
    assert len(own) == len(rows) and len(placed) == len(rows) + len(cells)  # one guest each
    assert max(map(len, cells.values())) < len(rows) / 8  # without a cut 600 and 400 rows
    order = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "xxhash64(text) AS mark").collect()
    order = sorted(order, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.mark))
    after = {a.text: b.text for a, b in zip(order, [*order[1:], order[0]])}
    for members in cells.values():
        assert [after[r.text] for r in members[:-1]] == [r.text for r in members[1:]] and members[-1].guest


def test_band_is_checked(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "MOST_TERMS", 5)
    with pytest.raises(ValueError):
        lexicon_of(documents)
