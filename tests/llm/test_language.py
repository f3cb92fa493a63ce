from __future__ import annotations

import tracemalloc
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import language
from eventloom.llm.language import Field, forward_backward, held_out, identified, label_texts, learn
from eventloom.llm.queries import op10_language_id
from tests.conftest import SMALL


def small_field(rng, size):
    zeros = np.zeros((size, size))
    return Field(["a", "b", "c"][:size], {}, zeros, np.zeros((1, size)), zeros, np.zeros(size), rng.normal(size=size), rng.normal(size=(size, size)))


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(2)
    field, lengths = small_field(rng, 3), np.array([2, 4, 1, 3])
    scores = rng.normal(size=(lengths.sum(), 3))
    marginal, pairs = forward_backward(scores, lengths, field)
    expected_pairs, at = np.zeros((3, 3)), 0
    for n in lengths:
        own = scores[at : at + n]
        weights, expected = {}, np.zeros((n, 3))
        for labels in product(range(3), repeat=int(n)):
            score = field.start[labels[0]] + sum(own[i, y] for i, y in enumerate(labels))
            weights[labels] = np.exp(score + sum(field.transition[a, b] for a, b in zip(labels, labels[1:])))
        total = sum(weights.values())
        for labels, w in weights.items():
            for i, y in enumerate(labels):
                expected[i, y] += w / total
            for a, b in zip(labels, labels[1:]):
                expected_pairs[a, b] += w / total
        assert np.allclose(marginal[at : at + n], expected)
        at += n
    assert np.allclose(pairs, expected_pairs)


def test_held_out_accuracy(spark, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    got = op10_language_id(spark, SMALL).collect()
    judged = [r for r in got if r.held_out and truth[r.doc_id] and r.lang_pred != "und"]
    assert len(got) == len(truth) and len(judged) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in judged) >= 0.97 * len(judged)
    assert all(0 <= r.score <= 1 for r in got)


def test_words_of_switching_texts_are_labelled(documents):
    field = learn(documents)
    by_lang = {}
    for r in documents.where("lang in ('de', 'es')").collect():
        by_lang.setdefault(r.lang, []).extend(language.words_in(r.text)[:60])
    words = by_lang["de"][:30] + by_lang["es"][:30]
    marginal, _ = forward_backward(language.emissions(field, words), np.array([60]), field)
    labels = [field.languages[i] for i in marginal.argmax(axis=1)]
    assert sum(a == b for a, b in zip(labels, ["de"] * 30 + ["es"] * 30)) >= 54


def test_odd_rows(odd, none, documents):
    field = learn(documents.where(~held_out(documents.doc_id)))
    rows = identified(odd, field).collect()
    assert identified(odd, field).columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (2, 3, 6))
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 1}) == 1
    assert by_id[1].lang_pred in field.languages
    assert identified(none, field).count() == 0


def test_nothing_or_one_language_to_learn(none, odd):
    assert {r.lang_pred for r in identified(odd, learn(none)).collect()} == {"und"}
    one = learn(odd.where("lang = 'ru'"))
    assert {r.lang_pred for r in identified(odd, one).collect()} == {"ru", "und"}


def test_long_text_equals_its_pieces(documents):
    field = learn(documents)
    text = documents.where("lang = 'fr'").first().text
    (whole,) = label_texts([" ".join([text] * 50)], field)
    assert whole[0] == "fr" and whole[1] > 0.9


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    rows = spark.createDataFrame([(i, "x", str(i)) for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        learn(rows)


def test_repeated_rows_leave_the_sample_of_every_language_alone(spark, documents, monkeypatch):
    samples = []
    monkeypatch.setattr(language, "fit", lambda found, languages, *_: samples.append((found, languages)))
    learn(documents)
    one = documents.where("lang = 'fr'").first()
    copies = spark.range(200_000).select(*(F.lit(one[f.name]).cast(f.dataType).alias(f.name) for f in documents.schema))
    learn(documents.union(copies))
    (once, languages), (again, same) = samples
    assert languages == same and "fr" in languages
    assert sorted(map(repr, once)) == sorted(map(repr, again))
    assert {languages[i] for i, _ in once} == set(languages)


def drawn_field(rng, size):
    draw = lambda *shape: rng.normal(size=shape)
    languages = [f"l{i}" for i in range(size)]
    lexicon, membership = {"der": 0, "und": 1}, (draw(2, size) > 0).astype(float)
    ngrams = draw(len(language.NGRAMS) * language.BUCKETS, size)
    return Field(languages, lexicon, membership, ngrams, draw(size, size), draw(size), draw(size), draw(size, size))


def drawn_words(rng, n):
    return ["".join(rng.choice(list("abcdeéжΣ"), size=rng.integers(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("shape", ["many texts", "one long text", "one long word"])
@pytest.mark.parametrize("size", [4, 40])
def test_memory_of_labelling_does_not_grow_with_the_texts(shape, size):
    rng = np.random.default_rng(3)
    field, words = drawn_field(rng, size), drawn_words(rng, 100_000)
    cut = {"many texts": 300, "one long text": len(words), "one long word": len(words)}[shape]
    texts = [("" if shape == "one long word" else " ").join(words[i : i + cut]) for i in range(0, len(words), cut)]
    del words
    tracemalloc.start()
    labels = label_texts(texts, field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(labels) == len(texts) and all(name in field.languages for name, _ in labels)
    assert peak < 40e6


def test_labels_are_the_same_however_many_words_are_labelled_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    field = drawn_field(rng, 3)
    texts = [None, "", " 12 .", *(" ".join(drawn_words(rng, n)) for n in (1, 63, 64, 65, 700)), "Σ" * 3_000, "der und"]
    texts += texts[::-1]
    whole = label_texts(texts, field)
    monkeypatch.setattr(language, "CELLS", 3 * 2 * language.PIECE)
    monkeypatch.setattr(language, "CUT", 50)
    cut = label_texts(texts, field)
    assert language.at_once(field) == 2 * language.PIECE
    assert [name for name, _ in cut] == [name for name, _ in whole]
    assert np.allclose([score for _, score in cut], [score for _, score in whole])
    assert cut == cut[::-1]


def test_words_are_those_of_the_whole_text_wherever_it_is_cut(monkeypatch):
    text = "Der ΟΔΟΣ's ΣΑΣ, x2y_Z " * 9 + "İstanbul" * 20 + "  " + "…" * 30 + "ende"
    expected = [w for w in language.WORD.findall(text.lower()) if any(map(str.isalpha, w))]
    for cut in (1, 2, 7, 50, 10_000):
        monkeypatch.setattr(language, "CUT", cut)
        assert language.words_in(text) == expected
        assert [w for words in language.stretches(text) for w in words] == expected
    assert language.words_in(None) == language.words_in("") == []
