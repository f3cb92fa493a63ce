from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import toxicity
from eventloom.llm.queries import op11_toxicity

BAD = ("wretch", "vermin", "rotter", "scoundrel")


def text(rng, bad, n):
    words = [rng.choice("bdfgklmnprst") + rng.choice("aeiou") + rng.choice(("n", "ra", "sti", "lo")) for _ in range(n)]
    for _ in range(bad):
        words[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(words)


@pytest.fixture(scope="module")
def net():
    rng = random.Random(1)
    labels = [i % 2 for i in range(240)]
    return toxicity.fit([text(rng, 3 * label, rng.randrange(5, 90)) for label in labels], labels, steps=120)


def test_held_out_accuracy_and_one_bad_word_in_a_long_text(net):
    rng, scorer = random.Random(2), toxicity.Scorer(net)
    labels = [i % 2 for i in range(200)]
    scores = scorer.scores([text(rng, 2 * label, rng.randrange(3, 200)) for label in labels])
    assert np.mean((scores >= 0.5) == np.array(labels)) >= 0.97
    long = [text(rng, 0, 5000)]
    spoiled = long[0].split()
    spoiled[3777] = "vermin"
    clean, bad = scorer.scores([long[0], " ".join(spoiled)])
    assert bad >= 0.5 > clean


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(0)
    words = ["one", "two", "three", "wretch", "x"]
    net = toxicity.fresh({"one": 1, "wretch": 2}, rng.standard_normal(3), rng.standard_normal(len(toxicity.NGRAMS) * toxicity.BUCKETS), 3)
    for name in toxicity.WEIGHTS:
        setattr(net, name, getattr(net, name).astype(float))
    own = toxicity.inputs_of(net, words)
    ids = rng.integers(0, len(words), (4, toxicity.WINDOW))
    ids[1, 5:] = len(words)
    ids[2, 1:] = len(words)
    truth = np.array([1.0, 0, 1, 0])

    def loss():
        gates = toxicity.entering(net, toxicity.vectors_of(net, own))
        logit = toxicity.pooled(net, toxicity.states_of(net, gates, ids), ids != len(words))[0].astype(float)
        return np.mean(np.log1p(np.exp(logit)) - truth * logit)

    dense, rows = toxicity.gradients(net, own, ids, truth)
    for name, (some, g) in {**{k: (slice(None), g) for k, g in dense.items()}, **rows}.items():
        weights, full = getattr(net, name), np.zeros_like(getattr(net, name))
        full[some] = g
        for place in map(tuple, np.argwhere(np.abs(full) > np.abs(full).max() / 2)[:3]):
            kept, step = weights[place], 0.05
            weights[place] = kept + step
            above = loss()
            weights[place] = kept - step
            below = loss()
            weights[place] = kept
            assert abs((above - below) / (2 * step) - full[place]) < 0.1 * abs(full[place]) + 1e-5, name


def test_windows_overlap_by_half_and_cover_every_word():
    lengths = np.array([0, 1, 31, 32, 33, 48, 49, 500])
    begins, owners = toxicity.windows(lengths)
    first = np.cumsum(lengths) - lengths
    for i, n in enumerate(lengths.tolist()):
        own = begins[owners == i] - first[i]
        covered = {w for b in own for w in range(b, min(b + toxicity.WINDOW, n))}
        assert covered == set(range(n)) and (np.diff(own) <= toxicity.STRIDE).all() and (own[-1] + toxicity.WINDOW >= n)


def test_scores_do_not_depend_on_neighbours_or_memory(net, monkeypatch):
    rng = random.Random(3)
    texts = [text(rng, i % 2, 1 + 7 * i) for i in range(30)] + [None, "", "..."]
    together = toxicity.Scorer(net).scores(texts)
    monkeypatch.setattr(toxicity, "REMEMBERED", 10)
    monkeypatch.setattr(toxicity, "AT_ONCE", 3)
    scorer = toxicity.Scorer(net)
    alone = [scorer.scores([t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)
    assert np.allclose(together[-3:], together[-1])


def test_odd_rows_clashing_names_and_no_rows(spark, odd, none, net):
    got = toxicity.scored(odd, net)
    assert got.columns == [*(c for c in odd.columns if c != "score"), "score"] and got.count() == odd.count()
    by_text = {}
    for r in got.collect():
        assert 0 <= r.score <= 1 and abs(by_text.setdefault(r.text or "", r.score) - r.score) < 1e-5
    assert toxicity.scored(none, net).collect() == []


def test_nothing_to_learn(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    for docs, own in ((none, labels), (odd, labels), (odd, labels.limit(0))):
        net = toxicity.learn(docs, own)
        assert toxicity.scored(odd, net).count() == odd.count()


def test_the_sample_is_bounded_and_copies_count_once(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "one text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text")
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit("x").alias("label"), F.lit(1).alias("mark"))
    found = toxicity.sampled(docs, labels.union(labels), "toxic", 100, 20)
    assert len(found) == len({t for t, _ in found}) == 200 and sum(label for _, label in found) == 100


def test_the_query(spark):
    from tests.conftest import SMALL

    got = op11_toxicity(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = got.collect()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == docs.count()
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_accuracy_on_given_labels(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [(r.score, truth[r.doc_id]) for r in op11_toxicity(spark, folder).collect() if r.held_out and r.doc_id in truth]
    ones, zeros = (np.array([s for s, t in rows if t == label]) for label in (1, 0))
    area = np.mean(ones[:, None] > zeros[None, :])
    assert area > 0.93 and np.mean(ones >= 0.5) > 0.85 and np.mean(zeros >= 0.5) < 0.05
