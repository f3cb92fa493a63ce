"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own vector, if the learning sample knows it, as the mean of the
vectors of its hashed byte n-grams, and with what the labels of the sampled texts that hold
the word or its n-grams say; a text being learned does not count there. Recurrent units read a window of WINDOW words from
both sides; attention weighs their states into one, which gives the window's logit.
Windows overlap by half, cover the whole text, and the worst one speaks for it.

Labels belong to texts, so learning follows the worst window of each sampled text. The
network is fitted on a bounded sample; every text is scored whole, window by window.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from eventloom.llm.language import BUCKETS, NGRAMS, hashed_ngrams
from eventloom.llm.text import parts

WINDOW, STRIDE = 32, 16
WORD_WIDTH, SIGN_WIDTH, EVIDENCE, UNITS, HEADS = 8, 8, 3, 8, 8
WIDTH = WORD_WIDTH + SIGN_WIDTH + EVIDENCE
#: The sample: texts per label (at most), of which those up to SAMPLE_CHARS code points are
#: taken first; of a longer one, so many code points from its beginning.
SAMPLE_TEXTS, SAMPLE_CHARS = 1500, 1000
#: Words of the sample that get a vector: those in this many of its texts, the commonest first.
LEAST_TEXTS, MOST_WORDS = 3, 20_000
STEPS, BATCH, RATE, DECAY = 300, 48, 0.01, 1e-4
#: Share of words whose learned vectors are left out of a step.
DROPPED = 0.5
#: Texts that a word or n-gram is taken to be in beyond those it is in, with labels as usual.
PRIOR = 4.0
#: Windows that are worked off at once.
AT_ONCE = 2048
#: Words a task remembers between batches.
REMEMBERED = 200_000
WORD = re.compile(r"[^\W_]+")
FLOAT = np.float32


def words_in(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return WORD.findall(text.lower()) if text else []


@dataclass
class Network:
    """``words`` number the known words from 1; row 0 of ``word`` is that of all others.

    ``word_says`` and ``sign_says`` are log ratios of label 1 among the texts that hold a word
    or an n-gram, to label 1 among all.
    """

    words: dict[str, int]
    word_says: np.ndarray
    sign_says: np.ndarray
    word: np.ndarray  # words + 1 x WORD_WIDTH
    sign: np.ndarray  # len(NGRAMS) * BUCKETS x SIGN_WIDTH
    enter: np.ndarray  # WIDTH x 2 directions * 3 gates * UNITS
    enter_bias: np.ndarray
    again: np.ndarray  # 2 x UNITS x 3 * UNITS
    attend: np.ndarray  # 2 * UNITS x HEADS
    attend_bias: np.ndarray
    query: np.ndarray  # HEADS
    out: np.ndarray  # 2 * UNITS
    out_bias: np.ndarray  # 1


WEIGHTS = ("word", "sign", "enter", "enter_bias", "again", "attend", "attend_bias", "query", "out", "out_bias")


def fresh(words: dict[str, int], word_says: np.ndarray, sign_says: np.ndarray, seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(FLOAT)

    return Network(
        words, word_says, sign_says,
        drawn(len(words) + 1, WORD_WIDTH, scale=0.1), drawn(len(NGRAMS) * BUCKETS, SIGN_WIDTH, scale=0.1),
        drawn(WIDTH, 6 * UNITS, scale=0.4), np.zeros(6 * UNITS, FLOAT), drawn(2, UNITS, 3 * UNITS, scale=0.3),
        drawn(2 * UNITS, HEADS, scale=0.3), np.zeros(HEADS, FLOAT), drawn(HEADS, scale=0.5),
        drawn(2 * UNITS, scale=0.3), np.full(1, -1, FLOAT),
    )


def says(ones: np.ndarray, all_texts: np.ndarray, share: float) -> np.ndarray:
    """Log ratios of the share of label 1, drawn towards 0 where texts are few."""
    ones, all_texts = np.maximum(ones, 0), np.maximum(all_texts, 0)
    return np.log((ones + PRIOR * share) / (all_texts + PRIOR) / share).astype(FLOAT)


@dataclass
class Inputs:
    """Distinct words as the network takes them in; ``buckets`` has those of all words, one after the other."""

    known: np.ndarray
    buckets: np.ndarray
    counts: np.ndarray
    evidence: np.ndarray
    strength: np.ndarray | float = 1.0  # of the learned vectors; some words do without, in learning

    def of(self, words: np.ndarray) -> Inputs:
        first = np.cumsum(self.counts) - self.counts
        counts = self.counts[words]
        places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return Inputs(self.known[words], self.buckets[np.repeat(first[words], counts) + places], counts, self.evidence[words])


def inputs_of(net: Network, words: list[str]) -> Inputs:
    known = np.fromiter((net.words.get(w, 0) for w in words), np.int64, len(words))
    buckets, counts = ngrams_of(words)
    return Inputs(known, buckets, counts, evidence_of(net.word_says[known], net.sign_says[buckets], counts))


def ngrams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words, one after the other, and how many each has: one or more."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    buckets, owners = hashed_ngrams(words)
    return buckets[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


def evidence_of(word_says: np.ndarray, sign_says: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What the word says, and the mean and the greatest of what its n-grams say."""
    if not len(counts):
        return np.zeros((0, EVIDENCE), FLOAT)
    first = np.cumsum(counts) - counts
    mean = np.add.reduceat(sign_says, first) / counts
    return np.stack((word_says, mean, np.maximum.reduceat(sign_says, first)), axis=1).astype(FLOAT)


def vectors_of(net: Network, own: Inputs) -> np.ndarray:
    if not len(own.known):
        return np.zeros((0, WIDTH), FLOAT)
    signs = np.add.reduceat(net.sign[own.buckets], np.cumsum(own.counts) - own.counts, axis=0)
    learned = np.concatenate((net.word[own.known], signs / own.counts[:, None].astype(FLOAT)), axis=1)
    return np.concatenate((learned * own.strength, own.evidence), axis=1)


def entering(net: Network, vectors: np.ndarray) -> np.ndarray:
    """What each word adds to the gates, for both directions; a last row stands for no word."""
    made = vectors @ net.enter + net.enter_bias
    none = np.zeros((1, 6 * UNITS), FLOAT)
    none[0, :UNITS] = none[0, 3 * UNITS : 4 * UNITS] = 40  # keeps the state
    return np.ascontiguousarray(np.concatenate((made, none)).reshape(-1, 2, 3 * UNITS).transpose(1, 0, 2))


def logistic(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def states_of(net: Network, gates: np.ndarray, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of all words of windows: WINDOW x windows x 2 * UNITS. ``keep`` gets what learning needs."""
    turned = np.ascontiguousarray(ids.T)
    steps, n = turned.shape
    states = np.empty((steps, n, 2 * UNITS), FLOAT)
    h = np.zeros((2, n, UNITS), FLOAT)
    x, again = np.empty((2, n, 3 * UNITS), FLOAT), np.empty((2, n, 3 * UNITS), FLOAT)
    for t in range(steps):
        np.take(gates[0], turned[t], axis=0, out=x[0], mode="clip")
        np.take(gates[1], turned[steps - 1 - t], axis=0, out=x[1], mode="clip")
        np.matmul(h, net.again, out=again)
        both = logistic(x[..., : 2 * UNITS] + again[..., : 2 * UNITS])
        z, r = both[..., :UNITS], both[..., UNITS:]
        new = np.tanh(x[..., 2 * UNITS :] + r * again[..., 2 * UNITS :])
        before, h = h, new + z * (h - new)
        states[t, :, :UNITS], states[steps - 1 - t, :, UNITS:] = h[0], h[1]
        if keep is not None:
            keep.append((before, z, r, new, again[..., 2 * UNITS :].copy()))
    return states


def pooled(net: Network, states: np.ndarray, filled: np.ndarray):
    """Logits of windows, and the parts of attention: what it looked at, weights, sums."""
    seen = np.tanh(states @ net.attend + net.attend_bias)
    score = np.where(filled.T, seen @ net.query, -1e9)
    weight = np.exp(score - score.max(axis=0)) * filled.T
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    whole = np.einsum("tn,tnk->nk", weight, states)
    return whole @ net.out + net.out_bias[0], seen, weight, whole


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins of the windows of texts that stand one after the other, and whose they are.

    A window begins every STRIDE words, and the last one ends with the text; a shorter text,
    also an empty one, has one window.
    """
    counts = 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE))
    owners = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.cumsum(lengths) - lengths
    begins = np.minimum(nth * STRIDE, np.maximum(lengths - WINDOW, 0)[owners])
    return begins + first[owners], owners


def words_at(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray, none: int) -> np.ndarray:
    """Word numbers of windows, ``none`` after the end of a text."""
    at = begins[:, None] + np.arange(WINDOW)
    padded = flat if len(flat) else np.full(1, none)
    return np.where(at < ends[:, None], padded[np.minimum(at, len(padded) - 1)], none)


def logits_of(net: Network, gates: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit, begin and owner of every window of the texts."""
    begins, owners = windows(lengths)
    ends, none = np.cumsum(lengths)[owners], gates.shape[1] - 1
    found = np.empty(len(begins), FLOAT)
    for at in range(0, len(begins), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        ids = words_at(flat, begins[some], ends[some], none)
        found[some] = pooled(net, states_of(net, gates, ids), ids != none)[0]
    return found, begins, owners


def worst(logits: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """The place of the greatest logit of each owner; the first of equals."""
    order = np.lexsort((np.arange(len(logits)), -logits, owners))
    return order[np.searchsorted(owners[order], np.arange(n))]


def summed_rows(rows: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owners, rows[:, j], n) for j in range(rows.shape[1])], axis=1).astype(FLOAT)


def gradients(net: Network, own: Inputs, ids: np.ndarray, truth: np.ndarray) -> tuple[dict, dict]:
    """Of the mean cross-entropy of windows with labels, by backward recurrence through time.

    The second gives those of ``word`` and ``sign`` as rows and their gradients.
    """
    n, steps = ids.shape
    vectors = vectors_of(net, own)
    gates = entering(net, vectors)
    none = gates.shape[1] - 1
    kept: list = []
    states = states_of(net, gates, ids, kept)
    logits, seen, weight, whole = pooled(net, states, ids != none)
    d_logit = (1 / (1 + np.exp(-logits)) - truth) / n
    grad = {"out": whole.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_whole = d_logit[:, None] * net.out
    d_weight = np.einsum("nk,tnk->tn", d_whole, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_seen = d_score[..., None] * net.query * (1 - seen**2)
    grad["query"] = np.einsum("tn,tna->a", d_score, seen)
    grad["attend"] = np.einsum("tnk,tna->ka", states, d_seen)
    grad["attend_bias"] = d_seen.sum(axis=(0, 1))
    d_states = weight[..., None] * d_whole + d_seen @ net.attend.T
    d_gates = np.zeros((steps, 2, n, 3 * UNITS), FLOAT)
    grad["again"] = np.zeros_like(net.again)
    d_h = np.zeros((2, n, UNITS), FLOAT)
    for t in range(steps - 1, -1, -1):
        before, z, r, new, again_new = kept[t]
        d_h[0] += d_states[t, :, :UNITS]
        d_h[1] += d_states[steps - 1 - t, :, UNITS:]
        d_new = d_h * (1 - z) * (1 - new**2)
        d_z = d_h * (before - new) * z * (1 - z)
        d_r = d_new * again_new * r * (1 - r)
        d_again = np.concatenate((d_z, d_r, d_new * r), axis=-1)
        grad["again"] += before.transpose(0, 2, 1) @ d_again
        d_gates[t] = np.concatenate((d_z, d_r, d_new), axis=-1)
        d_h = d_h * z + d_again @ net.again.transpose(0, 2, 1)
    by_word = np.concatenate(
        [
            summed_rows(d_gates[:, d].transpose(1, 0, 2).reshape(-1, 3 * UNITS), (ids if d == 0 else ids[:, ::-1]).ravel(), none + 1)[:-1]
            for d in range(2)
        ],
        axis=1,
    )
    grad["enter"], grad["enter_bias"] = vectors.T @ by_word, by_word.sum(axis=0)
    d_vectors = (by_word @ net.enter.T)[:, : WORD_WIDTH + SIGN_WIDTH] * own.strength
    words, place = np.unique(own.known, return_inverse=True)
    signs, sign_place = np.unique(own.buckets, return_inverse=True)
    d_signs = np.repeat(d_vectors[:, WORD_WIDTH:] / own.counts[:, None], own.counts, axis=0)
    rows = {
        "word": (words, summed_rows(d_vectors[:, :WORD_WIDTH], place, len(words))),
        "sign": (signs, summed_rows(d_signs, sign_place, len(signs))),
    }
    return grad, rows


def held_by(found: list[list[str]], truth: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words in order, how many texts hold each, and how many of label 1."""
    held, ones = Counter(), Counter()
    for words, label in zip(found, truth):
        held.update(set(words))
        if label:
            ones.update(set(words))
    words = sorted(held)
    return words, np.array([held[w] for w in words], np.int64), np.array([ones[w] for w in words], np.int64)


def held_signs(found, truth, words, buckets, counts) -> tuple[np.ndarray, np.ndarray]:
    """How many texts hold each n-gram, and how many of label 1."""
    number, ends = {w: i for i, w in enumerate(words)}, np.cumsum(counts)
    held, ones = np.zeros(len(NGRAMS) * BUCKETS, np.int64), np.zeros(len(NGRAMS) * BUCKETS, np.int64)
    for own, label in zip(found, truth):
        if own:
            spans = [buckets[ends[i] - counts[i] : ends[i]] for i in {number[w] for w in own}]
            distinct = np.unique(np.concatenate(spans))
            held[distinct] += 1
            ones[distinct] += int(label)
    return held, ones


def fit(texts: list[str | None], labels: list[int], seed: int = 1, steps: int = STEPS) -> Network:
    """A network that tells texts of label 1 from others by their worst window.

    Every step draws texts of both labels, finds their worst windows and follows those.
    An empty text is learned as label 0. Without texts of both labels nothing is learned.
    """
    found = [words_in(t) for t in texts] + [[]]
    truth = np.array([*labels, 0], FLOAT)
    sides = [np.flatnonzero(truth == label) for label in (0, 1)]
    words, held, ones = held_by(found, truth)
    share = min(max(len(sides[1]), 1) / len(truth), 0.999)
    buckets, counts = ngrams_of(words)
    sign_held, sign_ones = held_signs(found, truth, words, buckets, counts)
    common = np.sort(np.argsort(-held, kind="stable")[:MOST_WORDS])
    common = common[held[common] >= LEAST_TEXTS]
    net = fresh(
        {words[i]: n + 1 for n, i in enumerate(common)},
        np.concatenate(([0], says(ones[common], held[common], share))).astype(FLOAT), says(sign_ones, sign_held, share), seed,
    )
    if not len(sides[1]) or len(sides[0]) < 2:
        return net
    # words as texts of label 0 and of label 1 see them, each without itself
    known = np.fromiter((net.words.get(w, 0) for w in words), np.int64, len(words))
    seen = [
        evidence_of(says(ones - label, held - 1, share) * (known > 0), says(sign_ones - label, sign_held - 1, share)[buckets], counts)
        for label in (0, 1)
    ]
    inputs = Inputs(np.tile(known, 2), np.tile(buckets, 2), np.tile(counts, 2), np.concatenate(seen))
    number = {w: i for i, w in enumerate(words)}
    coded = [np.array([number[w] for w in own], np.int64) + int(label) * len(words) for own, label in zip(found, truth)]
    rng = np.random.default_rng(seed)
    moments = {name: [np.zeros_like(getattr(net, name)) for _ in range(2)] for name in WEIGHTS}
    for step in range(1, steps + 1):
        picked = np.concatenate([rng.choice(side, min(len(side), BATCH // 2), replace=False) for side in sides])
        read, flat = np.unique(np.concatenate([coded[i] for i in picked]), return_inverse=True)
        lengths = np.array([len(coded[i]) for i in picked])
        own = inputs.of(read)
        logits, begins, owners = logits_of(net, entering(net, vectors_of(net, own)), flat, lengths)
        at = worst(logits, owners, len(picked))
        ids = words_at(flat, begins[at], np.cumsum(lengths), len(read))
        kept, place = np.unique(ids, return_inverse=True)  # the last is the number of no word, if it occurs
        kept = kept[kept < len(read)]
        own = own.of(kept)
        own.strength = ((rng.random((len(kept), 1)) >= DROPPED) / (1 - DROPPED)).astype(FLOAT)
        dense, rows = gradients(net, own, place.reshape(ids.shape), truth[picked])
        rate = RATE * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for name, (some, g) in [*((k, (slice(None), g)) for k, g in dense.items()), *rows.items()]:
            weights, (mean, square) = getattr(net, name), moments[name]
            mean[some] += 0.1 * (g - mean[some])
            square[some] += 0.01 * (g * g - square[some])
            change = (mean[some] / (1 - 0.9**step)) / (np.sqrt(square[some] / (1 - 0.99**step)) + 1e-6)
            weights[some] -= rate * (change + DECAY * weights[some])
    return net


class Scorer:
    """Scores texts; remembers what it computed for words."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.gates = entering(self.net, np.zeros((0, WIDTH), FLOAT))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The worst window's chance of label 1, for each text; an empty text has an empty window."""
        if len(self.number) > REMEMBERED:
            self.forget()
        found = [words_in(t) for t in texts]
        number, known = self.number, len(self.number)
        flat = np.fromiter((number.setdefault(w, len(number)) for words in found for w in words), np.int64)
        if len(number) > known:
            fresh_words = list(number)[known:]
            made = entering(self.net, vectors_of(self.net, inputs_of(self.net, fresh_words)))
            self.gates = np.concatenate((self.gates[:, :known], made), axis=1)
        logits, _, owners = logits_of(self.net, self.gates, flat, np.array([len(w) for w in found], np.int64))
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owners, logits)
        return 1 / (1 + np.exp(-best))


def sampled(docs: DataFrame, labels: DataFrame, column: str, per_label: int, chars: int) -> list[tuple[str, int]]:
    """At most ``per_label`` distinct texts of each label, in a fixed order, with their labels.

    Copies of a text are one, of label 1 if any copy has it. A hash of the text draws.
    """
    known = (
        labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.col(column).cast("int")).alias("label"))
    )
    text = F.col("text").cast("string")
    marked = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    narrow = marked.where("text is not null").groupBy("id", "mark").agg(F.max(F.length("text")).alias("length"))
    texts = narrow.join(known, "id").groupBy("mark").agg(F.max("label").alias("label"), F.max("length").alias("length"))
    drawn: dict[int, int] = {}
    for label in (0, 1):
        order = F.greatest("length", F.lit(chars)), F.xxhash64(F.lit(7), "mark"), F.col("mark")
        drawn |= {r["mark"]: label for r in texts.where(F.col("label") == label).orderBy(*order).limit(per_label).collect()}
    if not drawn:
        return []
    chosen = docs.sparkSession.createDataFrame([(m,) for m in drawn], "mark long")  # at most 2 * per_label rows
    kept = marked.join(F.broadcast(chosen), "mark").groupBy("mark").agg(F.min(F.left("text", F.lit(chars))).alias("text"))
    return [(r["text"], drawn[r["mark"]]) for r in sorted(kept.collect(), key=lambda r: r["mark"])]


def learn(
    docs: DataFrame, labels: DataFrame, column: str = "toxic", per_label: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS
) -> Network:
    """A network from the texts of ``docs`` and ``column`` (0, 1 or null) of ``labels``, by doc_id.

    Rows without id, text or label are left out; of labels that differ the greater holds.
    Without texts of both labels the network has learned nothing and its scores mean nothing.
    """
    sample = sampled(docs, labels, column, per_label, chars)
    return fit([text for text, _ in sample], [label for _, label in sample])


def scored(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; a column of that name is replaced.

    Null and empty texts, and those without letters or digits, get the score of an empty
    window. Every row is scored for itself, by its text alone, so repeated rows get equal
    scores; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(net))  # bounded by MOST_WORDS and BUCKETS
    own = [c for c in docs.columns if c != name]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network(**shared.value))
        for batch in parts(batches, "text", 1 << 21):
            scores = scorer.scores(batch.column("text").to_pylist())
            columns = [*(batch.column(c) for c in own), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*own, name])

    kept = docs.select(*(F.col(f"`{c}`") for c in own))
    return kept.mapInArrow(score, StructType([*kept.schema.fields]).add(name, "double"))


def held_out(doc_id: Column) -> Column:
    """The fixed fifth whose labels learning never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
