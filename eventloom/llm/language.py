"""Language identification by a linear-chain conditional random field.

Words are labelled with languages, so that code-switched text is labelled word by
word; a text gets the language with the most expected words. Features of a word are
hashed byte n-grams (those that touch an end of the word are its prefixes and
suffixes) and the languages whose lexicon holds it. Weights and transitions are
learned together, by the gradient that forward-backward gives.

Lexicons count the words of all labelled texts. The field is fitted on a bounded
sample of them, spliced into sequences that switch language. Every text is labelled
whole, in pieces of PIECE words; learning uses pieces of the same length. A task labels
so many words at a time that its arrays have about CELLS numbers each, however many texts
it is given and however long they, or their words, are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from eventloom.functions.scratch import staged
from eventloom.llm.text import parts

PIECE = 64
NGRAMS = (2, 3, 4)
BUCKETS = 1 << 14
#: A lexicon has the words that are at least this share of a language's words, so at
#: most 1 / LEXICON_SHARE of them.
LEXICON_SHARE = 1e-4
MOST_LANGUAGES = 200
#: The sample: documents per language (at most), and code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = 240, 1200
#: Steps of the random draw.
DRAWS = 1 << 52
ROUNDS, RATE, DECAY = 40, 0.5, 1e-4
UNDETERMINED = "und"
#: Numbers in an array of a task: words, or letters of distinct words, times languages.
CELLS = 1 << 18
#: Code points of a text that are cut into words at a time.
CUT = 1 << 16
#: Distinct words that a task counts before it passes its counts on.
COUNTED = 200_000
WORD = re.compile(r"[^\W\d_]+")


def stretches(text: str | None) -> Iterator[list[str]]:
    """Words, runs of letters, in lower case: those of CUT code points at a time, on to the end of a word."""
    lowered = text.lower() if text else ""
    end = 0
    while (begin := end) < len(lowered):
        rest = WORD.match(lowered, begin + CUT)
        end = rest.end() if rest else begin + CUT
        yield [w for w in WORD.findall(lowered, begin, end) if w.isalpha() or any(map(str.isalpha, w))]


def words_in(text: str | None) -> list[str]:
    """All words of a text."""
    return [w for words in stretches(text) for w in words]


@dataclass
class Field:
    """A fitted field. ``lexicon`` maps a word to a row of ``membership`` (words x languages)."""

    languages: list[str]
    lexicon: dict[str, int]
    membership: np.ndarray
    ngrams: np.ndarray  # len(NGRAMS) * BUCKETS x languages
    lexical: np.ndarray  # languages x languages
    bias: np.ndarray
    start: np.ndarray
    transition: np.ndarray


def padded(word: str) -> bytes:
    return b"\x02" + word.encode() + b"\x03"


def hashed(octets: np.ndarray, k: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each octet, n the k-th of NGRAMS."""
    m = len(octets) - NGRAMS[k] + 1
    h = np.zeros(m, np.uint32)
    for i in range(NGRAMS[k]):
        h = (h ^ octets[i : i + m]) * np.uint32(0x01000193)
    h ^= h >> np.uint32(15)
    return (h % np.uint32(BUCKETS)).astype(np.int64) + k * BUCKETS


def hashed_ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of padded words, and the number of the word of each."""
    coded = [padded(w) for w in words]
    octets = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    word = np.repeat(np.arange(len(words)), lengths)
    buckets, owners = [], []
    for k, n in enumerate(NGRAMS):
        m = len(octets) - n + 1
        if m <= 0:
            continue
        inside = np.flatnonzero(word[:m] == word[n - 1 :])
        buckets.append(hashed(octets, k)[inside])
        owners.append(word[inside])
    return np.concatenate(buckets), np.concatenate(owners)


def summed(rows: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``rows`` (items x languages) by owner."""
    return np.stack([np.bincount(owners, rows[:, j], n) for j in range(rows.shape[1])], axis=1)


def at_once(field: Field) -> int:
    """Words, or letters of distinct words, that a task works on at a time: whole pieces."""
    return max(1, CELLS // (PIECE * max(1, len(field.languages)))) * PIECE


def ngram_scores(field: Field, words: list[str]) -> np.ndarray:
    """Sums of the weights of each word's n-grams. A word beyond ``at_once`` is summed part by part."""
    most = at_once(field)
    scores = np.zeros((len(words), field.ngrams.shape[1]))
    ends = np.cumsum([len(w) for w in words])
    begin = 0
    while begin < len(words):
        end = int(np.searchsorted(ends, ends[begin] - len(words[begin]) + most, "right"))
        if end > begin:
            buckets, owners = hashed_ngrams(words[begin:end])
            scores[begin:end] = summed(field.ngrams[buckets], owners, end - begin)
        else:
            end, octets = begin + 1, np.frombuffer(padded(words[begin]), np.uint8)
            for k, n in enumerate(NGRAMS):
                for at in range(0, len(octets) - n + 1, most):
                    part = octets[at : at + most + n - 1].astype(np.uint32)
                    scores[begin] += field.ngrams[hashed(part, k)].sum(axis=0)
        begin = end
    return scores


def emissions(field: Field, words: list[str]) -> np.ndarray:
    scores = ngram_scores(field, words) + field.bias
    known = np.fromiter((field.lexicon.get(w, -1) for w in words), np.int64, len(words))
    scores[known >= 0] += field.membership[known[known >= 0]] @ field.lexical
    return scores


def forward_backward(scores: np.ndarray, lengths: np.ndarray, field: Field):
    """Marginals of every word, in the order of ``scores``, and expected transitions.

    ``scores`` holds sequences of ``lengths`` one after the other. All sequences go a
    step at a time; the longer ones, in front, go on.
    """
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    alive = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps + 1)]
    likely = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(field.transition)
    ahead, back = np.empty_like(likely), np.empty_like(likely)
    for t in range(steps):
        at = begins[: alive[t]] + t
        a = np.exp(field.start) * likely[at] if t == 0 else (ahead[at - 1] @ move) * likely[at]
        ahead[at] = a / a.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(move)
    for t in range(steps - 1, -1, -1):
        n, going = alive[t], alive[t + 1] if t + 1 < steps else 0
        at = begins[:n] + t
        b = np.ones((n, likely.shape[1]))
        if going:
            after = likely[at[:going] + 1] * back[at[:going] + 1]
            b[:going] = after @ move.T
            joint = ahead[at[:going]].T @ (after / np.einsum("bi,ij,bj->b", ahead[at[:going]], move, after)[:, None])
            pairs += joint * move
        back[at] = b / b.sum(axis=1, keepdims=True)
    marginal = ahead * back
    return marginal / marginal.sum(axis=1, keepdims=True), pairs


def spliced(samples: list[tuple[int, list[str]]], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """One long code-switched text: runs of 4 to 48 words of the samples, shuffled."""
    runs = []
    for language, words in samples:
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 49))
            runs.append((language, words[at : at + n]))
            at += n
    order = rng.permutation(len(runs))
    words = [w for i in order for w in runs[i][1]]
    return words, np.array([runs[i][0] for i in order for _ in runs[i][1]], np.int64)


def pieces_of(n: int) -> np.ndarray:
    full, rest = divmod(n, PIECE)
    return np.array([PIECE] * full + [rest] * (rest > 0), np.int64)


def fit(samples: list[tuple[int, list[str]]], languages: list[str], lexicon: dict, membership: np.ndarray) -> Field:
    """Weights that maximise the likelihood of spliced samples, by AdaGrad."""
    size = len(languages)
    field = Field(
        languages, lexicon, membership, np.zeros((len(NGRAMS) * BUCKETS, size)), np.zeros((size, size)),
        np.zeros(size), np.zeros(size), np.zeros((size, size)),
    )
    words, labels = spliced(samples, np.random.default_rng(1))
    if size < 2 or not words:
        return field
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    distinct = list(number)
    buckets, owners = hashed_ngrams(distinct)
    known = np.array([lexicon.get(w, -1) for w in distinct])
    lengths = pieces_of(len(words))
    heads = np.cumsum(lengths) - lengths
    truth = np.eye(size)[labels]
    follows = np.setdiff1d(np.arange(1, len(words)), heads)
    seen_moves = np.zeros((size, size))
    np.add.at(seen_moves, (labels[follows - 1], labels[follows]), 1)
    names = ("ngrams", "lexical", "bias", "start", "transition")
    squares = {name: np.full_like(getattr(field, name), 1e-8) for name in names}
    for _ in range(ROUNDS):
        marginal, moves = forward_backward(emissions(field, distinct)[ids], lengths, field)
        error = truth - marginal
        by_word = summed(error, ids, len(distinct))
        gradients = {
            "ngrams": summed(by_word[owners], buckets, len(field.ngrams)),
            "lexical": membership[known[known >= 0]].T @ by_word[known >= 0] if len(membership) else 0 * field.lexical,
            "bias": error.sum(axis=0),
            "start": error[heads].sum(axis=0),
            "transition": seen_moves - moves,
        }
        for name in names:
            step = gradients[name] / len(words) - DECAY * getattr(field, name)
            squares[name] += step**2
            getattr(field, name)[...] += RATE * step / np.sqrt(squares[name])
    return field


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n: the words of all texts, counted in parts."""
    counts: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        langs = [lang for lang, of_lang in counts.items() for _ in of_lang]
        words = [w for of_lang in counts.values() for w in of_lang]
        ns = [n for of_lang in counts.values() for n in of_lang.values()]
        return pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(ns)], ["lang", "word", "n"]) if ns else None

    for batch in parts(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for words in stretches(text):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) > COUNTED:
                    yield out()
                    counts = {}
    if last := out():
        yield last


def learn(labelled: DataFrame, per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Field:
    """A field from ``text`` and ``lang`` of ``labelled``; rows without lang are left out.

    A hash of the text chooses the sample: at most ``per_language`` distinct texts of each
    language, ``chars`` code points from a place that the hash names. How often a row is
    repeated does not matter to the sample.
    """
    rows = labelled.where("lang is not null").select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    sizes = rows.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    languages = [row["lang"] for row in sizes]
    counts = staged(
        rows.select("lang", "text").mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    totals = {row["lang"]: row["n"] for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    enough = F.lit(False)
    for lang, n in totals.items():
        enough = enough | ((F.col("lang") == lang) & (F.col("n") >= n * LEXICON_SHARE))
    lexicon: dict[str, int] = {}
    places = []
    for word, lang in counts.where(enough).select("word", "lang").orderBy("word", "lang").collect():
        places.append((lexicon.setdefault(word, len(lexicon)), languages.index(lang)))
    membership = np.zeros((len(lexicon), len(languages)))
    if places:
        membership[tuple(np.array(places).T)] = 1
    # Copies of a text are one, and each language ranks its own texts, so that neither
    # repeated rows nor a large language can push others out of the sample.
    texts = staged(rows.where("text is not null").select("lang", F.xxhash64("text").alias("mark")).distinct(), "texts")
    draw = F.pmod(F.xxhash64(F.lit(1), "mark"), F.lit(DRAWS))
    few = F.lit(False)  # about 4 * per_language texts of each language, however many it has
    for row in texts.groupBy("lang").count().collect():
        share = min(1.0, 4 * per_language / row["count"])
        few = few | ((F.col("lang") == row["lang"]) & (draw < F.lit(int(share * DRAWS))))
    by_draw = Window.partitionBy("lang").orderBy(draw, "mark")
    nth = texts.where(few).withColumn("nth", F.row_number().over(by_draw))
    chosen = staged(nth.where(F.col("nth") <= 2 * per_language), "sample")
    # at most 2 * per_language rows for each language
    place = 1 + F.pmod(F.xxhash64(F.lit(1), "mark"), F.greatest(F.length("text") - chars, F.lit(1)))
    drawn = (
        rows.withColumn("mark", F.xxhash64("text"))
        .join(F.broadcast(chosen), ["lang", "mark"])
        .groupBy("lang", "nth")
        .agg(F.min(F.substr("text", place.cast("int"), F.lit(chars))).alias("text"))
    )
    taken: Counter = Counter()
    samples = []
    for lang, _, text in sorted(drawn.collect(), key=lambda r: (r["nth"], r["lang"])):
        if taken[lang] < per_language and (words := words_in(text)):
            taken[lang] += 1
            samples.append((languages.index(lang), words))
    return fit(samples, languages, lexicon, membership)


def blocks(texts: list[str | None], most: int) -> Iterator[list[tuple[int, list[str]]]]:
    """Words of all texts with the numbers of the texts, at most ``most`` words at a time.

    A longer text is cut after every ``most`` words, wherever it stands among the others.
    """
    block: list[tuple[int, list[str]]] = []
    size = 0
    for i, text in enumerate(texts):
        held: list[str] = []
        for words in chain(stretches(text), [None]):
            held += words or []
            while len(held) >= most or (words is None and held):
                part, held = held[:most], held[most:]
                if size + len(part) > most:
                    yield block
                    block, size = [], 0
                block.append((i, part))
                size += len(part)
    if block:
        yield block


def label_texts(texts: list[str | None], field: Field) -> list[tuple[str, float]]:
    """Language and score (its share of the expected words) of every text."""
    if not field.languages:
        return [(UNDETERMINED, 0.0)] * len(texts)
    n_words, shares = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(field.languages)))
    for block in blocks(texts, at_once(field)):
        number: dict[str, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for _, words in block for w in words])
        sizes = np.array([len(words) for _, words in block], np.int64)
        lengths = np.concatenate([pieces_of(int(n)) for n in sizes])
        marginal, _ = forward_backward(emissions(field, list(number))[ids], lengths, field)
        owners = np.array([i for i, _ in block])
        np.add.at(n_words, owners, sizes)
        np.add.at(shares, owners, summed(marginal, np.repeat(np.arange(len(block)), sizes), len(block)))
    shares /= np.maximum(n_words, 1)[:, None]
    best = shares.argmax(axis=1)
    return [
        (field.languages[b], float(min(1.0, shares[i, b]))) if n_words[i] else (UNDETERMINED, 0.0)
        for i, b in enumerate(best)
    ]


def identified(
    docs: DataFrame, field: Field, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with language and score under ``names``; columns of these names are replaced.

    ``und`` with score 0 where a text is null or has no letter, or where the field has
    learned no language. Every row is labelled for itself, by its text alone, so
    repeated rows get equal labels; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))  # bounded by languages, BUCKETS and LEXICON_SHARE
    own = [c for c in docs.columns if c not in names]

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(**shared.value)
        for batch in parts(batches, text):
            labels = label_texts(batch.column(text).to_pylist(), field)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in own),
                    pa.array([name for name, _ in labels], pa.string()),
                    pa.array([score for _, score in labels], pa.float64()),
                ],
                [*own, *names],
            )

    kept = docs.select(*(F.col(f"`{c}`") for c in own))
    schema = StructType([*kept.schema.fields]).add(names[0], "string").add(names[1], "double")
    return kept.mapInArrow(label, schema)


def held_out(doc_id: Column) -> Column:
    """The fixed third that learning never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
