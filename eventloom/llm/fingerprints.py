"""Document fingerprints: I-Match over randomised lexicons.

The lexicon has the terms whose inverse document frequency, ln(documents / documents
with the term), lies in a band. A signature hashes the distinct terms of a text that
are in a subset of the lexicon, in sorted order. One subset is the whole lexicon, as
in plain I-Match; the others are random, LEVELS sizes of them, each a quarter of the
one before and drawn REPEATS times, so that texts of any length have subsets of which
they hold just a few terms. Two texts agree in a signature if they hold the same terms
of its subset; the share of agreements, at the level where it is greatest, is their
likeness.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from eventloom.functions.scratch import staged
from eventloom.llm.text import parts

#: Terms in more than 1 of e^1 documents or fewer than 1 of e^8 are left out. The upper
#: end bounds the lexicon: no more than e^8 times the mean number of distinct terms.
IDF_BAND = (1.0, 8.0)
MOST_TERMS = 4_000_000
LEVELS, REPEATS = 6, 16
SUBSETS = 1 + LEVELS * REPEATS
#: Signatures that must be there before a level's share counts.
ENOUGH = 4
#: Distinct terms that a task counts before it passes its counts on.
COUNTED = 300_000
TERM = re.compile(r"\w+")


def terms_of(text: str | None) -> set[str]:
    return set(TERM.findall(text.lower())) if text else set()


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term and n: the documents that have it, counted in parts."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"]
        )

    for batch in parts(batches, "text"):
        for text in batch.column("text").to_pylist():
            counts.update(terms_of(text))
            if len(counts) > COUNTED:
                yield out()
                counts = Counter()
    yield out()


def subsets_of(hashes: np.ndarray) -> np.ndarray:
    """Which subsets (packed bits) hold terms with these hashes."""
    inside = np.ones((len(hashes), SUBSETS), bool)
    for s in range(1, SUBSETS):
        x = hashes + np.uint64(s * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        level = (s - 1) // REPEATS + 1
        inside[:, s] = ((x ^ (x >> np.uint64(31))) >> np.uint64(64 - 2 * level)) == 0
    return np.packbits(inside, axis=1)


@dataclass
class Lexicon:
    """Terms in sorted order, with their hashes and subsets."""

    terms: list[str]
    hashes: np.ndarray
    subsets: np.ndarray

    def index(self) -> dict[str, int]:
        return dict(zip(self.terms, range(len(self.terms))))


def lexicon_with(terms: list[str]) -> Lexicon:
    terms = sorted(terms)
    hashes = np.fromiter((xxh64_intdigest(t.encode()) for t in terms), np.uint64, len(terms))
    return Lexicon(terms, hashes, subsets_of(hashes))


def signatures(text: str | None, lexicon: Lexicon, index: dict[str, int]) -> np.ndarray:
    """One 16-bit signature for each subset; 0 where the text has none of its terms.

    A text without any term of the lexicon is taken by all of its terms.
    """
    terms = terms_of(text)
    known = np.sort(np.fromiter((index[t] for t in terms if t in index), np.int64))
    if len(known):
        hashes, subsets = lexicon.hashes[known], lexicon.subsets[known]
    elif terms:
        hashes = np.fromiter((xxh64_intdigest(t.encode()) for t in sorted(terms)), np.uint64, len(terms))
        subsets = subsets_of(hashes)
    else:
        return np.zeros(SUBSETS, np.uint16)
    inside = np.unpackbits(subsets, axis=1, count=SUBSETS).T
    listed = hashes[np.nonzero(inside)[1]].tobytes()  # subset by subset, terms in sorted order
    ends = (8 * inside.sum(axis=1, dtype=np.int64).cumsum()).tolist()
    out = np.zeros(SUBSETS, np.uint16)
    for s, (a, b) in enumerate(zip([0, *ends], ends)):
        if b > a:
            out[s] = xxh64_intdigest(listed[a:b]) % 0xFFFF + 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; equal fingerprints have 1."""
    if (a == b).all():
        return 1.0
    some, same = (a != 0) | (b != 0), (a == b) & (a != 0)
    there = some[1:].reshape(LEVELS, REPEATS).sum(axis=1)
    shares = same[1:].reshape(LEVELS, REPEATS).sum(axis=1) / np.maximum(there, 1)
    return float(max(shares[there >= ENOUGH], default=0.0))


def text_of(signed: np.ndarray) -> str:
    return signed.astype(">u2").tobytes().hex()


def lexicon_of(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> Lexicon:
    """The terms of ``docs`` in the band; document frequencies over all documents."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    n = docs.count()
    counts = texts.mapInArrow(counted, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("n"))
    kept = staged(counts.where((idf >= band[0]) & (idf <= band[1])).select("term"), "lexicon")
    if kept.count() > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms in the band; lower its upper end")
    return lexicon_with([row[0] for row in kept.toLocalIterator()])


def in_neighbour_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, cell, guest: partitions of cells, each in descending doc_id.

    Rows that share a doc_id, or have none, stand in order of a hash of their text; an
    id of many rows is cut into cells by that hash. Behind a cell's rows stands, as a
    guest, one row, the first of the next cell, so that every document has its successor
    in its own cell. The last cell's is the first.
    """
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    shares = [i / (4 * width) for i in range(1, 4 * width)]
    found = np.array(own.select(F.percentile_approx(place, shares, 100 * width)).first()[0] or [], np.int64)
    cuts, times = np.unique(found, return_counts=True)  # an id of many rows is a cut several times

    @F.pandas_udf("long")
    def cell_of(ids, marks):
        places, marks = ids.to_numpy(np.int64), marks.to_numpy(np.int64)
        at = np.searchsorted(cuts, places, "left")
        known = np.r_[cuts, 0][at] == places if len(cuts) else np.zeros(len(at), bool)
        parts_of = np.r_[times, 1][at].astype(np.int64)
        high = (marks >> 32) + (1 << 31)  # 0 up to 2^32, in the order of the marks
        part = np.where(known & (at < len(cuts)), high * parts_of >> 32, parts_of)
        part[parts_of == 1] = 0
        return pd.Series((len(cuts) - at) * (4 * width + 1) + part)

    placed = own.withColumns({"place": place, "mark": F.xxhash64("text")})
    placed = placed.withColumns({"cell": cell_of("place", "mark"), "down": F.bitwise_not("place")})
    firsts = placed.groupBy("cell").agg(F.min(F.struct("down", "mark")).alias("first")).orderBy("cell").collect()
    of_next = [(*firsts[(i + 1) % len(firsts)]["first"], row["cell"]) for i, row in enumerate(firsts)]  # one row per cell
    wanted = spark.createDataFrame(of_next, "down long, mark long, cell long")
    columns = ("doc_id", "text", "down", "mark", "cell")
    guests = placed.drop("cell").join(F.broadcast(wanted), ["down", "mark"]).dropDuplicates(["cell"])
    return (
        placed.select(*columns, F.lit(False).alias("guest"))
        .union(guests.select(*columns, F.lit(True)))
        .repartition(width, "cell")
        .sortWithinPartitions("cell", "guest", "down", "mark")
        .select("doc_id", "text", "cell", "guest")
    )


def compared(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per document: doc_id, n_chars, fingerprint, and the same for its edited text.

    The edited text has the last half of the code points (rounded down) replaced by as
    many of the next document, in descending doc_id, the first following the last.
    ``near_edited`` and ``near_next`` are the likeness of the text's fingerprint to the
    edited text's and the next document's.

    A null text is empty, an empty one has the fingerprint of zeros. Null doc_ids come
    last; rows that share a doc_id stand in order of a hash of their text. An empty
    table gives no row. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(lexicon))  # bounded by the band and MOST_TERMS

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(**shared.value)
        index = lexicon.index()
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        last = None
        for batch in parts(batches, "text"):
            rows = []
            for doc_id, text, cell, guest in zip(*(c.to_pylist() for c in batch.columns)):
                own = (doc_id, text or "", cell, guest, signatures(text, lexicon, index))
                if last and last[2] == cell and not last[3]:
                    half = len(last[1]) // 2
                    edited = last[1][: len(last[1]) - half] + own[1][:half]
                    changed = signatures(edited, lexicon, index)
                    rows.append(
                        (last[0], len(last[1]), sha256(edited.encode()).hexdigest(), text_of(last[4]),
                         text_of(changed), likeness(last[4], changed), likeness(last[4], own[4]))
                    )
                last = own
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])

    return in_neighbour_order(docs).mapInArrow(
        work,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def fingerprints(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and fingerprint of every row, without any shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(lexicon))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(**shared.value)
        index = lexicon.index()
        for batch in parts(batches, "text"):
            marks = [text_of(signatures(t, lexicon, index)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.string())], ["doc_id", "fingerprint"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(work, "doc_id long, fingerprint string")
