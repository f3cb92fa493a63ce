"""SimHash near-duplicates: byte-position inverted index with count filtering.

Fingerprints at ``distance`` or fewer differing bits differ in at most as many of
their 8 bytes, so they share at least 8 - distance positional bytes. Single bytes
make long lists, so the index is on sets of positions: with the 8 positions in two
halves, one half holds at least half of the shared bytes. Pairs that meet in a list
are tallied by shared positional bytes; those that reach the guaranteed minimum are
verified bit by bit.

Equal fingerprints are one entry. A long list is cut into chunks and worked off pair
of chunks by pair of chunks; each task gives only links of a forest of its entries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from eventloom.functions.scratch import staged
from eventloom.llm.components import components
from eventloom.llm.text import byte_table, bytes_of, parts

SHINGLE_WORDS, DISTANCE, SEED = 3, 3, 42
BYTES = 8
#: Entries of a list that one task compares with each other.
CHUNK = 1024
SPACES = byte_table(bytes([0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]))
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 15


def fingerprint(text: bytes, words_in_shingle: int) -> int:
    """The SimHash of a text in lower case with white space as spaces, as a signed long."""
    words = text.split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words_in_shingle, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.fromiter(
        (xxh64_intdigest(line[a:b], SEED) for a, b in spans), np.uint64, len(words) - width + 1
    )
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        octets = hashes[at : at + AT_ONCE].view(np.uint8).reshape(-1, BYTES)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def text_mark(text: Column) -> Column:
    """A number that tells texts under one doc_id apart."""
    return F.xxhash64(text.cast("string"))


def fingerprints(docs: DataFrame, words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_mark and fingerprint (longs) of every row; null texts have no words."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            data, ends = bytes_of(batch.column("text"))
            values = [
                fingerprint(bytes(data[a:b]).translate(SPACES), words_in_shingle)
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_mark"), pa.array(values, pa.int64())],
                ["doc_id", "text_mark", "fingerprint"],
            )

    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_mark(F.col("text")).alias("text_mark"),
        F.col("text").cast("string").alias("text"),
    )
    return wanted.mapInArrow(of_batches, "doc_id long, text_mark long, fingerprint long")


def probes(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which similar fingerprints share at least one."""
    if not 0 <= distance < BYTES:
        raise ValueError("with 8 or more differing bits no byte need be shared")
    in_a_half = -(-(BYTES - distance) // 2)
    halves = (range(BYTES // 2), range(BYTES // 2, BYTES))
    return [subset for half in halves for subset in combinations(half, in_a_half)]


def forest(values: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same values as ``pairs`` (index pairs) do: value, smallest value."""
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        after = label.copy()
        np.minimum.at(after, pairs[:, 0], low)
        np.minimum.at(after, pairs[:, 1], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def similar(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Index pairs (into a and b) with enough shared positional bytes and few enough bits."""
    differing = a[:, None] ^ b[None, :]
    tally = np.zeros(differing.shape, np.uint8)
    for position in range(BYTES):
        tally += ((differing >> np.uint64(8 * position)) & np.uint64(0xFF)) == 0
    pairs = np.argwhere(tally >= BYTES - distance)
    return pairs[np.bitwise_count(differing[pairs[:, 0], pairs[:, 1]]) <= distance]


def compared(batches: Iterable[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links within rows sorted by (key, a, b): chunks a and b of the list ``key``."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, values = rows[:, 3], np.unique(rows[:, 4].view(np.uint64))
        first, second = (rows[own == rows[:, k]][:, 4].view(np.uint64) for k in (1, 2))
        pairs = similar(first, second, distance)
        order = np.stack(
            (np.searchsorted(values, first[pairs[:, 0]]), np.searchsorted(values, second[pairs[:, 1]])), axis=1
        )
        return forest(values, order[order[:, 0] != order[:, 1]])

    def batch_of(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        columns = (np.concatenate(x).view(np.int64) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["u", "v"])

    def finish(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        if found := [links(group) for group in np.split(rows, cuts)]:
            yield batch_of(found)

    names = ("key", "a", "b", "chunk", "fingerprint")
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names], axis=1)
        held.append(rows)
        if (rows[-1, :3] != held[0][0, :3]).any():  # all groups but the last are whole
            rows = np.concatenate(held)
            begun = int(np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))[-1]) + 1
            yield from finish(rows[:begun])
            held = [rows[begun:]]
    if held:
        yield from finish(np.concatenate(held))


def links(entries: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """u and v: links that join the distinct ``fingerprint`` values as all similar pairs do."""
    chosen = probes(distance)

    def list_key(number: int, positions: tuple[int, ...]):
        mask = sum(0xFF << (8 * p) for p in positions)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        return F.xxhash64(F.lit(number), F.col("fingerprint").bitwiseAND(F.lit(signed).cast("long")))

    postings = entries.select(
        "fingerprint", F.explode(F.array(*(list_key(i, p) for i, p in enumerate(chosen)))).alias("key")
    )
    in_list = Window.partitionBy("key")
    cut = (
        postings.withColumn("n", F.count("*").over(in_list))
        .where("n > 1")
        .withColumn("chunk", F.floor((F.row_number().over(in_list.orderBy("fingerprint")) - 1) / CHUNK))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
        .select(
            "key",
            F.least("chunk", "other").alias("a"),
            F.greatest("chunk", "other").alias("b"),
            "chunk",
            "fingerprint",
        )
    )
    spread = cut.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return spread.mapInArrow(lambda batches: compared(batches, distance), "u long, v long")


def near_duplicates(docs: DataFrame, words_in_shingle: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per document: doc_id, text_mark, fingerprint (long), root, component_id (smallest doc_id reachable).

    ``root`` is one fingerprint of the component and names it, also where texts of
    several components share a doc_id or have none.

    Texts without words, null ones included, have fingerprint 0, which is linked like
    any other. Repeated rows get a row each; null doc_ids count as larger than all
    others, and a component of nulls only has a null id. An empty table gives no row.
    Only doc_id and text are read, so other columns can have any name.
    """
    marked = staged(fingerprints(docs, words_in_shingle), "fingerprints")
    entries = staged(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "entries")
    roots = components(links(entries, distance))
    hung = entries.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    hung = staged(hung, "hung")
    named = hung.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = staged(hung.join(named, "root").select("fingerprint", "root", "component_id"), "classes")
    return marked.join(classes, "fingerprint").select("doc_id", "text_mark", "fingerprint", "root", "component_id")


def representatives_of(classes: DataFrame) -> DataFrame:
    """doc_id and text_mark of one text of each component (``root``): that of smallest id, nulls last."""
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_mark"))
    return classes.groupBy("root").agg(least.alias("least")).select("least.doc_id", "least.text_mark")
