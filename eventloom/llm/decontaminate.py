"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Benchmark items are cut into windows of WINDOW words (a shorter item is one window),
windows into shingles. A document holds a window only if it holds all of its
shingles, so one necessary shingle of each window is joined: its rarest in the
documents. The shingle's place in the window and in the text bound where the window
must begin and end; there its words are compared.

Documents are read once, whatever the size of the benchmark. A task keeps the stretches
of words whose shingles may occur in the benchmark at all, by a bitmap of shingle hashes
of at most MOST_BITS bits; rarity, join and verification are DataFrame operations on
those, and drop what the bitmap let through by chance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from eventloom.functions.scratch import staged
from eventloom.llm.text import byte_table, bytes_of, parts

WINDOW, SHINGLE = 10, 5
#: Bits of the bitmap: SPARSE for each of the benchmark's shingles, but no more than
#: MOST_BITS (32 MB). A shingle sets PROBES bits, and all must be set to let a word
#: through: by chance 1 in 70,000, or 1 in 3,000 with ten million shingles.
SPARSE, MOST_BITS, PROBES = 64, 1 << 28, 4
#: Bits of a row that ``bitmap_construct_agg`` gives.
BUCKET_BITS = 1 << 15
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
FACTORS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) ** 5 % (1 << 64) | 1 for i in range(64)], np.uint64)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def row_name(doc_id: Column, text: Column) -> Column:
    """Names a row in every pass over the documents; equal rows have equal results."""
    return F.concat_ws(":", doc_id.cast("string"), F.hex(F.xxhash64(text)), F.length(text))


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id (as text) and the words of each of its windows, without repeats."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        words_of(F.col("text").cast("string")).alias("words"),
    ).where(F.size("words") > 0)
    width = F.least(F.lit(window), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    return (
        items.withColumns({"width": width, "start": F.explode(starts)})
        .select("item_id", F.slice("words", F.col("start"), F.col("width")).alias("words"))
        .distinct()
    )


def shingled(words: Column, size: int) -> Column:
    """The shingles of ``size`` words of an array, each as an array; none if it is shorter."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - size + 1)).otherwise(F.array())
    return F.transform(starts, lambda i: F.slice(words, i, size))


def codes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One number for every ``size`` successive words, from the words' hashes."""
    n = max(len(hashes) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += (hashes[i : i + n] ^ (hashes[i : i + n] >> np.uint64(31))) * FACTORS[i % len(FACTORS)]
    return total ^ (total >> np.uint64(32))


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def probed(numbers: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """The bit that a shingle's number sets as its ``probe``-th."""
    x = numbers * FACTORS[probe + 1]
    return (x ^ (x >> np.uint64(32))) & np.uint64(bits - 1)


def shingle_places(bits: int):
    """A function for ``mapInArrow``: the bits, from 1, of every shingle (array of words)."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = batch.column("shingle").to_pylist()
            numbers = np.array([codes(hashes_of([w.encode() for w in s]), len(s))[0] for s in shingles], np.uint64)
            bit = np.concatenate([probed(numbers, i, bits) for i in range(PROBES)])
            yield pa.RecordBatch.from_arrays([pa.array(bit.astype(np.int64) + 1)], ["bit"])

    return places


def bitmap_of(shingles: DataFrame) -> tuple[bytes, int]:
    """Where hashes of the shingles fall, and the number of bits, a power of two.

    Spark combines the bits; the driver gets at most MOST_BITS of them.
    """
    wanted = min(MOST_BITS, SPARSE * max(1, shingles.count()))
    bits = 1 << (wanted - 1).bit_length()
    bitmap = bytearray(max(bits, BUCKET_BITS) // 8)
    buckets = (
        shingles.mapInArrow(shingle_places(bits), "bit long")
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("set"))
    )
    for row in buckets.collect():  # no more than MOST_BITS / BUCKET_BITS rows of 4 KB
        at = (row["bucket"] - 1) * BUCKET_BITS // 8
        bitmap[at : at + BUCKET_BITS // 8] = row["set"]
    return bytes(bitmap), bits


def stretches(shared: Broadcast, bits: int, sizes: list[int]):
    """A function for ``mapInArrow`` that finds stretches covered by shingles of the bitmap."""

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in parts(batches, "text"):
            data, bounds = bytes_of(batch.column("text"))
            bounds = bounds.tolist()
            texts = [bytes(data[a:b]).translate(SEPARATORS).split() for a, b in zip(bounds[:-1], bounds[1:])]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            words = list(chain.from_iterable(texts))
            ends, text = np.cumsum(lengths), np.repeat(np.arange(len(texts)), lengths)
            hashes = hashes_of(words)
            change = np.zeros(len(words) + 1, np.int64)
            for size in sizes:
                numbers = codes(hashes, size)
                hit = np.arange(len(numbers))
                for i in range(PROBES):  # what passed one probe goes to the next
                    bit = probed(numbers[hit], i, bits)
                    hit = hit[((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1) == 1]
                hit = hit[hit + size <= ends[text[hit]]]
                np.add.at(change, hit, 1)
                np.add.at(change, hit + size, -1)
            covered = np.cumsum(change[:-1]) > 0
            # A stretch begins at its first word or that of its text, and ends likewise.
            fresh = np.diff(text, prepend=-1) != 0
            begins = np.flatnonzero(covered & (fresh | ~np.r_[False, covered[:-1]]))
            stops = np.flatnonzero(covered & (np.r_[fresh[1:], True] | ~np.r_[covered[1:], False])) + 1
            of_text: list[list[dict]] = [[] for _ in texts]
            first_word = ends - lengths
            for t, a, b in zip(text[begins].tolist(), begins.tolist(), stops.tolist()):
                of_text[t].append({"start": a - int(first_word[t]), "words": [w.decode() for w in words[a:b]]})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(lengths), pa.array(of_text, kind)],
                ["row", "doc_id", "n_words", "stretches"],
            )

    return found


def occurrences(found: DataFrame, windows: DataFrame, window: int, shingle: int, sizes: list[int]) -> DataFrame:
    """row, start, width, words: where windows stand within the found stretches.

    ``sizes`` are the lengths of the benchmark's shingles, at most ``shingle`` numbers.
    """
    width = F.least(F.lit(shingle), F.size("words"))
    tokens = windows.select("words").distinct().select(
        "words", width.alias("size"), F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("words") - width + 1), lambda i: F.slice("words", i, width))).alias("offset", "token")
    )
    pieces = found.select("row", F.explode("stretches").alias("s")).select("row", "s.start", "s.words")
    reach = window - 1

    def of_size(size: int) -> DataFrame:
        placed = pieces.select("row", "start", "words", F.posexplode(shingled(F.col("words"), size)).alias("at", "token"))
        begin = F.greatest(F.col("at") - reach, F.lit(0))
        return placed.select(
            "row",
            "token",
            (F.col("start") + F.col("at")).alias("place"),
            (F.col("at") - begin).alias("before"),
            F.slice("words", begin + 1, F.col("at") - begin + size + reach).alias("around"),
        )

    placed = staged(reduce(DataFrame.union, map(of_size, sizes or [shingle])), "shingles")
    rarity = placed.groupBy("token").agg(F.count("*").alias("n"))
    # All shingles of a window are necessary, so a prefix of one is enough: the rarest.
    # A window of which one shingle occurs nowhere occurs nowhere.
    prefixes = staged(
        tokens.join(rarity, "token", "left")
        .groupBy("words")
        .agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "token")).alias("rarest"),
        )
        .where("rarest.n > 0")
        .select("words", "rarest.offset", "rarest.token"),
        "prefixes",
    )
    inside = (F.col("before") >= F.col("offset")) & (
        F.size("around") - F.col("before") >= F.size("words") - F.col("offset")
    )
    same = F.slice("around", F.col("before") - F.col("offset") + 1, F.size("words")) == F.col("words")
    return (
        placed.join(prefixes, "token")
        .where(inside)
        .where(same)
        .select("row", (F.col("place") - F.col("offset")).alias("start"), F.size("words").alias("width"), "words")
    )


def matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document: row, doc_id, n_words, n_hit, items (array of item ids as text, sorted).

    A word is hit if it lies in an occurrence of a window; ``items`` are those with
    windows that occur. Null texts have no words and match nothing; an item without
    words has no window; a null item id is the item ``null``. Repeated rows give a row
    each; a null doc_id is kept; ``row`` is the document's ``row_name``, which tells
    texts that share a doc_id apart. Only doc_id, item_id and text are read. Empty
    tables give no row, or no hits.
    """
    windows = staged(windows_of(benchmark, window), "windows")
    needed = windows.select(
        F.explode(
            F.when(F.size("words") < shingle, F.array("words")).otherwise(shingled(F.col("words"), shingle))
        ).alias("shingle")
    ).distinct()
    needed = staged(needed, "benchmark-shingles")
    sizes = [row[0] for row in needed.select(F.size("shingle")).distinct().collect()]  # at most ``shingle`` numbers
    bitmap, bits = bitmap_of(needed)
    texts = docs.select(
        row_name(F.col("doc_id"), F.col("text")).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    found = staged(
        texts.mapInArrow(
            stretches(docs.sparkSession.sparkContext.broadcast(bitmap), bits, sizes),  # MOST_BITS at most
            "row string, doc_id long, n_words long, stretches array<struct<start:int,words:array<string>>>",
        ),
        "stretches",
    )
    return joined(found, windows, window, shingle, sizes)


def joined(found: DataFrame, windows: DataFrame, window: int, shingle: int, sizes: list[int]) -> DataFrame:
    """Occurrences in the found stretches, counted per document."""
    some = found.where(F.size("stretches") > 0)
    all_hits = staged(occurrences(some, windows, window, shingle, sizes).distinct(), "hits")
    earlier = Window.partitionBy("row").orderBy("start", "width").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("start") + F.col("width")).over(earlier), F.lit(0))
    words_hit = (
        all_hits.select("row", "start", "width")
        .distinct()
        .withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("width") - F.greatest("start", reached)))
        .groupBy("row")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    items = (
        all_hits.select("row", "words")
        .join(windows, "words")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    return (
        found.select("row", "doc_id", "n_words")
        .join(words_hit, "row", "left")
        .join(items, "row", "left")
        .select(
            "row",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
