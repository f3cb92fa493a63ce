"""Suffix-array dedup: later copies of byte strings go, the first stays.

A byte is removed when a string of LENGTH bytes over it also starts earlier. With the
longest previous factor (LPF) of every suffix that is: the LENGTH bytes from each
suffix whose LPF is LENGTH or more. An LPF is the longer of the common prefixes with
the previous and the next smaller text position in suffix order.

One suffix array of everything is not needed for that. Strings of LENGTH bytes hold an
anchor, the least of the hashes of their CORE-byte substrings, and equal strings
have equal anchors at equal places. So:

1. Texts are cut into segments: neighbouring suffixes of one anchor. Segments are
   dealt by anchor. Of equal segments all but the first are removed at once, copies
   within a task before the shuffle.
2. Segments that share an anchor but differ hold the ends of repeats. Only their bytes
   are fetched, and only there suffixes are sorted: by anchor, in blocks of whole
   groups, to the depth of LENGTH, by tripling ranks. Previous and next smaller
   positions in that order give the LPF; suffixes of other blocks share less than
   LENGTH bytes with those here, so an LPF of LENGTH is found whatever the blocks.
   Rows of a block that share no string of LENGTH bytes with another place (told by
   hashes of their strings) cannot reach that LPF and are left out before sorting.
3. The strings from suffixes with an LPF of LENGTH are merged per document and cut out.

A text is named by its doc_id and a hash of itself (``NAME``), which tells texts that
share a doc_id, or have none, apart; places are in the order of name, then byte.

An anchor that a great many different segments share (a common phrase) is dealt by
string instead of by anchor, so no task gets a group that grows with the corpus. Such
a string is dealt as 128 bits of hash without its bytes, and told apart like a segment
of one suffix: equal strings are one place in suffix order, of their least position,
and the others of them have an LPF of LENGTH.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from eventloom.functions.scratch import staged
from eventloom.llm.text import bytes_of, parts

LENGTH, CORE = 100, 32
#: Different segments of one anchor above which they are dealt by string.
HOT = 512
#: Bytes that a task anchors, or sorts suffixes of, at once; ranks take 21 bits.
PIECE, BLOCK = 1 << 22, 1 << 20
#: Places hashed at once, few enough to stay in a processor's cache.
CHUNK = 1 << 14
PLACE_BITS = 24
#: A place holds a start and, in its low bits, a number of suffixes; a span a start and an end.
SUFFIX_BITS, SPAN_BITS = 8, 32
#: Steps in which all places look for smaller positions together.
JUMPS = 64
REPEATED, OPEN, STRING = 1, 2, 3
NO_ID = -(1 << 63)
#: The columns that name a text; ``digest`` is a hash of the text and of whether it has an id.
NAME = ("doc_id", "digest")


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def core_hashes(octets: np.ndarray, core: int, seed: int = 1) -> np.ndarray:
    """A hash of the ``core`` bytes from each place; ``core`` is a power of two."""
    width, h = 1, octets.astype(np.uint64)
    if core >= 8:
        width, h = 8, np.ndarray(len(octets) - 7, "<u8", octets, strides=(1,)).astype(np.uint64)
    h = mixed(h + np.uint64(seed))
    while width < core:
        h = mixed(h[:-width] * np.uint64(0xD6E8FEB86659FD93) + (h[width:] ^ (h[width:] >> np.uint64(32))))
        width *= 2
    return h


def all_hashes(octets: np.ndarray, core: int, seed: int = 1) -> np.ndarray:
    """``core_hashes``, a chunk at a time."""
    hashes = np.empty(max(len(octets) - core + 1, 0), np.uint64)
    for i in range(0, len(hashes), CHUNK):
        hashes[i : i + CHUNK] = core_hashes(octets[i : i + CHUNK + core - 1], core, seed)
    return hashes


def string_hashes(hashes: np.ndarray, first: np.ndarray, size: np.ndarray, core: int) -> np.ndarray:
    """Hashes of the ``size`` bytes (``core`` at least) from ``first``, of the hashes of their cores."""
    h, last = mixed(size.astype(np.uint64)), first + size - core
    for at in range(0, int(size.max(initial=0)), core):
        h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + hashes[np.minimum(first + at, last)])
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def segments(octets: np.ndarray, ends: np.ndarray, length: int, core: int):
    """Segments of texts that lie one after the other and end at ``ends``.

    Arrays: place of the first suffix, number of suffixes, anchor hash, anchor's place
    from the first suffix, number of the text, hash of the bytes. Suffixes shorter than
    ``length`` have none.
    """
    places = len(octets) - length + 1
    if places < 1:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    hashes, anchor = np.empty(len(octets) - core + 1, np.uint64), np.empty(places, np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    for i in range(0, places, CHUNK):
        end = min(i + CHUNK, places)
        h = core_hashes(octets[i : end + length - 1], core)
        hashes[i : i + len(h)] = h
        by_place = (h & ~low) | np.arange(i, i + len(h), dtype=np.uint64)  # leftmost of equals
        anchor[i:end] = sliding_least(by_place, length - core + 1) & low
    new = np.r_[True, anchor[1:] != anchor[:-1]]
    begins = np.r_[0, ends[:-1]]
    edges = np.r_[begins, np.maximum(begins, ends - length + 1)]  # of suffixes that are too short
    new[edges[edges < places]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, places])
    text = np.searchsorted(ends, first, "right")
    enough = first + length <= ends[text]
    first, count, text = first[enough], count[enough], text[enough]
    at = anchor[first]
    return first, count, hashes[at], at - first, text, string_hashes(hashes, first, count + length - 1, core)


def arrow(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def pieces(batches: Iterable[pa.RecordBatch], length: int):
    """Names, bytes, ends and offsets of texts, at most about PIECE bytes at once.

    A longer text comes in pieces that overlap by ``length`` - 1 bytes; an offset is
    the place of a piece in its text.
    """
    for batch in parts(batches, "text", PIECE):
        data, bounds = bytes_of(batch.column("text"))
        names = np.stack([batch.column(n).to_numpy() for n in NAME], axis=1)
        if batch.num_rows > 1 or bounds[-1] - bounds[0] <= PIECE + length:
            yield names, data[bounds[0] : bounds[-1]], bounds[1:] - bounds[0], np.zeros(len(names), np.int64)
            continue
        for at in range(0, int(bounds[1] - bounds[0]), PIECE):
            piece = data[bounds[0] + at : min(bounds[0] + at + PIECE + length - 1, bounds[1])]
            yield names, piece, np.array([len(piece)]), np.array([at])


def name_ranks(names: np.ndarray) -> np.ndarray:
    """Numbers in the order of names, equal for equal ones."""
    order = np.lexsort((names[:, 1], names[:, 0]))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.cumsum(np.r_[False, (np.diff(names[order], axis=0) != 0).any(axis=1)])
    return rank


def later_copies(key: np.ndarray, check: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the strings named by (key, check) lie at an earlier place too; ``text`` is in text order.

    The first of equals and those at its own place (a repeated row) are not copies.
    """
    copy = np.zeros(len(key), bool)
    order = np.argsort(key + mixed(check))
    new = np.r_[True, (np.diff(key[order]) != 0) | (np.diff(check[order]) != 0)]
    run = np.cumsum(new) - 1
    many = np.flatnonzero(np.bincount(run)[run] > 1)
    if len(many):
        few, run = order[many], run[many]
        few = few[np.lexsort((start[few], text[few], run))]  # runs stay where they are
        heads = np.flatnonzero(np.r_[True, np.diff(run) != 0])
        head = np.repeat(few[heads], np.diff(np.r_[heads, len(few)]))
        copy[few] = (text[few] != text[head]) | (start[few] != start[head])
    return copy


def anchored(batches: Iterable[pa.RecordBatch], length: int, core: int) -> Iterator[pa.RecordBatch]:
    """Segments as rows; those that repeat an earlier one of the same piece have a place below 0."""
    for names, data, ends, offsets in pieces(batches, length):
        first, count, anchor, lead, text, whole = segments(np.frombuffer(data, np.uint8), ends, length, core)
        if not len(first):
            continue
        whole = mixed(whole + lead.astype(np.uint64))
        doc, start = names[text], first - (ends[text] - np.diff(ends, prepend=0)[text]) + offsets[text]
        copy = later_copies(anchor, whole, name_ranks(names)[text], start)
        place = (start << SUFFIX_BITS) | count
        yield arrow(
            anchor=signed(np.where(copy, mixed(whole ^ mixed((doc.sum(axis=1) + start).view(np.uint64))), anchor)),  # copies anywhere
            whole=signed(whole),
            doc_id=doc[:, 0],
            digest=doc[:, 1],
            place=np.where(copy, -place, place),
        )


def apart(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (anchor, whole, doc_id, digest, place): later copies, and the first of each."""
    new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
    head = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
    return rows[~new & (rows[:, 2:] != head[:, 2:]).any(axis=1)], rows[new]


def told_apart(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, whole, doc_id, digest, place): spans of copies, and places of firsts with a rival.

    What is held between batches is one row, however many share an anchor.
    """
    held = np.empty((0, 5), np.int64)
    rivalled = False  # whether the held first has been given out already
    for batch in batches:
        rows = np.stack([batch.column(n).to_numpy() for n in ("anchor", "whole", *NAME, "place")], axis=1)
        copy = rows[:, 4] < 0
        gone = rows[copy] * np.array([1, 1, 1, 1, -1])
        rows = np.concatenate((held, rows[~copy]))
        if not len(rows):
            yield given(gone, rows, length)
            continue
        later, firsts = apart(rows)
        shared = firsts[1:, 0] == firsts[:-1, 0]
        rival = np.r_[False, shared] | np.r_[shared, False]
        rival[0] |= rivalled and len(held) > 0
        out = rival.copy()
        if rivalled and len(held):
            out[0] = False
        held, rivalled = firsts[-1:], bool(rival[-1])
        yield given(np.concatenate((gone, later)), firsts[out], length)


def given(gone: np.ndarray, rivals: np.ndarray, length: int) -> pa.RecordBatch:
    start, suffixes = gone[:, 4] >> SUFFIX_BITS, gone[:, 4] & ((1 << SUFFIX_BITS) - 1)
    rows = np.concatenate((gone, rivals))
    return arrow(
        kind=np.repeat(np.array([REPEATED, OPEN], np.int32), (len(gone), len(rivals))),
        anchor=np.r_[np.zeros(len(gone), np.int64), rivals[:, 0]],
        doc_id=rows[:, 2],
        digest=rows[:, 3],
        place=np.r_[spanned(start, start + suffixes - 1 + length), rivals[:, 4]],
    )


def spanned(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (start << SPAN_BITS) | end


def fetched(batches: Iterable[pa.RecordBatch], length: int, core: int) -> Iterator[pa.RecordBatch]:
    """The bytes of a document's open segments; of hot anchors the hashes of each string."""
    for batch in parts(batches, "text", PIECE):
        data, bounds = bytes_of(batch.column("text"))
        names = np.stack([batch.column(n).to_numpy() for n in NAME], axis=1)
        marks = batch.column("marks")
        text = np.repeat(np.arange(len(names)), marks.value_lengths().to_numpy(zero_copy_only=False))
        place, anchor = (marks.flatten().field(n).to_numpy() for n in ("place", "anchor"))
        hot, place = (place & 1).astype(bool), place >> 1
        start, suffixes = place >> SUFFIX_BITS, place & ((1 << SUFFIX_BITS) - 1)
        at = bounds[text] + start
        strings = [bytes(data[a:b]) for a, b in zip(at.tolist(), (at + suffixes + length - 1).tolist())]
        if not hot.all():
            cold = np.flatnonzero(~hot)
            yield of_kind(OPEN, anchor[cold], 0, names[text[cold]], start[cold], suffixes[cold], [strings[i] for i in cold.tolist()])
        if not hot.any():
            continue
        (of,) = np.nonzero(hot)
        octets = np.frombuffer(b"".join(strings[i] for i in of.tolist()), np.uint8)
        sizes, n = suffixes[of] + length - 1, suffixes[of]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first, size = np.repeat(np.cumsum(sizes) - sizes, n) + nth, np.full(len(nth), length)
        key, check = (string_hashes(all_hashes(octets, core, seed), first, size, core) for seed in (1, 0x5851F42D4C957F2D))
        row, begin = np.repeat(text[of], n), np.repeat(start[of], n) + nth
        rank = name_ranks(names)[row]
        copy = later_copies(key, check, rank, begin)  # of equal strings in this piece only the first goes on
        doc, one = names[row], np.ones(len(row), np.int64)
        yield of_kind(STRING, signed(key[~copy]), signed(check[~copy]), doc[~copy], begin[~copy], one[~copy], None)
        if copy.any():  # neighbours in a text as one row, dealt evenly
            doc, rank, begin = doc[copy], rank[copy], begin[copy]
            order = np.lexsort((begin, rank))
            doc, rank, begin = doc[order], rank[order], begin[order]
            new = np.flatnonzero(np.r_[True, (np.diff(rank) != 0) | (np.diff(begin) > 1)])
            end = begin[np.r_[new[1:] - 1, len(begin) - 1]] + 1
            doc, begin = doc[new], begin[new]
            spread = mixed(doc.sum(axis=1).view(np.uint64) + mixed(begin.astype(np.uint64)))
            yield of_kind(REPEATED, signed(spread), 0, doc, begin, end - begin, None)


def of_kind(kind: int, anchor: np.ndarray, whole, doc: np.ndarray, start: np.ndarray, suffixes: np.ndarray, text) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(anchor), kind, np.int32)),
            pa.array(anchor),
            pa.array(np.full(len(anchor), whole, np.int64)),
            *(pa.array(part) for part in doc.T),
            pa.array(start),
            pa.array(suffixes.astype(np.int32)),
            pa.array(text or [None] * len(anchor), pa.binary()),
        ],
        ["kind", "anchor", "whole", *NAME, "start", "suffixes", "bytes"],
    )


def ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    new = np.empty(len(keys), np.uint64)
    new[order] = np.cumsum(np.r_[False, np.diff(keys[order]) != 0])
    return new


def common_prefixes(levels: list, words: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, at most ``length``.

    ``levels`` are (depth, ranks), each three times as deep as the one before, so two
    steps of a depth are enough; the last bytes are counted in one word of eight.
    """
    shared = np.zeros(len(a), np.int64)
    for depth, rank in reversed(levels):
        for _ in range(2):
            same = (shared < length) & (rank[a + shared] == rank[b + shared])
            shared += depth * same
    differ = words[a + np.minimum(shared, length)] ^ words[b + np.minimum(shared, length)]
    for n in range(1, 8):
        shared += (differ >> np.uint64(64 - 8 * n)) == 0
    return np.minimum(shared, length)


def with_previous_smaller(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Bytes shared with the previous smaller position in suffix order, 0 without one.

    ``common`` is shared with the place before. A place that looks at one of greater
    position looks on to where that one looks, all places at once; the few that still
    look after JUMPS steps finish in one sweep from the front, where what lies before
    them is settled, as on a stack.
    """
    at, shared = np.arange(len(position)) - 1, common.copy()
    looking = np.arange(1, len(position))
    looking = looking[position[looking - 1] >= position[looking]]
    for _ in range(JUMPS):
        if not len(looking):
            break
        seen = at[looking]
        shared[looking] = np.minimum(shared[looking], shared[seen])
        at[looking] = at[seen]
        looking = looking[at[looking] >= 0]
        looking = looking[position[at[looking]] >= position[looking]]
    for i in looking.tolist():
        while at[i] >= 0 and position[at[i]] >= position[i]:
            shared[i] = min(shared[i], shared[at[i]])
            at[i] = at[at[i]]
    return np.where(at >= 0, shared, 0)


def longest_previous_factors(octets: np.ndarray, places: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """How many bytes, at most ``length``, each suffix shares with one of smaller text position.

    Suffixes (at ``places`` of ``octets``) are sorted to the depth of ``length``: ranks at
    a depth of 8 bytes are tripled to 24 and 72, and two or three of the last overlap to
    ``length``. The factor is the longer of the common prefixes with the previous and the
    next smaller position in that order. Suffixes that are equal to that depth are one
    place, of their least position; the others of them have a factor of ``length``.
    """
    depth, wide = 8, np.concatenate((octets, np.zeros(3 * length, np.uint8))).astype(np.uint64)
    words = np.zeros(len(wide) - depth, np.uint64)
    for i in range(depth):
        words = (words << np.uint64(8)) | wide[i : i + len(words)]
    rank = ranks(words)
    levels = [(depth, rank)]
    while 3 * depth <= length:
        rank = ranks((rank[: -2 * depth] << np.uint64(42)) | (rank[depth:-depth] << np.uint64(21)) | rank[2 * depth :])
        depth *= 3
        levels.append((depth, rank))
    keys = (rank[places] << np.uint64(42)) | rank[places + (length - depth)]
    if 2 * depth < length:
        keys |= rank[places + (length - depth) // 2] << np.uint64(21)
    order = np.argsort(keys, kind="stable")
    new = np.r_[True, np.diff(keys[order]) != 0]
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(position[order], heads)
    first = places[order[heads]]
    common = np.r_[0, common_prefixes(levels, words, first[:-1], first[1:], length)]
    before = with_previous_smaller(least, common)
    after = with_previous_smaller(least[::-1], np.r_[0, common[:0:-1]])[::-1]
    run = np.cumsum(new) - 1
    factors = np.empty(len(places), np.int64)
    factors[order] = np.where(position[order] > least[run], length, np.maximum(before, after)[run])
    return factors


def text_positions(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Numbers in text order for rows of ``count`` successive suffixes; equal for repeated rows."""
    order = np.lexsort((start, doc[:, 1], doc[:, 0]))
    new = np.r_[True, (np.diff(doc[order], axis=0) != 0).any(axis=1) | (np.diff(start[order]) != 0)]
    taken = np.where(new, count[order], 0)
    first = np.empty(len(order), np.int64)
    first[order] = (np.cumsum(taken) - taken)[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return first


def repeated_strings(names: np.ndarray, row: np.ndarray, nth: np.ndarray):
    """Rows that hold a string which occurs twice, by its hash, and the first and last of such strings in each."""
    order = np.argsort(names)
    same = np.diff(names[order]) == 0
    twice = np.zeros(len(names), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    (found,) = np.nonzero(twice)
    new = np.flatnonzero(np.diff(row[found], prepend=-1))
    last = np.r_[new[1:], len(found)][: len(new)] - 1
    return row[found[new]], nth[found[new]], nth[found[last]]


def sorted_out(batches: Iterable[pa.RecordBatch], length: int, core: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings among rows sorted by (anchor, whole, doc_id, digest, start), block by block."""

    def spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        return arrow(doc_id=doc[:, 0], digest=doc[:, 1], span=spanned(start, end))

    def numbers(block: pa.RecordBatch, *columns: str) -> np.ndarray:
        return np.stack([block.column(n).to_numpy().astype(np.int64) for n in columns], axis=1)

    def work(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches(rows).combine_chunks()
        doc, (start, count) = numbers(block, *NAME), numbers(block, "start", "suffixes").T
        data = b"".join(block.column("bytes").to_pylist())
        at = np.cumsum(count + length - 1) - (count + length - 1)

        def suffixes(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return np.repeat(np.arange(len(count)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)

        row, nth = suffixes(count)
        hashes = all_hashes(np.frombuffer(data, np.uint8), core)
        kept, first, last = repeated_strings(string_hashes(hashes, at[row] + nth, np.full(len(row), length), core), row, nth)
        if not len(kept):
            return
        doc, start, count, at = doc[kept], start[kept] + first, last - first + 1, at[kept] + first
        data = b"".join(data[a:b] for a, b in zip(at.tolist(), (at + count + length - 1).tolist()))
        at = np.cumsum(count + length - 1) - (count + length - 1)
        row, nth = suffixes(count)
        position = text_positions(doc, start, count)[row] + nth
        octets = np.frombuffer(data, np.uint8)
        copy = np.flatnonzero(longest_previous_factors(octets, at[row] + nth, position, length) >= length)
        if not len(copy):
            return
        new = np.flatnonzero(np.r_[True, (np.diff(copy) != 1) | (np.diff(row[copy]) != 0)])
        first, last = copy[new], copy[np.r_[new[1:] - 1, len(copy) - 1]]
        yield spans(doc[row[first]], start[row[first]] + nth[first], start[row[last]] + nth[last] + length)

    held: list[pa.RecordBatch] = []
    size, string = 0, np.empty((0, 5), np.int64)
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (kind == REPEATED).any():
            old = numbers(batch.filter(pa.array(kind == REPEATED)), *NAME, "start", "suffixes")
            yield spans(old[:, :2], old[:, 2], old[:, 2] + old[:, 3] - 1 + length)
        if (kind == STRING).any():  # one row is held, however often a string occurs
            rows = numbers(batch.filter(pa.array(kind == STRING)), "anchor", "whole", *NAME, "start")
            later, firsts = apart(np.concatenate((string, rows)))
            string = firsts[-1:]
            yield spans(later[:, 2:4], later[:, 4], later[:, 4] + length)
        batch = batch.filter(pa.array(kind == OPEN))
        if not batch.num_rows:
            continue
        anchors = batch.column("anchor").to_numpy()
        at = 0
        cuts = np.r_[np.flatnonzero(np.diff(anchors)) + 1, batch.num_rows]
        if held and held[-1].column("anchor")[-1].as_py() != anchors[0] and size >= BLOCK:
            yield from work(held)
            held, size = [], 0
        lengths = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy(), dtype=np.int64)
        for cut, upto in zip(cuts.tolist(), lengths[cuts - 1].tolist()):  # whole groups until a block is full
            if cut < batch.num_rows and size + upto - (int(lengths[at - 1]) if at else 0) >= BLOCK:
                yield from work([*held, batch.slice(at, cut - at)])
                held, size, at = [], 0, cut
        held.append(batch.slice(at))
        size += int(lengths[-1] - (lengths[at - 1] if at else 0))
    if held:
        yield from work(held)


def repeated_spans(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """doc_id, digest, span: byte spans that, together, cover all later copies.

    ``docs`` has doc_id, digest (neither null) and text. Spans of one document may overlap.
    """
    if length < 2 * core or length > 9 * 24 or length >= PIECE:
        raise ValueError("give a length of 2 * core up to 216 bytes")
    dealt = (
        docs.mapInArrow(lambda b: anchored(b, length, core), "anchor long, whole long, doc_id long, digest long, place long")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "whole", *NAME, "place")
    )
    told = staged(
        dealt.mapInArrow(lambda b: told_apart(b, length), "kind int, anchor long, doc_id long, digest long, place long"),
        "segments",
    )
    rivals = told.where(F.col("kind") == OPEN).drop("kind")
    hot = staged(rivals.groupBy("anchor").count().where(F.col("count") > HOT).select("anchor"), "hot-anchors")
    # Dealt before they are collected: what a task holds of one document is little, so lists of it save nothing.
    marks = (
        rivals.join(hot.withColumn("hot", F.lit(1)), "anchor", "left")
        .select(*NAME, "anchor", (F.col("place") * 2 + F.coalesce("hot", F.lit(0))).alias("place"))
        .repartition(*NAME)
        .groupBy(*NAME)
        .agg(F.collect_list(F.struct("place", "anchor")).alias("marks"))
    )
    strings = (
        docs.join(marks, [*NAME])
        .mapInArrow(
            lambda b: fetched(b, length, core),
            "kind int, anchor long, whole long, doc_id long, digest long, start long, suffixes int, bytes binary",
        )
        .repartition("anchor")
        .sortWithinPartitions("anchor", "whole", *NAME, "start")
        .mapInArrow(lambda b: sorted_out(b, length, core), "doc_id long, digest long, span long")
    )
    return told.where(F.col("kind") == REPEATED).select(*NAME, F.col("place").alias("span")).union(strings)


def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans (spans merged, within the text)."""
    for batch in parts(batches, "text", PIECE):
        data, bounds = bytes_of(batch.column("text"))
        spans = batch.column("spans")
        text = np.repeat(np.arange(batch.num_rows), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        span = spans.flatten().to_numpy()
        begins, ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
        shift = begins + np.arange(batch.num_rows)  # a byte lies between texts, so spans of two do not meet
        start = (span >> SPAN_BITS) + shift[text]
        end = np.minimum(span & ((1 << SPAN_BITS) - 1), (ends - begins)[text]) + shift[text]
        order = np.argsort(start)
        order = order[start[order] < end[order]]
        text, start, end = text[order], start[order], np.maximum.accumulate(end[order])
        new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]][: len(start)])
        last = np.r_[new[1:], len(start)][: len(new)] - 1
        text = text[new]
        start, end = start[new] - shift[text], end[last] - shift[text]
        per = np.searchsorted(text, np.arange(batch.num_rows + 1))
        kept = []
        starts, stops = start.tolist(), end.tolist()
        for at, stop, a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), per[:-1].tolist(), per[1:].tolist()):
            edges = zip([0, *stops[a:b]], [*starts[a:b], stop - at])
            kept.append(b"".join(data[at + x : at + y] for x, y in edges))
        pairs = pa.ListArray.from_arrays(np.arange(len(start) + 1, dtype=np.int32) * 2, np.stack([start, end], axis=1).ravel())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("given_id"),
                pa.array(ends - begins),
                pa.ListArray.from_arrays(per.astype(np.int32), pairs),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "removed", "kept"],
        )


def deduplicated(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """Per document: doc_id, n_bytes, removed (array of [start, end)), kept (binary).

    Earlier is: a smaller doc_id; of different texts with one doc_id, a smaller hash of
    the text; in one text an earlier byte. What remains may cut a character, hence
    bytes. Null texts are empty; a null doc_id counts as smaller than all others. Rows
    that share a doc_id and text are one text: each keeps what the other keeps. Other
    columns are not read. An empty table gives no row.
    """
    given_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(
        F.coalesce(given_id, F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(text, given_id.isNull()).alias("digest"),
        given_id.alias("given_id"),
        text.alias("text"),
    )
    # Texts are dealt by name once, for both joins: they have the same columns there.
    spans = (
        repeated_spans(own, length, core).repartition(*NAME).groupBy(*NAME).agg(F.collect_list("span").alias("spans"))
    )
    return own.join(spans, [*NAME], "left").mapInArrow(
        cut_out, "doc_id long, n_bytes long, removed array<array<long>>, kept binary"
    )
