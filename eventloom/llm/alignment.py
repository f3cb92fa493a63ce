"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to the token of the other
tokenizer that overlaps it and reaches farthest right, or to itself where both end.
Doubling the pointers, for all texts of a batch at once, brings every token to the
last token of its component, which labels the group: the tokens between two offsets
at which both tokenizers end.

Tasks label the groups of whole texts and reduce each text to its distinct linked
pairs of ids and how often it has them. Texts are gathered into cells of bounded
size; a cell passes each of its pairs on once, with the number of its texts that hold
it, Spark adds these up over all cells, and every cell gets the totals of its own
pairs back. So neither a frequent pair nor a frequent text makes a large group: a pair
is at most one row per cell.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from eventloom.functions.scratch import staged
from eventloom.llm.text import parts

#: How the byte-level tokenizer cuts a text before merging; a fixed value.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bits of an id in a pair.
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1
#: A cell is passed on when it has this many distinct pairs, counted per text.
CELL_PAIRS = 2_000_000
#: Links that are written out at once.
AT_ONCE = 1 << 21
#: Groups with more tokens than this of one tokenizer are reduced to distinct ids first.
WIDE = 8

DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
REDUCED = f"cell long, {DOCUMENT}, held binary, times binary, pairs array<long>, texts array<long>"
ALIGNED = f"{DOCUMENT}, n_best long, count_sum long"


@dataclass
class Vocabulary:
    """A tokenizer: how it encodes texts, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    octets: list[bytes]


def bytes_by_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level(file: bytes) -> Vocabulary:
    """A byte-level tokenizer from its JSON file; special tokens in a text are plain text.

    Where the file has the usual form, merges in the order of their ids, its vocabulary is
    used as ranks, which encodes alike in a quarter of the time.
    """
    spec = json.loads(file)
    model, sign = spec["model"], bytes_by_sign()
    ids = {bytes(sign[c] for c in entry): i for entry, i in model["vocab"].items()}
    octets = [b""] * (1 + max(ids.values(), default=-1))
    for entry, i in ids.items():
        octets[i] = entry
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"].get(a + b, -1) for a, b in merges]
    singles = [i for entry, i in ids.items() if len(entry) == 1]
    cut = spec.get("pre_tokenizer") or {}
    usual = (
        len(singles) == 256
        and merged == sorted(set(merged))
        and len(ids) == 256 + len(merged)
        and not spec.get("normalizer")
        and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
        and not model.get("ignore_merges")
    )
    if usual:
        ranked = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ids, special_tokens={})
        return Vocabulary(lambda texts: [ranked.encode_ordinary(t) for t in texts], octets)
    own = Tokenizer.from_buffer(file)
    own.encode_special_tokens = True
    return Vocabulary(lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)], octets)


def pieces(file: bytes) -> Vocabulary:
    """A sentencepiece tokenizer, which adds the leading space itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=file)

    def octets(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Vocabulary(lambda texts: model.encode(texts, num_threads=1), [octets(i) for i in range(model.get_piece_size())])


def farthest(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For tokens of a, then of b: the overlapping token that reaches farthest right.

    A token of a goes to the token of b that holds its last byte; one of b to the token
    of a that does, or to itself where both end.
    """
    n = len(ends_a)
    over = np.searchsorted(ends_a, ends_b)
    return np.concatenate(
        (n + np.searchsorted(ends_b, ends_a), np.where(ends_a[over] == ends_b, n + np.arange(len(ends_b)), over))
    )


def jumped(successor: np.ndarray) -> np.ndarray:
    """The last token that each token comes to, by doubling its steps."""
    while True:
        after = successor[successor]
        if (after == successor).all():
            return after
        successor = after


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of every token of a and of b, from the left."""
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = jumped(farthest(ends_a, ends_b))
    is_last = last == np.arange(len(last))
    number = np.cumsum(is_last) - 1
    own = number[last]
    return own[: len(ends_a)], own[len(ends_a) :]


def places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their times."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(times, heads)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``distinct`` of keys that count once each."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.diff(np.append(heads, len(keys)))


def narrow_links(a, b, text_a, first_a, in_a, first_b, in_b) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct (text, pair) keys and times of groups given by first place and number of tokens."""
    ahead = np.cumsum(in_a * in_b)
    cuts = np.searchsorted(ahead, np.arange(AT_ONCE, ahead[-1] if len(ahead) else 0, AT_ONCE))
    for part in np.split(np.arange(len(in_a)), np.unique(cuts)):
        if not len(part):
            continue
        tokens = np.repeat(first_a[part], in_a[part]) + places(in_a[part])
        others = np.repeat(in_b[part], in_a[part])
        left = np.repeat(tokens, others)
        right = np.repeat(np.repeat(first_b[part], in_a[part]), others) + places(others)
        yield counted((text_a[left] << 2 * ID_BITS) | (a[left] << ID_BITS) | b[right])


def wide_links(text: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for one large group, from its distinct ids and how often they occur."""
    (a, in_a), (b, in_b) = counted(a), counted(b)
    for at in range(0, len(a), max(1, AT_ONCE // len(b))):
        some, n = a[at : at + max(1, AT_ONCE // len(b))], in_a[at : at + max(1, AT_ONCE // len(b))]
        yield ((text << 2 * ID_BITS) | (some[:, None] << ID_BITS) | b).ravel(), (n[:, None] * in_b).ravel()


def links(a, b, text_a, group_a, group_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair) keys in order, how often each is linked, and links per group."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    wide = (in_a > WIDE) | (in_b > WIDE)
    narrow = ~wide
    found = list(narrow_links(a, b, text_a, first_a[narrow], in_a[narrow], first_b[narrow], in_b[narrow]))
    for g in np.flatnonzero(wide).tolist():
        own_a, own_b = slice(first_a[g], first_a[g] + in_a[g]), slice(first_b[g], first_b[g] + in_b[g])
        found.extend(wide_links(int(text_a[first_a[g]]), a[own_a], b[own_b]))
        if len(found) > 256:
            found = [distinct(*map(np.concatenate, zip(*found)))]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), in_a * in_b
    keys, times = found[0] if len(found) == 1 else distinct(*map(np.concatenate, zip(*found)))
    return keys, times, in_a * in_b


def digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id below ``size`` in decimal: signs, one to a column, and how many."""
    width = len(str(max(size - 1, 0)))
    texts = np.array([str(i) for i in range(size)], f"S{width}")
    lengths = np.array([len(str(i)) for i in range(size)])
    return texts.view(np.uint8).reshape(size, width), lengths


def written(a, b, group_a, group_b, table) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, ``a1,a2|b1;a3|b2``, one sign after each token, and where tokens of a begin.

    The sign after the last token of a text is the ``;`` that its digest leaves out.
    """
    signs, lengths = table
    ids = np.concatenate((a, b))
    kind = np.repeat((0, 1), (len(a), len(b)))
    order = np.argsort(np.concatenate((group_a, group_b)) * 2 + kind, kind="stable")
    ids, kind, group = ids[order], kind[order], np.concatenate((group_a, group_b))[order]
    after = np.full(len(ids), ord(","), np.uint8)
    ends = np.flatnonzero(np.concatenate(((group[1:] != group[:-1]) | (kind[1:] != kind[:-1]), [True])))
    after[ends] = np.where(kind[ends] == 0, ord("|"), ord(";"))
    width = signs.shape[1]
    cells = np.zeros((len(ids), width + 1), np.uint8)
    cells[:, :width] = signs[ids]
    n = lengths[ids]
    cells[np.arange(len(ids)), n] = after
    return cells[np.arange(width + 1) <= n[:, None]], np.cumsum(n + 1)


def reduced_texts(texts: list[str | None], one: Vocabulary, two: Vocabulary, sizes, table) -> tuple[dict, np.ndarray, np.ndarray]:
    """Columns of ``texts``, their distinct (text, pair) keys in order, and how often each is linked."""
    spaced = [" " + t for t in texts if t]
    whose = [i for i, t in enumerate(texts) if t]
    cut_a, cut_b = one.encode(spaced), two.encode([t[1:] for t in spaced])
    kept = [
        k
        for k, t in enumerate(spaced)
        if (raw := t.encode()) == b"".join(map(one.octets.__getitem__, cut_a[k]))
        and raw == b"".join(map(two.octets.__getitem__, cut_b[k]))
    ]
    cut_a, cut_b, whose = [cut_a[k] for k in kept], [cut_b[k] for k in kept], np.array([whose[k] for k in kept], np.int64)
    n_a, n_b = (np.array([len(x) for x in cut], np.int64) for cut in (cut_a, cut_b))
    a, b = (np.fromiter(chain.from_iterable(cut), np.int64, n.sum()) for cut, n in ((cut_a, n_a), (cut_b, n_b)))
    group_a, group_b = groups_of(np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b]))
    keys, times, of_group = links(a, b, np.repeat(whose, n_a), group_a, group_b)

    def whole(values: np.ndarray) -> np.ndarray:
        column = np.zeros(len(texts), np.int64)
        column[whose] = values
        return column

    # the last group of a text is that of its last token, so sums up to there part the texts
    last = group_a[np.cumsum(n_a) - 1] + 1 if len(whose) else np.zeros(0, np.int64)
    groups = np.diff(last, prepend=0)
    linked = np.concatenate(([0], np.cumsum(of_group)))[last]
    signs, ends = written(a, b, group_a, group_b, table) if len(whose) else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
    stops = ends[np.cumsum(n_a + n_b) - 1] if len(whose) else ends
    digests, begin, signs = [""] * len(texts), 0, signs.tobytes()
    for i, stop in zip(whose.tolist(), stops.tolist()):
        digests[i], begin = hashlib.sha256(signs[begin : stop - 1]).hexdigest(), stop
    columns = {
        "n_a": whole(n_a),
        "n_b": whole(n_b),
        "n_groups": whole(groups),
        "n_links": whole(np.diff(linked, prepend=0)),
        "groups_sha256": digests,
    }
    return columns, keys, times


def reducer(first: bytes, second: bytes):
    """Tasks' work: documents to rows of REDUCED, one for each document and one for each cell."""

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_level(first), pieces(second)
        if max(len(one.octets), len(two.octets)) > ID_MASK:
            raise ValueError(f"ids of more than {ID_BITS} bits")
        sizes = tuple(np.array([len(o) for o in v.octets], np.int64) for v in (one, two))
        table = digits(max(len(one.octets), len(two.octets)))
        schema = pa.schema([
            ("cell", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")),
            ("groups_sha256", pa.string()), ("held", pa.binary()), ("times", pa.binary()),
            ("pairs", pa.list_(pa.int64())), ("texts", pa.list_(pa.int64())),
        ])
        cell = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []
        size = 0

        def finished() -> Iterator[pa.RecordBatch]:
            pairs, texts = counted(np.concatenate([w[2] for w in waiting]))
            for ids, columns, held, times, bounds in waiting:
                places = np.searchsorted(pairs, held).astype(np.int32)
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                yield pa.RecordBatch.from_pydict({
                    **columns, "cell": [cell] * len(ids), "doc_id": ids,
                    "held": [places[i:j].tobytes() for i, j in spans], "times": [times[i:j].tobytes() for i, j in spans],
                    "pairs": [None] * len(ids), "texts": [None] * len(ids),
                }, schema)
            offsets = pa.array([0, len(pairs)], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pairs, texts)]
            nothing = [pa.nulls(1, f.type) for f in list(schema)[1:-2]]
            yield pa.RecordBatch.from_arrays([pa.array([cell]), *nothing, *lists], schema=schema)

        for batch in batches:
            for part in parts([batch], "text", 1 << 21):
                columns, keys, times = reduced_texts(part.column("text").to_pylist(), one, two, sizes, table)
                bounds = np.searchsorted(keys, np.arange(part.num_rows + 1) << 2 * ID_BITS)
                waiting.append((part.column("doc_id"), columns, keys & ((1 << 2 * ID_BITS) - 1), times.astype(np.int32), bounds))
                size += len(keys)
                if size > CELL_PAIRS:
                    yield from finished()
                    waiting, size, cell = [], 0, cell + 1
        if waiting:
            yield from finished()

    return reduce


def with_totals(key, documents: pa.Table, totals: pa.Table) -> pa.Table:
    """n_best and count_sum of the documents of a cell, from the totals of its pairs."""
    place = totals.column("place").to_numpy()
    total, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    total[place], best[place] = totals.column("total").to_numpy(), totals.column("is_best").to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for held, times in zip(documents.column("held").to_pylist(), documents.column("times").to_pylist()):
        own, n = np.frombuffer(held, np.int32), np.frombuffer(times, np.int32).astype(np.int64)
        n_best.append(int(n @ best[own]))
        count_sum.append(int(n @ total[own]))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return pa.table(
        [*(documents.column(c) for c in names), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
        [*names, "n_best", "count_sum"],
    )


def reduced(docs: DataFrame, byte_level_file: str, piece_file: str) -> DataFrame:
    """The rows of documents and cells, staged."""
    with open(byte_level_file, "rb") as one, open(piece_file, "rb") as two:
        shared = docs.sparkSession.sparkContext.broadcast((one.read(), two.read()))  # two vocabulary files
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from reducer(*shared.value)(batches)

    return staged(wanted.mapInArrow(reduce, REDUCED), "reduced")


def pair_totals(cells: DataFrame) -> DataFrame:
    """own (the cell), place, total and is_best of each pair of each cell.

    ``total`` counts the documents of the corpus that hold the pair linked; ``is_best``
    says that no other pair of its first id has more.
    """
    lists = cells.where("pairs is not null").select(F.col("cell").alias("own"), F.arrays_zip("pairs", "texts").alias("held"))
    own = lists.select("own", F.posexplode("held").alias("place", "held"))
    own = own.select("own", "place", F.col("held.pairs").alias("pair"), F.col("held.texts").alias("texts"))
    totals = staged(own.groupBy("pair").agg(F.sum("texts").alias("total")), "pair-totals")
    first_id = F.shiftright("pair", ID_BITS).alias("first_id")
    most = totals.groupBy(first_id).agg(F.max("total").alias("most"))
    # at most one row for each id of the first vocabulary
    ranked = totals.withColumn("first_id", first_id).join(F.broadcast(most), "first_id")
    ranked = ranked.select("pair", "total", (F.col("total") == F.col("most")).alias("is_best"))
    return own.join(ranked, "pair").select("own", "place", "total", "is_best")


def aligned(docs: DataFrame, byte_level_file: str, piece_file: str) -> DataFrame:
    """Alignment of the tokens of two tokenizers, one row for each row of ``docs``.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have
    no tokens: zeros and an empty digest. Every row is a document of its own, also where
    rows are equal, share an id or have none. Texts are taken whole; a text that exceeds a
    cell is a cell of its own. Only doc_id and text are read, so other columns can have
    any name. An empty table gives no row.
    """
    cells = reduced(docs, byte_level_file, piece_file)
    documents = cells.where("pairs is null").drop("pairs", "texts")
    return documents.groupBy("cell").cogroup(pair_totals(cells).groupBy("own")).applyInArrow(with_totals, ALIGNED)


def groups(texts: list[str], one: Vocabulary, two: Vocabulary) -> list[list[tuple[list[int], list[int]]]]:
    """The groups of each text, as pairs of lists of ids; for use on single texts."""
    found = []
    for text in texts:
        a, b = one.encode([" " + text])[0], two.encode([text])[0]
        sizes = (np.cumsum([len(v.octets[i]) for i in ids]) for v, ids in ((one, a), (two, b)))
        group_a, group_b = groups_of(*sizes)
        own = [([], []) for _ in range(int(group_a[-1]) + 1 if a else 0)]
        for i, g in zip(a, group_a.tolist()):
            own[g][0].append(i)
        for i, g in zip(b, group_b.tolist()):
            own[g][1].append(i)
        found.append(own)
    return found
