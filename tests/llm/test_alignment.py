from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import alignment
from eventloom.llm.queries import BYTE_LEVEL_FILE, PIECE_FILE

SIGNS = alignment.bytes_by_sign()


@pytest.fixture(scope="module")
def plain():
    """Both libraries used directly: ids and bytes of a text."""
    first = Tokenizer.from_file(BYTE_LEVEL_FILE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)

    def cut(text):
        a = [(i, bytes(SIGNS[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            p = second.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
        return a, b

    return cut


def brute(rows, cut):
    """The same columns by sets of end offsets and all pairs of each group."""
    held, found = Counter(), []
    for doc_id, text in rows:
        a, b = cut(text) if text else ([], [])
        raw = b" " + (text or "").encode()
        if not text or b"".join(o for _, o in a) != raw or b"".join(o for _, o in b) != raw:
            found.append((doc_id, [], []))
            continue
        ends = [set(np.cumsum([len(o) for _, o in x]).tolist()) for x in (a, b)]
        common = sorted(ends[0] & ends[1])
        groups = [([], []) for _ in common]
        for side, tokens in enumerate((a, b)):
            end, g = 0, 0
            for i, o in tokens:
                end += len(o)
                groups[g][side].append(i)
                g += end == common[g]
        pairs = [(x, y) for own in groups for x in own[0] for y in own[1]]
        held.update(set(pairs))
        found.append((doc_id, groups, pairs))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for doc_id, groups, pairs in found:
        text = ";".join("|".join(",".join(map(str, x)) for x in own) for own in groups)
        yield (
            doc_id,
            sum(len(x) for x, _ in groups),
            sum(len(x) for _, x in groups),
            len(groups),
            len(pairs),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
            sum(held[p] == most[p[0]] for p in pairs),
            sum(held[p] for p in pairs),
        )


def same(df, rows, cut):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted(brute(rows, cut), key=repr)


def test_the_given_documents(spark, documents, plain):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    same(alignment.aligned(documents, BYTE_LEVEL_FILE, PIECE_FILE), rows, plain)


ODD = [
    "<|endoftext|> <s> </s> <unk> <0x41> ▁ ▁▁x",
    "   \t\n\n  x  ",
    "\x00\x01﻿� é à ß 中文字 \U0001f600\U0001f1e9\U0001f1ea ́e",
    "é ﬁ ① ㎏ Å  　 ‍",
    " ",
    "a" * 5000 + "ab" * 3000,
    "中文" * 4000,
    "!?" * 4000 + " " * 5000,
    "I'm you're we'll it's DON'T 1234567890 x1y2",
]


def test_odd_rows_small_cells_and_wide_groups(spark, odd, plain, monkeypatch):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD * 2)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    rows = [tuple(r) for r in docs.collect()]
    same(alignment.aligned(docs, BYTE_LEVEL_FILE, PIECE_FILE), rows, plain)
    for name, value in (("CELL_PAIRS", 50), ("AT_ONCE", 500), ("WIDE", 1)):
        monkeypatch.setattr(alignment, name, value)
    same(alignment.aligned(docs.repartition(3), BYTE_LEVEL_FILE, PIECE_FILE), rows, plain)


def test_clashing_columns_and_no_rows(odd, none):
    assert alignment.aligned(none, BYTE_LEVEL_FILE, PIECE_FILE).collect() == []
    clashing = odd.select("*", *(F.lit(1).alias(c) for c in ("cell", "pairs", "held", "n_a", "place", "total")))
    got = alignment.aligned(clashing, BYTE_LEVEL_FILE, PIECE_FILE)
    assert got.count() == odd.count() and got.columns[0] == "doc_id"


def test_ranks_encode_like_the_tokenizer_on_all_code_points():
    with open(BYTE_LEVEL_FILE, "rb") as file:
        own = alignment.byte_level(file.read())
    direct = Tokenizer.from_file(BYTE_LEVEL_FILE)
    direct.encode_special_tokens = True
    for low in range(0, 0x110000, 4096):
        signs = [chr(c) for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000]
        texts = ["".join(signs), " ".join(signs), "a".join(signs)]
        assert own.encode(texts) == [e.ids for e in direct.encode_batch(texts, add_special_tokens=False)]


def test_pointers_come_to_the_last_token_of_the_component():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.append(np.flatnonzero(rng.random(n - 1) < p) + 1, n) for p in rng.random(2)]
        group = alignment.groups_of(*ends)
        common = np.intersect1d(*ends)
        for own, e in zip(group, ends):
            assert own.tolist() == np.searchsorted(common, e).tolist()


def test_one_group_of_thousands_of_tokens_makes_no_list_of_all_pairs():
    a, b = np.arange(3000) % 7, np.arange(4000) % 5
    keys, times, of_group = alignment.links(a, b, np.zeros(3000, np.int64), np.zeros(3000, np.int64), np.zeros(4000, np.int64))
    assert len(keys) == 35 and times.sum() == of_group.sum() == 12_000_000
