from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm import repair
from eventloom.llm.queries import op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\v\f\r"


def cheapest(symbols):
    """Least cost, then least letters, over all edit sequences, by best-first search."""
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, letters, i, state, taken = heapq.heappop(heap)
        if i == len(symbols) and state in (0, 3):
            return cost, letters, taken
        if (i, state) in done:
            continue
        done.add((i, state))
        if i < len(symbols):
            for letter, role, c, after in repair.steps(symbols[i], state):
                heapq.heappush(heap, (cost + c, letters + letter, i + 1, after, (*taken, (i, role))))
        role, after = repair.FORCED[state]
        heapq.heappush(heap, (cost + 5, letters + "I", i, after, (*taken, (None, role))))


def brute(rows, damage=False):
    """The query's columns in plain Python."""
    found = {}
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv]
        role, text = (" " if x is None else x for x in (role, text))
        copies = 1
        if damage:
            name = ":".join(" " if x is None else str(x) for x in (conv, turn))
            fault = zlib.crc32(name.encode()) % 20
            copies = {0: 0, 3: 2}.get(fault, 1)
            role = "user" if fault == 4 else role
            text = {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(fault, text)
        by_conv[conv] += [(turn, role, text)] * copies
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in own if t is not None}
        seen, symbols, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            solid = text.strip(WHITE)
            symbol = 0
            if not solid:
                count["blank"] += 1
            elif (role, text) in seen:
                count["duplicate"] += 1
            else:
                symbol = 1 + ("sua".find(role[:1]) % 4 if role else 3)
                if solid[-1] not in ".!?":
                    count["truncated"] += 1
                    symbol += 4
            seen.add((role, text))
            symbols.append(symbol)
        cost, audit, taken = cheapest(symbols)
        lines = []
        for i, role in taken:
            if role:
                name = own[i][1] if role == "K" else {"u": "user", "a": "assistant"}[role.lower()]
                lines.append(f"{name}:{'' if i is None else own[i][2]}")
        illegal = sum((x[1][:1] + y[1][:1]) not in ("su", "ua", "au") for x, y in zip(own, own[1:]))
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_the_query_on_the_given_conversations(spark):
    from tests.conftest import SMALL

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(*SCHEMA.split()[::2]).collect()]
    got = op12_conversation_repair(spark, SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert reported(got) == brute(rows, damage=True)


def some_rows(rng, conv, n, texts=("Yes.", "No", "", " \t", "Why?", "and\n", "x!\r\n", None)):
    roles = ("user", "assistant", "system", "tool", "", None, "User")
    turns = (None, *range(-2, n))
    return [(conv, rng.choice(turns), rng.choices(roles, (8, 8, 3, 1, 1, 1, 1))[0], rng.choice(texts) or None) for _ in range(n)]


def test_random_conversations_with_nulls_ties_and_copies(spark):
    rng = random.Random(7)
    rows = [r for conv in (*range(120), None) for r in some_rows(rng, conv, rng.randrange(1, 30))]
    rows += [(500, 3, "user", "Same.")] * 40 + [(501, None, None, None)] * 3 + [(502, 2**62, "assistant", "a " * 100_000)]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("group", "number", "symbol", "cell", "n", "at", "head")})
    assert reported(repair.report(repair.repaired(turns), turns)) == brute(rows)


def test_long_conversations_are_chained_over_cells(spark, monkeypatch):
    monkeypatch.setattr(repair, "CELL", 8)
    rng = random.Random(5)
    texts = tuple(f"{w}{e}" for w in "abcdefghij" for e in (".", "!", "", "?", " "))
    rows = [r for conv, n in ((1, 300), (2, 8), (3, 16), (4, 7), (None, 200)) for r in some_rows(rng, conv, n, texts)]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert reported(repair.report(repair.repaired(turns), turns)) == brute(rows)


def test_tables_agree_with_a_search_over_all_edits():
    table, rng = repair.tables(), random.Random(2)
    assert len(table.block) == repair.SYMBOLS**repair.BLOCK and len(table.vectors) < 100
    for _ in range(3000):
        symbols = [rng.randrange(repair.SYMBOLS) for _ in range(rng.randrange(1, 15))]
        letters, roles, costs, state = repair.traced(symbols, [1] * len(symbols), table.number[repair.END], 0, table)
        repair.finished(letters, roles, costs, state)
        cost, audit, _ = cheapest(symbols)
        assert (sum(costs), "".join(letters)) == (cost, audit)


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "Hi.")], [(1, 14, "user", "Hi.")]])
def test_none_and_single_rows(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA)
    assert reported(repair.report(repair.repaired(repair.damaged(turns)), turns)) == brute(rows, damage=True)


def test_repaired_messages_alternate(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hm?"), (1, 3, "assistant", "Yes.")]
    found = repair.messages(repair.repaired(spark.createDataFrame(rows, SCHEMA)))
    said = [(m.role, m.text) for r in found.orderBy("number").collect() for m in r.messages]
    assert said == [("user", "Be kind."), ("assistant", "Hello."), ("user", "Hm?"), ("assistant", "Yes.")]
