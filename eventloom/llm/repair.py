"""Conversation structure repair by Four-Russians block tables.

A conversation's repaired role initials must spell nothing, or an optional s and then
ua once or more. Four states say how much of that has been spelled; the cheapest cost
to the end from each state is a vector of four. Its differences are bounded, so less
their least entry only some tens of vectors occur: for each of them and each block of
BLOCK symbols, a table gives the vector left of the block and the cost added. A
conversation goes from right to left a block at a time. The way through it is then
found from left to right: each block is expanded backward from the vector on its right,
which tells at every row which edits are cheapest, so ties are settled exactly.

Identical rows are one row with a count; all but the first are to be deleted. Rows are
numbered in range partitions, so a long conversation spreads over tasks; it is worked
off in cells of CELL rows. Cells pass on matrices of the cheapest cost from state to
state, which are chained, and then what state each entry state leads to. Only narrow
columns take part in this: texts move when copies meet and when repaired rows are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.numbering import numbered
from eventloom.functions.scratch import staged

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLOCK = 4
#: Rows of a cell; a multiple of BLOCK.
CELL = 4096
NEVER = 1 << 40
#: States: nothing spelled, s, ends in u, ends in a.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that an inserted or reroled row gets, and the state after it.
FORCED = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
END = (0, 2 * INSERT, INSERT, 0)
INITIALS = "suao"
#: 0: a row to delete; then rows by initial (o: any other), then truncated ones.
SYMBOLS = 1 + 2 * len(INITIALS)
SPACE = r"[\x20\x09-\x0D]"
SOLVED = "group string, cell long, letters array<string>, roles array<string>, costs array<long>"


def steps(symbol: int, state: int) -> Iterator[tuple[str, str, int, int]]:
    """Edits of a row in a state, by letter: letter, role sign, cost, state after it.

    A sign is K for the row's own role, U or A for another; a deleted row has none.
    """
    yield "D", "", DELETE, state
    if symbol:
        extra = TRUNCATED if symbol > len(INITIALS) else 0
        initial = INITIALS[(symbol - 1) % len(INITIALS)]
        if initial in KEEP[state]:
            yield "K", "K", extra, KEEP[state][initial]
        role, after = FORCED[state]
        yield "R", role.upper(), REROLE + extra, after


def ahead_of(symbol: int, right: tuple[int, ...]) -> tuple[int, ...]:
    """The cheapest cost to the end from each state before a row, given that after it."""
    own = [min(cost + right[after] for _, _, cost, after in steps(symbol, s)) for s in range(4)]
    return with_inserts(own)


def with_inserts(own: list[int]) -> tuple[int, ...]:
    once = [min(own[s], INSERT + own[FORCED[s][1]]) for s in range(4)]
    return tuple(min(NEVER, own[s], INSERT + once[FORCED[s][1]]) for s in range(4))


def normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(v - least if v < NEVER else NEVER for v in vector), least


@dataclass
class Tables:
    """All normalised vectors, what a symbol and a block makes of each, and the ways through a row."""

    vectors: list[tuple[int, ...]]
    number: dict[tuple[int, ...], int]
    one: list[list[int]]
    block: list[list[int]]
    added: list[list[int]]
    way: list[list[list[tuple[str, str, int, int]]]]


def tables() -> Tables:
    starts = [END, *(with_inserts([0 if s == t else NEVER for s in range(4)]) for t in range(4))]
    vectors: list[tuple[int, ...]] = []
    number: dict[tuple[int, ...], int] = {}

    def known(vector: tuple[int, ...]) -> int:
        if vector not in number:
            number[vector] = len(vectors)
            vectors.append(vector)
        return number[vector]

    for start in starts:
        known(normal(start)[0])
    one, added = [[] for _ in range(SYMBOLS)], [[] for _ in range(SYMBOLS)]
    at = 0
    while at < len(vectors):
        for symbol in range(SYMBOLS):
            vector, cost = normal(ahead_of(symbol, vectors[at]))
            one[symbol].append(known(vector))
            added[symbol].append(cost)
        at += 1
    block, total = np.array(one), np.array(added)
    width = 1
    while width < BLOCK:  # the left half of a longer block after its right half
        lefts = np.arange(len(block))[:, None, None]
        total = (total[None, :, :] + total[lefts, block[None, :, :]]).reshape(-1, len(vectors))
        block = block[lefts, block[None, :, :]].reshape(-1, len(vectors))
        width *= 2
    way = [[[cheapest(symbol, s, vector) for s in range(4)] for vector in vectors] for symbol in range(SYMBOLS)]
    return Tables(vectors, number, one, block.tolist(), total.tolist(), way)


def cheapest(symbol: int, state: int, right: tuple[int, ...]) -> tuple[str, str, int, int]:
    """The least letters, in ASCII order, of a cheapest way over a row: letters, role signs, cost, state.

    Letters before the row's own are inserts.
    """
    ahead = ahead_of(symbol, right)
    if ahead[state] >= NEVER:
        return "", "", NEVER, state
    letters = roles = ""
    cost = 0
    while True:
        own = {letter: (role, c, after) for letter, role, c, after in steps(symbol, state) if c + right[after] == ahead[state]}
        role, after = FORCED[state]
        if "D" not in own and INSERT + ahead[after] == ahead[state]:
            letters, roles, cost, state = letters + "I", roles + role, cost + INSERT, after
            continue
        letter = min(own)
        role, c, after = own[letter]
        return letters + letter, roles + role, cost + c, after


def tail(state: int) -> tuple[str, str, int]:
    """Inserts after the last row."""
    roles = {0: "", 1: "ua", 2: "a", 3: ""}[state]
    return "I" * len(roles), roles, INSERT * len(roles)


def bounds_of(symbols: list[int], right: int, table: Tables) -> tuple[list[int], int, int]:
    """Vectors right of each block, from the right; the vector left of the cell, and the cost added."""
    bounds, cost = [], 0
    at = len(symbols)
    while at >= BLOCK:
        block = 0
        for symbol in symbols[at - BLOCK : at]:
            block = block * SYMBOLS + symbol
        bounds.append(right)
        cost += table.added[block][right]
        right = table.block[block][right]
        at -= BLOCK
    bounds.append(right)
    for symbol in reversed(symbols[:at]):
        cost += normal(ahead_of(symbol, table.vectors[right]))[1]
        right = table.one[symbol][right]
    return bounds, right, cost


def traced(symbols: list[int], copies: list[int], right: int, state: int, table: Tables):
    """Letters, role signs and cost of every row, on the way from ``state``, and the state after it."""
    bounds, _, _ = bounds_of(symbols, right, table)
    letters, roles, costs = [], [], []
    rest = len(symbols) % BLOCK
    spans = [(0, rest)] * (rest > 0) + [(i, i + BLOCK) for i in range(rest, len(symbols), BLOCK)]
    if not rest:
        bounds.pop()
    for (begin, end), vector in zip(spans, reversed(bounds)):
        after = [vector]  # backward through the block
        for symbol in reversed(symbols[begin + 1 : end]):
            after.append(table.one[symbol][after[-1]])
        for i, vector in zip(range(begin, end), reversed(after)):
            own, role, cost, state = table.way[symbols[i]][vector][state]
            letters.append(own + "D" * (copies[i] - 1))
            roles.append(role)
            costs.append(cost + DELETE * (copies[i] - 1))
    return letters, roles, costs, state


def finished(letters: list[str], roles: list[str], costs: list[int], state: int) -> None:
    own, role, cost = tail(state)
    letters[-1], roles[-1], costs[-1] = letters[-1] + own, roles[-1] + role, costs[-1] + cost


def on_rows(work: Callable[[dict, Tables], dict | list[dict]], schema: str):
    """A function on Arrow batches that makes one or more rows of each row."""

    def on_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, types = tables(), None
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                made = [work(row, table) for row in batch.slice(begin, 64).to_pylist()]
                rows = [r for one in made for r in (one if isinstance(one, list) else [one])]
                types = types or arrow_schema(schema)
                yield pa.RecordBatch.from_pylist(rows, types)

    return on_batches


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}

    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else kinds[name]

    return pa.schema([(field.split()[0], kind(field.split()[1])) for field in ddl.split(", ")])


def whole(row: dict, table: Tables) -> dict:
    """The edits of a conversation that is one cell."""
    symbols, copies = [r["symbol"] for r in row["rows"]], [r["n"] for r in row["rows"]]
    letters, roles, costs, state = traced(symbols, copies, table.number[END], 0, table)
    finished(letters, roles, costs, state)
    return {"group": row["group"], "cell": row["cell"], "letters": letters, "roles": roles, "costs": costs}


def matrix(row: dict, table: Tables) -> dict:
    """The cheapest cost of a cell from state to state, a column of it for each state on the right."""
    symbols = [r["symbol"] for r in row["rows"]]
    columns = []
    for t in range(4):
        start, least = normal(with_inserts([0 if s == t else NEVER for s in range(4)]))
        _, left, cost = bounds_of(symbols, table.number[start], table)
        columns.extend(min(NEVER, v + cost + least) for v in table.vectors[left])
    return {"group": row["group"], "cell": row["cell"], "matrix": columns}


def chained(row: dict, table: Tables) -> list[dict]:
    """The vector right of each cell of a conversation, from the last cell to the first."""
    right, found = END, []
    for own in reversed(row["cells"]):
        found.append({"group": row["group"], "cell": own["cell"], "right": list(right), "is_last": int(not found)})
        m = own["matrix"]
        right, _ = normal(tuple(min(m[4 * t + s] + right[t] for t in range(4)) for s in range(4)))
    return found


def tried(row: dict, table: Tables) -> dict:
    """The edits of a cell from each state, and the state each leads to."""
    symbols, copies = [r["symbol"] for r in row["rows"]], [r["n"] for r in row["rows"]]
    right = table.number[tuple(row["right"])]
    made = []
    for state in range(4):
        letters, roles, costs, after = traced(symbols, copies, right, state, table)
        if row["is_last"]:
            finished(letters, roles, costs, after)
        made.append((letters, roles, costs, after))
    names = ("letters", "roles", "costs", "exits")
    return {"group": row["group"], "cell": row["cell"]} | dict(zip(names, map(list, zip(*made))))


def entered(row: dict, table: Tables) -> list[dict]:
    """The state in which each cell of a conversation is entered, from the first cell on."""
    state, found = 0, []
    for own in row["cells"]:
        found.append({"group": row["group"], "cell": own["cell"], "entry": state})
        state = own["exits"][state]
    return found


def in_order(cells: DataFrame, column: str) -> DataFrame:
    """One row for each conversation: its cells, in order, with one small column."""
    return cells.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("cell", column))).alias("cells"))


def solved(rows: DataFrame) -> DataFrame:
    """group, number, letters, roles and cost of every row of ``group``, ``number``, ``symbol`` and ``n``."""
    own = F.struct("number", "symbol", "n")
    cell = F.floor(F.col("number") / CELL).alias("cell")
    cells = staged(rows.groupBy("group", cell).agg(F.array_sort(F.collect_list(own)).alias("rows")), "cells")
    alone = (F.col("cell") == 0) & (F.size("rows") < CELL)
    short = cells.where(alone).mapInArrow(on_rows(whole, SOLVED), SOLVED)
    keys = ["group", "cell"]
    long = cells.where(~alone)
    schema = "group string, cell long, matrix array<long>"
    costs = long.mapInArrow(on_rows(matrix, schema), schema)
    schema = "group string, cell long, right array<long>, is_last int"
    rights = in_order(costs, "matrix").mapInArrow(on_rows(chained, schema), schema)
    schema = "group string, cell long, letters array<array<string>>, roles array<array<string>>, costs array<array<long>>, exits array<int>"
    ways = staged(long.join(rights, keys).mapInArrow(on_rows(tried, schema), schema), "ways")
    schema = "group string, cell long, entry int"
    entries = in_order(ways, "exits").mapInArrow(on_rows(entered, schema), schema)
    taken = ways.join(entries, keys).select(
        *keys, *(F.col(c)[F.col("entry")].alias(c) for c in ("letters", "roles", "costs"))
    )
    each = short.union(taken).select(
        "group", "cell", F.posexplode(F.arrays_zip("letters", "roles", "costs")).alias("place", "edit")
    )
    return each.select(
        "group", (F.col("cell") * CELL + F.col("place")).alias("number"),
        F.col("edit.letters").alias("letters"), F.col("edit.roles").alias("roles"), F.col("edit.costs").alias("cost"),
    )


KEYS = ("group", "has_turn", "at", "role", "head", "mark", "mark_too")


def keyed(turns: DataFrame) -> DataFrame:
    """Rows with non-null keys: equal ones are copies, and their order is that of the conversation."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    turn = F.col("turn").cast("long")
    return turns.select(
        conversation(F.col("conv_id")).alias("group"),
        turn.isNotNull().alias("has_turn"),
        F.coalesce(turn, F.lit(0)).alias("at"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.left(text, F.lit(32)).alias("head"),
        F.xxhash64(text).alias("mark"),
        F.xxhash64(F.lit(1), text).alias("mark_too"),
        text.alias("text"),
    )


def conversation(conv_id: Column) -> Column:
    """A name of the conversation, also where it has none."""
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


def judged(turns: DataFrame) -> DataFrame:
    """Distinct rows in order, without texts: KEYS, number, n, symbol, blank, duplicate, truncated, staged.

    ``n`` is how often the row is there; blank, duplicate and truncated count its copies by
    their first fault.
    """
    text = F.col("text")
    is_blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    is_cut = ~text.rlike(rf"[.!?]{SPACE}*\z")
    narrow = keyed(turns).select(*KEYS, is_blank.alias("is_blank"), is_cut.alias("is_cut"))
    copies = narrow.groupBy(*KEYS, "is_blank", "is_cut").agg(F.count("*").alias("n"))
    order = [k for k in KEYS if k != "group"]
    rows = numbered(copies.withColumnRenamed("group", "own"), F.col("own"), *order).drop("own")
    said = ["group", "role", "mark", "mark_too"]
    first = rows.groupBy(*said).agg(F.min("number").alias("first"))
    rows = rows.join(first, said)
    is_new = (F.col("number") == F.col("first")) & ~F.col("is_blank")
    initial = F.left("role", F.lit(1))
    place = F.coalesce(F.nullif(F.instr(F.lit(INITIALS[:-1]), initial) * (initial != "").cast("int"), F.lit(0)), F.lit(len(INITIALS)))
    symbol = F.when(is_new, place + F.when(F.col("is_cut"), len(INITIALS)).otherwise(0)).otherwise(0)
    count = lambda faulty, n: F.when(faulty, n).otherwise(0).cast("long")
    return staged(
        rows.select(
            *KEYS, "number", "n", initial.alias("initial"), symbol.cast("int").alias("symbol"),
            count(F.col("is_blank"), F.col("n")).alias("blank"),
            count(~F.col("is_blank"), F.col("n") - is_new.cast("int")).alias("duplicate"),
            count(is_new & F.col("is_cut"), F.lit(1)).alias("truncated"),
        ),
        "judged",
    )


def illegal_pairs(rows: DataFrame) -> DataFrame:
    """group and illegal: neighbours whose initials are not su, ua or au. Copies are neighbours, too."""
    before = rows.select("group", (F.col("number") + 1).alias("number"), F.col("initial").alias("before"))
    pair = F.concat("before", "initial")
    odd = F.when(F.col("before").isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0)
    met = rows.select("group", "number", "initial", "n").join(before, ["group", "number"], "left")
    return met.groupBy("group").agg(F.sum(odd + F.col("n") - 1).alias("illegal"))


@dataclass
class Repair:
    """``rows`` as ``judged`` gives them, ``edits`` as ``solved`` does, and the conversations' own ids."""

    turns: DataFrame
    rows: DataFrame
    edits: DataFrame


def repaired(turns: DataFrame) -> Repair:
    """The cheapest repair of every conversation of conv_id, turn, role and text.

    Rows are taken by turn, nulls first; rows of one turn by role and text. A null role or
    text is one space, so a row with a null text is blank. A null conv_id is a conversation
    of its own. Identical rows are told by two 64-bit hashes of their text. A role of no
    character fits nowhere and must change. Other columns are not read and can have any
    name. An empty table gives no row.
    """
    rows = judged(turns)
    return Repair(turns, rows, staged(solved(rows.select("group", "number", "symbol", "n")), "edits"))


def messages(repair: Repair) -> DataFrame:
    """group, number, letters, cost and the repaired messages (role, text) that stand at each row."""
    copies = keyed(repair.turns).dropDuplicates(list(KEYS))
    placed = repair.rows.select(*KEYS, "number").join(copies, list(KEYS))
    roles = F.split(F.col("roles"), "")
    named = F.create_map(*(F.lit(x) for x in ("u", "user", "a", "assistant", "U", "user", "A", "assistant")))
    said = F.transform(
        F.filter(roles, lambda r: r != ""),
        lambda r: F.struct(
            F.when(r == "K", F.col("role")).otherwise(named[r]).alias("role"),
            F.when(r.isin("u", "a"), "").otherwise(F.col("text")).alias("text"),
        ),
    )
    both = placed.join(repair.edits, ["group", "number"])
    return both.select("group", "number", "letters", "cost", said.alias("messages"))


def digested(messages: DataFrame) -> DataFrame:
    """group, audit, cost and repaired_sha256 of each conversation.

    A hash needs its input in order, so a conversation's messages stream through one task,
    which holds a batch of them and the letters only.
    """
    schema = "group string, audit string, cost long, repaired_sha256 string"

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = arrow_schema(schema)
        group, letters, cost, hashed, begun = None, [], 0, hashlib.sha256(), False
        done: list[tuple] = []
        for batch in batches:
            for own, audit, spent, lines in zip(*(batch.column(c) for c in ("group", "letters", "cost", "lines"))):
                if own.as_py() != group:
                    if group is not None:
                        done.append((group, "".join(letters), cost, hashed.hexdigest()))
                    group, letters, cost, hashed, begun = own.as_py(), [], 0, hashlib.sha256(), False
                letters.append(audit.as_py())
                cost += spent.as_py()
                for line in lines.as_py():
                    hashed.update(("\n" + line if begun else line).encode())
                    begun = True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types.types)], schema=types)
                done = []
        if group is not None:
            last = (group, "".join(letters), cost, hashed.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, types.types)], schema=types)

    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    told = messages.select("group", "number", "letters", "cost", lines.alias("lines"))
    return told.repartition("group").sortWithinPartitions("group", "number").mapInArrow(digest, schema)


def report(repair: Repair, conversations: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conv_id of ``conversations``; zeros where no row is left."""
    turn = F.when(F.col("has_turn"), F.col("at"))
    faults = repair.rows.groupBy("group").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.min(turn).alias("least"), F.max(turn).alias("most"), F.countDistinct(turn).alias("turns"),
    )
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    ids = conversations.select("conv_id").distinct().withColumn("group", conversation(F.col("conv_id")))
    found = faults.join(illegal_pairs(repair.rows), "group").join(digested(messages(repair)), "group")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return ids.join(found, "group", "left").select(
        "conv_id",
        number(gaps).alias("gaps"),
        *(number(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, by a checksum of conversation and turn; nulls are one space."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", filled["role"].alias("role"), filled["text"].alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return (
        rows.where("fault != 0")
        .withColumn("copy", F.explode(copies))
        .select(
            "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.otherwise(F.col("text")).alias("text"),
        )
    )
