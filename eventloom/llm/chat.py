"""Chat formatting: turns of a conversation as one training text with a loss mask.

Relational form: turns are collected as structs, sorted, adjacent turns of one
role are merged under one heading, and everything is concatenated and masked with
array expressions.

Template: ``### role``, newline, text, ``</turn>``, newline; ``<part/>`` stands
between merged turns. A backslash and the three control strings are escaped inside
texts, so that no text can close or open a turn, and reading restores every turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEADING, END, PART = "### ", "</turn>", "<part/>"
#: What stands in a text, and what it becomes; undone from the last to the first.
ESCAPES = (("\\", "\\b"), (END, "\\t"), (PART, "\\p"), (HEADING, "\\h"))
NEWLINE = ("\n", "\\n")


def escaped(text: Column, more: tuple = ()) -> Column:
    for plain, code in (*ESCAPES, *more):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, more: tuple = ()) -> Column:
    for plain, code in reversed((*ESCAPES, *more)):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per ``conv_id``: conv_id, formatted, loss.

    ``turns`` has conv_id, turn, role and text; other columns are not read.
    ``loss`` is an array of (start, length) in code points of ``formatted``, one per
    turn of ``learn_from``, covering its escaped text only.

    Null roles and texts are empty; a null conv_id is a conversation of its own;
    turns of equal number are in order of role, then text, nulls first; repeated
    rows are repeated turns; an empty table gives no row. A conversation becomes
    one row, so it must fit into one.
    """
    piece = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("turns"))

    def lead_in(turn: Column, i: Column) -> Column:
        heading = F.concat(F.lit(HEADING), escaped(turn["role"], (NEWLINE,)), F.lit("\n"))
        same = F.get("turns", i - 1)["role"] == turn["role"]
        return (
            F.when(i == 0, heading)
            .when(same, F.lit(PART))
            .otherwise(F.concat(F.lit(END + "\n"), heading))
        )

    led = sorted_turns.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t, i: F.struct(
                lead_in(t, i).alias("lead"), t["text"].alias("text"), t["role"].alias("role")
            ),
        ).alias("turns"),
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    placed = F.aggregate(  # one pass: where every turn begins
        "turns",
        nothing,
        lambda done, t: F.struct(
            (done["at"] + F.length(t["lead"]) + F.length(t["text"])).alias("at"),
            F.concat(done["starts"], F.array(done["at"] + F.length(t["lead"]))).alias("starts"),
        ),
        lambda done: done["starts"],
    )
    masks = F.zip_with(
        "turns",
        placed,
        lambda t, start: F.when(
            t["role"] == learn_from, F.struct(start.alias("start"), F.length(t["text"]).alias("length"))
        ),
    )
    return led.select(
        "conv_id",
        F.concat(
            F.array_join(F.transform("turns", lambda t: F.concat(t["lead"], t["text"])), ""),
            F.lit(END + "\n"),
        ).alias("formatted"),
        F.filter(masks, lambda m: m.isNotNull()).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    body = F.substr(formatted, F.lit(1), F.length(formatted) - len(END) - 1)

    def of_block(block: Column) -> Column:
        heading = F.substring_index(block, "\n", 1)
        role = unescaped(F.substr(heading, F.lit(len(HEADING) + 1)), (NEWLINE,))
        texts = F.split(F.substr(block, F.length(heading) + 2), PART)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(F.split(body, END + "\n"), of_block))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(
        F.transform(
            loss, lambda m: unescaped(F.substr(formatted, m["start"] + 1, m["length"]))
        ),
        "",
    )
