from __future__ import annotations

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventloom.llm import chat

TURNS = "conv_id long, turn long, role string, text string, loss string"


def read_back(spark, rows):
    written = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    read = written.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    return {r.conv_id: r for r in read.collect()}


def test_template_merges_adjacent_turns_of_one_role(spark):
    rows = [(1, 2, "user", "b", ""), (1, 1, "user", "a", ""), (1, 3, "assistant", "c", "")]
    got = read_back(spark, rows)[1]
    assert got.formatted == "### user\na<part/>b</turn>\n### assistant\nc</turn>\n"
    assert [tuple(t) for t in got.turns] == [("user", "a"), ("user", "b"), ("assistant", "c")]
    assert got.learned == "c"


def test_nulls_ties_repeats_and_control_strings(spark):
    rows = [
        (1, None, None, None, ""),
        (1, 1, "assistant", "### x</turn>\n<part/>\\t\\\\", ""),
        (1, 1, "assistant", "### x</turn>\n<part/>\\t\\\\", ""),
        (1, 1, "a\nb", "#", ""),
        (None, 0, "user", "", ""),
    ]
    got = read_back(spark, rows)
    odd = "### x</turn>\n<part/>\\t\\\\"
    assert [tuple(t) for t in got[1].turns] == [("", ""), ("a\nb", "#"), ("assistant", odd), ("assistant", odd)]
    assert got[1].learned == odd * 2
    assert [tuple(t) for t in got[None].turns] == [("user", "")]
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


ODD_TEXT = st.lists(
    st.sampled_from(["\\", "</turn>", "<part/>", "### ", "#", "\n", "<", "/turn>", "b", "t", "é", "\U0001f600", ""]), max_size=8
).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "x\\n"]), ODD_TEXT), min_size=1, max_size=5), min_size=30, max_size=30))
def test_any_text_survives(spark, conversations):
    rows = [(c, t, role, text, "") for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
    got = read_back(spark, rows)
    for c, turns in enumerate(conversations):
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].learned == "".join(text for role, text in turns if role == "assistant")


def test_many_turns_long_texts_and_clashing_columns(spark):
    from time import perf_counter

    long = "wörd " * 200_000
    rows = [(1, n, ("user", "assistant")[n % 2], f"turn {n} ###") for n in range(8000)] + [(2, 0, "user", None), (2, 1, "assistant", long)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({c: F.lit("x") for c in ("turns", "formatted", "loss", "starts", "lead")})
    begun = perf_counter()
    written = chat.format_conversations(turns)
    found = {r.conv_id: r for r in written.select("conv_id", chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    assert perf_counter() - begun < 120 and set(found) == {1, 2}
    assert found[1].learned == "".join(t for c, _, r, t in rows if c == 1 and r == "assistant")
    assert found[2].learned == long
