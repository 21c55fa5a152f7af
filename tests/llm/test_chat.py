"""Chat formatting: round trips, odd roles and texts, and the order of turns."""

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD_TEXTS
from velotrace.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def read_back(conversations):
    chats = chat.format_chats(conversations).select(
        "conv_id", "formatted", chat.parse_chats(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
    )
    return {r.conv_id: r for r in chats.collect()}


def test_every_odd_text_comes_back(frame):
    roles = ["user", "assistant", None, "a|b<c>\\", "assistant", "assistant"]
    rows = [(1, i, roles[i % len(roles)], t) for i, t in enumerate(ODD_TEXTS * 3)]
    got = read_back(frame(SCHEMA, *rows))[1]
    assert [(t.role, t.text) for t in got.turns] == [(r or "", t or "") for _, _, r, t in rows]
    assert got.loss == "".join(t or "" for _, _, r, t in rows if r == "assistant")


def test_adjacent_turns_of_a_role_are_one_message(frame):
    got = read_back(frame(SCHEMA, (1, 1, "user", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "c")))[1]
    assert got.formatted == "<|user|>\na<|and|>b<|end|>\n<|assistant|>\nc<|end|>\n"


def test_ties_repeats_nulls_and_extra_columns(frame):
    rows = frame(
        SCHEMA + ", turns string, segments int",
        (None, 0, "user", "x", "t", 1),
        (2, 5, "user", "b", "t", 1),
        (2, 5, "user", "a", "t", 1),
        (2, 5, "user", "a", "t", 1),
        (2, None, "user", "first", "t", 1),
    )
    got = read_back(rows)
    assert [t.text for t in got[2].turns] == ["first", "a", "a", "b"]
    assert [t.text for t in got[None].turns] == ["x"]


def test_a_long_conversation_and_a_long_text(frame):
    rows = [(1, i, "user" if i % 3 else "assistant", f"t{i}<") for i in range(1500)]
    rows.append((2, 0, "assistant", "é<\\" * 200_000))
    got = read_back(frame(SCHEMA, *rows))
    assert [t.text for t in got[1].turns] == [r[3] for r in rows[:-1]]
    assert got[2].loss == rows[-1][3]


def test_no_rows(frame, spark):
    assert read_back(spark.createDataFrame([], SCHEMA)) == {}


@pytest.mark.parametrize("text", ODD_TEXTS[1:])
def test_escapes_leave_no_marker(frame, text):
    row = frame("t string", (text,)).select(chat.escaped(F.col("t")).alias("e")).first()
    assert "<" not in row.e
