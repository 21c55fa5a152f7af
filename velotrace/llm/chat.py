"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role become
one message, and the messages are concatenated to one string. Markers start with ``<``. Inside
roles and texts ``\\`` is written ``\\s``, ``<`` is written ``\\l`` and, in roles, ``|`` is written
``\\p``, so no text can form a marker and every text can be read back exactly.

A message is ``<|role|>`` and a line feed, its texts with ``<|and|>`` between them, and ``<|end|>``
and a line feed.

Defined results: a null or empty text is an empty turn; a null role is the empty role; a null
conversation id is a conversation of its own; turns with equal numbers, and repeated rows, are all
kept, in the order of turn (null first), role and text. No rows give no rows. Other columns are
ignored. A conversation is one row of the result, so its turns meet in one task by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.llm.common import let

ASSISTANT = "assistant"
HEAD, HEAD_END, JOINT, END = "<|", "|>\n", "<|and|>", "<|end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("|"), F.lit("\\p"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\p"), F.lit("|")))


def _segments(turns: Column, loss_role: str) -> Column:
    """Pieces of the formatted string in order; ``loss`` marks what a model is trained on.

    Each turn gives what stands before its text, the text, and what stands after it: a head where
    the role changes, a joint between turns of one message, an end where the message ends.
    """

    def pieces(turn: Column, i: Column) -> Column:
        first = (i == 0) | (F.get(turns, i - 1)["role"] != turn["role"])
        last = (i == F.size(turns) - 1) | (F.get(turns, i + 1)["role"] != turn["role"])
        head = F.concat(F.lit(HEAD), escaped_role(turn["role"]), F.lit(HEAD_END))

        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        return F.array(
            piece(F.when(first, head).otherwise(F.lit(JOINT)), F.lit(False)),
            piece(escaped(turn["text"]), turn["role"] == loss_role),
            piece(F.when(last, F.lit(END)).otherwise(F.lit("")), F.lit(False)),
        )

    return F.flatten(F.transform(turns, pieces))


def format_chats(conversations: DataFrame, loss_role: str = ASSISTANT) -> DataFrame:
    """(conv_id, turn, role, text) to (conv_id, formatted, segments).

    ``formatted`` is the concatenation of the segments' texts; the loss mask is the ``loss`` flag
    of each segment.
    """
    rows = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("row"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    return chats.select(
        "conv_id", let(F.col("turns"), lambda t: _segments(t, loss_role)).alias("segments")
    ).select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def parse_chats(formatted: Column) -> Column:
    """The turns of a formatted string, as array<struct<role, text>>."""

    def turns(message: Column) -> Column:
        role = unescaped_role(F.substring_index(message, HEAD_END, 1).substr(F.lit(3), F.length(message)))
        body = message.substr(
            F.length(F.substring_index(message, HEAD_END, 1)) + len(HEAD_END) + 1, F.length(message)
        )
        return F.transform(
            F.split(body, r"<\|and\|>", -1),
            lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")),
        )

    messages = F.split(formatted, r"<\|end\|>\n", -1)
    return F.flatten(F.transform(F.slice(messages, 1, F.size(messages) - 1), lambda m: let(m, turns)))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescaped(s["text"])), "")
