"""The query for chat formatting, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.llm import chat
from velotrace.llm.common import let, table

#: A conversation whose texts look like markers and escapes.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], rows.schema
    )
    chats = chat.format_chats(rows.unionByName(probe))
    read_back = chats.select(
        "conv_id",
        chat.parse_chats(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed AS (
  SELECT *, row_number() OVER o AS place, coalesce(lag(role) OVER o <> role, true) AS opens
  FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(replace(replace(text, '\', '\s'), '<', '\l'))
    + CASE WHEN opens THEN 13 + length(replace(replace(replace(role, '\', '\s'), '<', '\l'), '|', '\p'))
      ELSE 7 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""
