"""The query for ranked lexical search, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import lexical
from velotrace.llm.common import ASCII_LOWER, ASCII_UPPER, table


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    rf"regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS terms FROM documents),
sizes AS (SELECT row_id, doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
occurrences AS (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM texts) GROUP BY ALL),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM occurrences, totals GROUP BY term, docs),
scores AS (
  SELECT item_id, row_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))))) AS BIGINT) AS score
  FROM wanted JOIN occurrences USING (term) JOIN weights USING (term) JOIN sizes USING (row_id), totals
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
