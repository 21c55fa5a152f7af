"""The query for the n-gram Jaccard join, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import jaccard
from velotrace.llm.common import table


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
      lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) END AS grams FROM words),
sized AS (SELECT doc_id, len(grams) AS n FROM sets),
entries AS (SELECT doc_id, len(grams) AS n, hash(unnest(grams)) AS gram FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM entries x JOIN entries y
    ON x.gram = y.gram AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized
  UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a)
SELECT s.doc_id, CAST(any_value(s.n) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sized s JOIN reached r ON s.doc_id = r.doc_id GROUP BY s.doc_id"""
