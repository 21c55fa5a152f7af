"""The query for the filter interaction audit, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import filter_audit
from velotrace.llm.common import table


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
known AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [len(words) < 100,
     100 * len(list_distinct(words)) < 80 * len(words),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
     regexp_matches(text, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM texts LEFT JOIN known USING (doc_id)),
counts AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest(range(1, 6)) AS i),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places
  FROM letters a JOIN letters b ON b.i <> a.i JOIN letters c ON c.i NOT IN (a.i, b.i)
  JOIN letters d ON d.i NOT IN (a.i, b.i, c.i) JOIN letters e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
steps AS (
  SELECT *, fails[places[step]] AS own,
    list_bool_or(list_transform(places[1:step - 1], lambda p: fails[p])) IS TRUE AS gone,
    len(list_filter(fails, lambda f: f)) = 1 AS single
  FROM counts, orders, (SELECT unnest(range(1, 6)) AS step)),
summed AS (
  SELECT part, filter_order, step, places[step] AS place,
    sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN own AND single THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, place) AS BIGINT) AS shapley
FROM summed"""
