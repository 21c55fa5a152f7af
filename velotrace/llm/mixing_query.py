"""The query for mixing sources to target weights, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import mixing
from velotrace.llm.common import table

COLUMNS = ("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame) -> DataFrame:
    return mixing.mix(documents)[1].select(*COLUMNS)


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(table(spark, sf_dir, "documents"))


def sql(documents: str = "documents") -> str:
    """The same rows from a table or a parenthesised query with doc_id, source and text."""
    return rf"""
WITH sizes AS (
  SELECT row_number() OVER () AS row_id, doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM {documents}),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
placed AS (
  SELECT *, [5, 2, 1][1 + place % 3] AS weight, source_size * 2 AS most FROM (
    SELECT *, row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1 AS place FROM by_source)),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - CAST(coalesce(sum(most) OVER upto, 0) AS DOUBLE))
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0) AS DOUBLE) AS level
  FROM placed WINDOW upto AS (
    ORDER BY CAST(most AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (
  SELECT level FROM levels WHERE level * weight <= most
  ORDER BY CAST(most AS DOUBLE) / weight, level LIMIT 1),
targets AS (
  SELECT p.*, least(CAST(most AS DOUBLE), c.level * weight) AS target FROM placed p, chosen c),
laid AS (
  SELECT *, sum(target) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto,
    sum(target) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole
  FROM targets),
bounds AS (
  SELECT *, coalesce(lag(upto / whole) OVER (ORDER BY place), 0.0) AS low, upto / whole AS high FROM laid),
points AS (
  SELECT i, list_sum(list_transform(range(0, 52), lambda b: ((i >> b) & 1) * pow(2.0, -(b + 1)))) AS point
  FROM (SELECT unnest(range(CAST(ceil((SELECT sum(target) FROM targets) / 128) AS BIGINT))) AS i)),
slots AS (
  SELECT place, row_number() OVER (PARTITION BY place ORDER BY i) - 1 AS rank
  FROM points JOIN bounds ON point >= low AND point < high),
streams AS (
  SELECT s.*, b.place, b.source_size, b.target, coalesce(sum(size) OVER (
      PARTITION BY b.place ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix'), doc_id, size, row_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sizes s JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source),
passes AS (
  SELECT row_id, place, size, CAST(start + pass * source_size AS BIGINT) AS start
  FROM streams, (SELECT unnest([0, 1]) AS pass) WHERE size > 0),
pieces AS (
  SELECT *, unnest(range(start // 128, (start + size - 1) // 128 + 1)) AS rank FROM passes),
taken AS (
  SELECT row_id, sum(least(start + size, (rank + 1) * 128) - greatest(start, rank * 128)) AS taken
  FROM pieces JOIN slots USING (place, rank) GROUP BY row_id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM streams LEFT JOIN taken USING (row_id)"""


SQL = sql()
