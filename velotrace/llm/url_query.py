"""The query for URL filters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import url_filter
from velotrace.llm.common import table

#: (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_filter.judge_pages(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(str(rule) for rule in RULES)

SQL = rf"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
tags AS (
  SELECT url, regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>') AS canonical,
    regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>') AS refresh
  FROM pages WHERE contains(url, '://')),
targets AS (
  SELECT url, unnest([regexp_extract(canonical, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(refresh, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS target FROM tags),
pieces AS (
  SELECT url, substr(url, strpos(url, '://') + 3) AS rest FROM pages WHERE contains(url, '://')),
tidied AS (
  SELECT url, regexp_replace(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^(www|m)\.', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '(\.html?|/)$', '') AS path,
    list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_\w+|ref|fbclid|gclid)(=|$)')) AS asked
  FROM pieces),
links AS (
  SELECT url AS a, 'https://' || host || path
    || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS b
  FROM tidied WHERE host <> ''
  UNION SELECT url, CASE WHEN contains(target, '://') THEN target ELSE split_part(url, '://', 1) || '://'
      || regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1) || target END
  FROM targets WHERE contains(target, '://') OR starts_with(target, '/')),
both_ways AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reached(url, other) AS (
  SELECT a, b FROM both_ways
  UNION SELECT r.url, e.b FROM reached r JOIN both_ways e ON r.other = e.a),
known AS (
  SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM both_ways),
parts AS (
  SELECT url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM known),
split AS (
  SELECT url, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT url, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY url),
spoiled AS (
  SELECT DISTINCT r.url FROM reached r JOIN ruled o ON r.other = o.url WHERE o.rule_verdict = 'block')
SELECT p.page_id, coalesce(s.host, '') AS host, coalesce(s.path, '') AS path, u.rule,
  CASE WHEN u.rule IS NOT NULL THEN u.rule_verdict WHEN x.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM pages p LEFT JOIN split s ON p.url = s.url LEFT JOIN ruled u ON p.url = u.url
LEFT JOIN spoiled x ON p.url = x.url"""
