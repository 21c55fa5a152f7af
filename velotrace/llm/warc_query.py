"""The query for WARC revisit resolution, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import warc
from velotrace.llm.common import table


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.new_archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH records AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
    CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
ranked AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER same ELSE page_id END AS first,
    CASE WHEN payload_bytes >= 1000 THEN row_number() OVER (same ORDER BY page_id DESC NULLS LAST) ELSE 1 END AS place
  FROM records WINDOW same AS (PARTITION BY payload_digest))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN first END AS refers_to
FROM ranked"""
