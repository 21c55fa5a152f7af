"""The query for suffix-array dedup. It has no SQL that ends on whole tables; a test compares it
with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import repeats
from velotrace.llm.common import table


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_counts(table(spark, sf_dir, "documents"))
