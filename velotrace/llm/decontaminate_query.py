"""The query for benchmark decontamination. It has no SQL; a test compares it with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import decontaminate
from velotrace.llm.common import table


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), edited=True)
