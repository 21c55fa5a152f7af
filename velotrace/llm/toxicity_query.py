"""The query for toxicity. A trained network decides, so it has no SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.llm import toxicity
from velotrace.llm.common import table
from velotrace.llm.quality import held_out

FOLDS, HELD_OUT, TOXIC = 3, 1, 0.7


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels, FOLDS, HELD_OUT)
    return toxicity.score(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )
