"""The query for document quality. A trained model decides, so it has no SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.llm import quality
from velotrace.llm.common import table, unused

FOLDS, HELD_OUT, ACCEPT = 5, 0, 0.3


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(documents, labels, FOLDS, HELD_OUT)
    scored = quality.score(documents, model)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(documents: DataFrame, train_on: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model fitted on ``train_on`` does not reject, as they are."""
    model = quality.fit(train_on, labels, FOLDS, HELD_OUT)
    name = unused(documents, "score")
    scored = quality.score(documents, model, tuple(documents.columns), name)
    return scored.filter(F.col(name) >= ACCEPT).drop(name)
