"""The query for document fingerprints. Spark's hash has no counterpart in SQL, so it has none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.llm import fingerprint as fp
from velotrace.llm.common import table


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_and_next(table(spark, sf_dir, "documents"))


def edited_and_next(documents: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of the text with its last half replaced, and both likenesses."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fp.with_next(
        texts, {"text": F.col("text"), "fingerprint": fp.fingerprint(F.col("text"))}
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)
    )
    both = (
        rows.withColumn("n_chars", n.cast("long"))
        .withColumn("edited", edited)
        .withColumn("edited_fingerprint", fp.fingerprint(F.col("edited")))
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fp.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fp.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
