"""The training-text pipeline: from documents to a mix, one stage after another.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last
return the columns of ``documents``; the last returns what the mix takes of each document.

Defined results: stages keep rows with null or empty texts unless the quality model rejects them,
and no documents give no rows; the operators' docstrings state the other cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import decontaminate, jaccard, repeats
from velotrace.llm.common import table
from velotrace.llm.mixing_query import mixed_documents
from velotrace.llm.quality_query import accepted
from velotrace.session import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return accepted(docs, docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a similarity of 0.8 of five-word runs."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeated passages cover."""
    return repeats.cleaned(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, edited or not."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), edited=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a mix by source weights takes of each document."""
    return mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeat_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
]

#: A trained model decides in the first stage, so no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
