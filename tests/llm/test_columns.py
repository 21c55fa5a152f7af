"""Stages that keep the columns of their documents keep odd ones too."""

import pytest

from tests.llm.fixtures import words
from velotrace.llm import decontaminate, jaccard, repeats
from velotrace.llm.quality_query import accepted

ODD = ["meta.lang", "_quality", "_kept", "_size", "_text_id", "score", "own", "size", "kept", "a b", "_text"]


def odd_documents(spark):
    import random

    rng = random.Random(1)
    shared = " ".join(words(rng, 80))
    texts = [" ".join(words(rng, 50)) + (f" {shared}" if i % 4 == 0 else "") for i in range(40)]
    texts += [texts[1], None, "", "JUNK " * 30]
    rows = [(i, t, *[f"{c}{i}" for c in ODD]) for i, t in enumerate(texts)]
    names = ["doc_id", "text", *ODD]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in ODD)
    return spark.createDataFrame(rows, schema), names


@pytest.mark.parametrize("stage", ["quality", "near", "repeats", "leaks"])
def test_odd_columns_pass(spark, frame, stage):
    docs, names = odd_documents(spark)
    labels = frame("doc_id long, quality int, toxic int", *[(i, int(i < 43), 0) for i in range(44)])
    items = frame("item_id long, text string", (1, docs.filter("doc_id = 5").first().text))
    out = {
        "quality": lambda: accepted(docs, docs, labels),
        "near": lambda: jaccard.one_of_each(docs, 5, 80),
        "repeats": lambda: repeats.cleaned(docs),
        "leaks": lambda: decontaminate.without_leaks(docs, items, edited=True),
    }[stage]()
    rows = out.collect()
    assert out.columns == names and rows
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in ODD)
