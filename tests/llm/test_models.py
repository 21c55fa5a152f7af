"""Quality and toxicity: gradients, held-out accuracy, determinism, and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from velotrace.llm import quality, quality_query, toxicity, toxicity_query
from velotrace.llm.common import table

MIDDLE = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_measures_of_odd_texts():
    for text in [*ODD_TEXTS, "x " * 100_000, "\ud800 lone"]:
        found = quality.measure(text)
        assert len(found) == len(quality.MEASURES) and np.isfinite(found).all()


def test_trees_fit_steps_and_quadrants():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.train(x, y, rounds=20)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95 and (0, 1) in model.pairs


def test_quality_of_held_out_rows(spark):
    scored = quality_query.op9_quality_classifier(spark, MIDDLE)
    rows = scored.join(table(spark, MIDDLE, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert scored.count() == table(spark, MIDDLE, "documents").count()


def clean_and_toxic(n, seed=9):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = words(rng, rng.randrange(20, 200), 800)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vilest", "lout"]) + rng.choice(["", "ig", "en", "ou"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic), "clash"))
    return rows, labels


def test_toxicity_of_held_out_rows(frame):
    rows, labels = clean_and_toxic(400)
    table_ = documents(frame, rows + [(9000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "x"), (0, rows[0][1])], extra=True)
    more = labels + [(0, None, None, "x"), (None, 1, 1, "x"), (9000, 1, None, "x"), (4, 0, 0, "x"), (4, 0, 1, "x")]
    model = toxicity.fit(table_, frame(LABELS, *more))
    scored = {r.doc_id: r.score for r in toxicity.score(table_, model).collect()}
    held = [(i, kind) for i, _, kind, _ in labels if np.uint32(__import__("zlib").crc32(str(i).encode())) % 3 == 1]
    right = sum((scored[i] >= 0.7) == bool(kind) for i, kind in held)
    assert right >= 0.93 * len(held)
    assert all(0 <= s <= 1 for s in scored.values()) and scored[9000] == scored[9001] == scored[9002] < 0.7


def test_windows_cover_all_words():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        at = toxicity.starts(n)
        assert at[0] == 0 and (n <= 64 or at[-1] + 64 == n)
        assert all(b - a <= toxicity.STRIDE for a, b in zip(at, at[1:]))


def test_network_gradients():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in toxicity.new_weights(rng).items()}
    inputs = toxicity.Words.of(["loser", "abc.", "x", "thinner", "die"])
    ids = rng.integers(0, 5, (3, toxicity.WIDTH))
    mask = np.ones((3, toxicity.WIDTH))
    mask[1, 20:] = 0
    y = np.array([1, 0, 1.0])
    _, g = toxicity.loss_gradients(weights, inputs, ids, mask, y)
    for k in weights:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        old, step = weights[k][at], 1e-3
        weights[k][at] = old + step
        high = toxicity.loss_gradients(weights, inputs, ids, mask, y)[0]
        weights[k][at] = old - step
        low = toxicity.loss_gradients(weights, inputs, ids, mask, y)[0]
        weights[k][at] = old
        assert g[k][at] == pytest.approx((high - low) / 2 / step, rel=1e-3)


@pytest.mark.parametrize("operator, label", [(quality, "quality"), (toxicity, "toxic")])
def test_few_labels_and_no_rows(frame, spark, operator, label):
    rows = documents(frame, [(i, f"some text {i}") for i in range(6)] + [(None, None)])
    none = spark.createDataFrame([], LABELS)
    found = operator.score(rows, operator.fit(rows, none)).collect()
    assert len(found) == 7 and {r.score for r in found} == {0.5}
    ones = frame(LABELS, *[(i, 1, 1, "") for i in range(6)])
    assert all(r.score > 0.9 for r in operator.score(rows, operator.fit(rows, ones)).collect())
    empty = spark.createDataFrame([], DOCUMENTS)
    assert operator.score(empty, operator.fit(empty, none)).collect() == []


def test_labels_of_held_out_rows_do_not_matter(frame):
    labels = [(i, i % 2, 0, "") for i in range(300)]
    changed = [(i, (1 - q) if __import__("zlib").crc32(str(i).encode()) % 5 == 0 else q, 0, "") for i, q, _, _ in labels]
    chosen = [
        sorted(map(tuple, quality.training_labels(frame(LABELS, *x), "quality", 5, 0, 1000).collect())) for x in (labels, changed)
    ]
    assert chosen[0] == chosen[1] and len(chosen[0]) > 200


def test_accepted_keeps_columns(frame):
    rng = random.Random(3)
    rows = [(i, " ".join(words(rng, 60)) if i % 3 else "JUNK!! " * 40) for i in range(120)]
    table_ = documents(frame, rows, extra=True)
    labels = frame(LABELS, *[(i, int(i % 3 > 0), 0, "") for i in range(120)])
    kept = quality_query.accepted(table_, table_, labels)
    assert kept.columns == table_.columns
    assert {r.doc_id for r in kept.select(F.col("doc_id")).collect()} == {i for i in range(120) if i % 3}
    assert toxicity_query.TOXIC == 0.7
