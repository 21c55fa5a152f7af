"""Mixing: targets, schedule, whole blocks, and odd tables."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from velotrace.llm import mixing


def corpus(frame, extra=False):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randrange(5, 400))), f"s{i % 4 if i % 3 else 0}") for i in range(300)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(5, "same row twice", "s1"), (5, "same row twice", "s1"), (None, "no id", "tiny")]
    return documents(frame, rows, extra)


def reshared(sizes, weights, share=1.5, repeats=2):
    """Targets by giving the excess to the others again and again."""
    target, open_, left = {}, set(sizes), share * sum(sizes.values())
    while open_:
        whole = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / whole > repeats * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / whole for s in open_}
        target |= {s: repeats * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_targets_equal_resharing_and_are_met(frame):
    got = mixing.mix(corpus(frame, extra=True), block=16)[1].collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = reshared(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 16 * 8
    assert len(got) == 300 + len(ODD_TEXTS) + 3


def test_reruns_agree_and_prefixes_are_near_the_targets(frame):
    rows = corpus(frame)
    slots, counts = mixing.mix(rows, block=16)
    again = mixing.mix(rows.repartition(7), block=16)[1]
    key = ("doc_id", "source", "size", "taken")
    assert sorted(map(str, counts.select(*key).collect())) == sorted(map(str, again.select(*key).collect()))
    whole = {r.source: r.target for r in counts.select("source", "target").distinct().collect()}
    half = slots.filter(F.col("slot") < sum(whole.values()) / 16 / 2)
    for r in half.groupBy("source").agg(F.sum("words").alias("words")).collect():
        assert abs(r.words - whole[r.source] / 2) <= 16 * 12


def test_slots_take_whole_blocks(frame):
    slots = mixing.mix(corpus(frame), block=16)[0]
    sizes = [r.words for r in slots.groupBy("slot").agg(F.sum("words").alias("words")).collect()]
    assert max(sizes) == 16 and sum(s < 16 for s in sizes) <= 12


def test_van_der_corput_points(spark):
    got = [r.p for r in spark.range(8).select(mixing.radical_inverse(F.col("id")).alias("p")).collect()]
    assert got == [0, 0.5, 0.25, 0.75, 0.125, 0.625, 0.375, 0.875]


def test_no_rows_and_no_words(frame, spark):
    assert mixing.mix(spark.createDataFrame([], DOCUMENTS))[1].collect() == []
    got = mixing.mix(documents(frame, [(1, None), (2, " ")]))[1].collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
