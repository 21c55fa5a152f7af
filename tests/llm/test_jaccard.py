"""The Jaccard join against all pairs, with short and long columns."""

import random
import re

import numpy as np
import pytest

from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from velotrace.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def by_all_pairs(rows, width=4, percent=85):
    sets = {}
    for i, text in rows:
        sets.setdefault(grams(text, width), []).append(i)
    kinds = [s for s in sets if s]
    root = {s: s for s in kinds}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for k, a in enumerate(kinds):
        for b in kinds[k + 1 :]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    smallest = {}
    for s in kinds:
        for i in sets[s]:
            if i is not None:
                smallest[find(s)] = min(i, smallest.get(find(s), i))
    return sorted(
        ((i, len(grams(t, width)), smallest.get(find(grams(t, width))) if grams(t, width) else i) for i, t in rows), key=str
    )


def edited(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def corpus():
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, rng.randrange(4, 120), 400))) for i in range(150)]
    for k in range(4):
        base = words(rng, 150)
        rows += [(1000 + 100 * k + i, edited(rng, base, rng.randrange(0, 8))) for i in range(30)]
    line = words(rng, 30)
    rows += [(2000 + i, " ".join(line + words(rng, rng.randrange(1, 60)))) for i in range(60)]
    rows += [(3000 + i, rows[3][1]) for i in range(20)] + [(3, rows[3][1]), (None, rows[3][1]), (None, "only null ids")]
    rows += [(4000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(5000, " ".join(words(rng, 20_000))), (5001, "same " * 3000), (5002, "same " * 3001)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small, block", [(64, 256), (3, 4)])
def test_same_as_all_pairs(frame, monkeypatch, small, block):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FREQUENT", 5)
    rows = corpus()
    got = jaccard.jaccard_components(documents(frame, rows, extra=True).repartition(5))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == by_all_pairs(rows)


def test_exact_threshold_and_other_widths(frame):
    # 34 of 40 in common is 0.85; one less is not.
    base = [f"g{i}" for i in range(40)]
    rows = [(1, " ".join(base[:37])), (2, " ".join(base)), (3, "z " + " ".join(base[:35]))]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(documents(frame, rows), width=1, percent=85).collect()}
    want = {i: c for i, _, c in by_all_pairs(rows, 1, 85)}
    assert got == want


def test_one_of_each_and_no_rows(frame, spark):
    rows = corpus()
    table = documents(frame, rows, extra=True)
    kept = jaccard.one_of_each(table)
    assert kept.columns == table.columns
    want = sorted(str(i) for i in {c for i, _, c in by_all_pairs(rows) if i is not None}) + ["None", "None"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(want)
    none = spark.createDataFrame([], DOCUMENTS)
    assert jaccard.jaccard_components(none).collect() == [] and jaccard.one_of_each(none).collect() == []


def test_frequent_counters_never_lose_a_frequent_value():
    rng = np.random.default_rng(1)
    frequent = jaccard.Frequent(counters=50)
    for _ in range(40):
        frequent.add(np.concatenate([rng.integers(100, 10**6, 400), np.full(40, 7)]).astype(np.uint64))
        frequent.settle()
    assert 7 in frequent.values and len(frequent.values) <= 50


def test_overlaps_of_blocks():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(30)]
    got = jaccard.overlaps(sets[:12], sets[12:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def test_rows_that_share_an_id_are_judged_by_their_texts(frame):
    rng = random.Random(8)
    a, b, c = (" ".join(words(rng, 60)) for _ in range(3))
    rows = [(0, a), (1, a), (1, b), (1, b), (2, c), (2, edited(rng, c.split(), 1)), (None, a), (None, a)]
    kept = [(r.doc_id, r.text) for r in jaccard.one_of_each(documents(frame, rows, extra=True), 5, 80).collect()]
    assert sorted((i, t) for i, t in kept if i is not None) == sorted([(0, a), (1, b), *[x for x in kept if x[0] == 2]])
    assert sum(i == 2 for i, _ in kept) == 1 and sum(i is None for i, _ in kept) == 2


@pytest.mark.parametrize("small", [2, 64])
def test_near_copies_that_only_link_in_a_chain(frame, monkeypatch, small):
    """Families whose members link with few of the others, in short and in long columns."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng, rows = random.Random(3), []
    for family in range(3):
        text = [f"f{family}w{i}" for i in range(90)]
        for step in range(40):
            rows.append((1000 * family + step, " ".join(text)))
            text = list(text)
            at = 2 * step % 90
            text[at : at + 2] = [f"n{rng.randrange(10**6)}", f"n{rng.randrange(10**6)}"]
    got = sorted(map(tuple, jaccard.jaccard_components(documents(frame, rows)).collect()), key=str)
    assert got == by_all_pairs(rows)


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_sets_with_few_long_entries_share_a_short_one(percent):
    """What ``needed-entries`` rests on: linked sets share at least spare(n) kept entries, for the n of either."""

    def outside(n):
        return jaccard.needed(n, percent) - 1 - jaccard.spare(n)

    for a in range(1, 400):
        for b in range(a, 100 * a // percent + 1):
            # Linked sets share this much at least, and the set that ends first may hold some outside.
            shared = jaccard.needed(b, percent) - max(outside(a), outside(b))
            assert shared >= 1 and shared >= jaccard.spare(a) and shared >= jaccard.spare(b)
