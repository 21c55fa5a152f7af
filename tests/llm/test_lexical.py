"""Ranked search: scores by brute force, blocks, ties and odd rows."""

import math
import random
import re

import numpy as np

from tests.llm.fixtures import ODD_TEXTS, documents
from velotrace.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, keep=50):
    docs = [(d, terms(t)) for d, t in rows]
    n_docs, n_words = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, own in wanted.items():
        found = []
        weight = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in set(x) for _, x in docs) + 1))) for t in own
        }
        for doc_id, words in docs:
            score = 0
            for t in own & set(words):
                m = 100 - 50 + (50 * len(words) * n_docs) // n_words
                tf = words.count(t)
                score += weight[t] * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(found)[:keep], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return out


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def got(df):
    return sorted(map(tuple, df.collect()), key=key)


def corpus(rng):
    vocabulary = [f"{a}{b}" for a in ("th", "Er", "é", "x9", "漢") for b in ("", "an", "in", "ÉA", "字")]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(7, "than than"), (7, "than than"), (None, "than erin"), (None, "zzz"), (-5, "thin;THIN_thin\x00thin\x7fthin")]
    rows += [(2000 + i, "A copy with THAN and erin") for i in range(80)] + [(3000, "than " * 30_000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(12))) for i in range(12)]
    items += [(50, None), (51, "..."), (52, "nowhere"), (53, "copy, with Copy"), (53, "th"), (None, "erin"), (None, "THAN")]
    return rows, items


def test_by_brute_force(spark, frame, monkeypatch):
    rows, items = corpus(random.Random(3))
    docs = documents(frame, rows, extra=True)
    wanted = frame("item_id long, text string, doc_id long, score double, rank int", *[(*i, 1, 0.5, 2) for i in items])
    want = sorted(brute(rows, items), key=key)
    assert got(lexical.search(docs, wanted)) == want
    # Small blocks, batches and slices change nothing.
    monkeypatch.setattr(lexical, "SCORES", 20)
    monkeypatch.setattr(lexical, "SCAN_BYTES", 100)
    assert got(lexical.search(docs.repartition(5), wanted, block_bytes=60)) == want
    assert got(lexical.search(docs, wanted, keep=3)) == sorted(brute(rows, items, 3), key=key)


def test_no_rows(spark, frame):
    items = frame("item_id long, text string", (1, "a"))
    assert got(lexical.search(documents(frame, []), items)) == []
    assert got(lexical.search(documents(frame, [(1, None), (2, "..")]), items)) == []
    assert got(lexical.search(documents(frame, [(1, "a b"), (2, "c")]), frame("item_id long, text string"))) == []


def test_the_automaton_finds_whole_terms():
    words = [b"a", b"ab", b"b", "é".encode()]
    machine = lexical.automaton("test", words)
    at, term, count = lexical.scan(machine, [lexical.folded(t) for t in ("A ab,ab  b", "", "abé éa é", None, "b")], 4)
    assert list(zip(at, term, count)) == [(0, 0, 1), (0, 1, 2), (0, 2, 1), (2, 3, 1), (4, 2, 1)]


def test_the_best_are_kept_in_any_order():
    rng = np.random.default_rng(2)
    scores = rng.integers(0, 6, (400, 3))
    best = lexical.Best(3, 7)
    for low in range(0, 400, 50):
        ids = np.arange(low, low + 50)[::-1]
        best.add(scores[ids], ids, ids % 9 == 0)
    found = list(zip(*best.held))
    for item in range(3):
        want = sorted((-scores[i, item], i % 9 == 0, i) for i in range(400) if scores[i, item] > 0)[:7]
        assert [(s, d) for k, s, _, d in found if k == item] == [(-s, d) for s, _, d in want]
