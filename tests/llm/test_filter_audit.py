"""The audit: figures by brute force, in both ways of finding repeats, and odd rows."""

import itertools
import random

import numpy as np
import pytest

from tests.llm.fixtures import ODD_TEXTS, documents
from velotrace.llm import filter_audit

WHITE = " \t\n\x0b\x0c\r"


def split(text):
    for c in WHITE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, labels):
    """(part, order, step) -> figures, of rows (doc_id, text, lang)."""
    flags = []
    for doc_id, text, lang in rows:
        text, words = text or "", split(text or "")
        mine = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows),
        }
        own = [r for r in labels if r[0] == doc_id and doc_id is not None]
        flags.append((lang or "", mine, any(q == 1 for _, q, _ in own), any(t == 1 for _, _, t in own)))
    out = {}
    for part in {f[0] for f in flags}:
        mine = [f for f in flags if f[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                left = [f for f in mine if not any(f[1][e] for e in order[: step - 1])]
                gone = [f for f in left if f[1][x]]
                total[x] += len(gone)
                out[part, order, step] = [
                    len(left) - len(gone), len(gone), sum(f[1][x] for f in mine) - len(gone),
                    sum(f[1][x] and sum(f[1].values()) == 1 for f in mine),
                    sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def table_rows(rng):
    texts = ODD_TEXTS + ["A" * 10 + " b", "x # y", "z " * 200, "z " * 200, " ".join(f"w{i}" for i in range(100)), "Same text"]
    texts += [" ".join(f"w{rng.randrange(150)}" for _ in range(rng.randrange(90, 140))) for _ in range(20)]
    rows = [(rng.randrange(60), rng.choice(texts), rng.choice(["en", "fr", None, ""])) for _ in range(150)]
    rows += [(None, "Same text", "en"), (None, "Same text", "en"), (3, "Same text", "en"), (3, "Same text", "de")]
    return rows + [(200 + i, "hot", "en") for i in range(80)] + [(500, "w " * 20_000, "en")]


def figures(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


@pytest.mark.parametrize("sketch_bytes", [filter_audit.SKETCH_BYTES, 0])
def test_by_brute_force(spark, frame, monkeypatch, sketch_bytes):
    monkeypatch.setattr(filter_audit, "TASK_KEYS", 10)
    rng = random.Random(5)
    rows = table_rows(rng)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1)]
    schema = "doc_id long, text string, lang string, mask int, part int, key string, n long, good int"
    docs = frame(schema, *[(*r, 1, 2, "k", 3, 4) for r in rows])
    marks = frame("doc_id long, quality int, toxic int, part string", *[(*r, "p") for r in labels])
    flagged = filter_audit.with_duplicates(docs, filter_audit.masked(docs), sketch_bytes)
    got = figures(filter_audit.interactions(filter_audit.mask_counts(flagged, marks)))
    assert got == brute(rows, labels)
    if sketch_bytes:
        assert figures(filter_audit.audit(docs, marks)) == got


def test_no_rows(spark, frame):
    labels = frame("doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(frame, []), labels).count() == 0
    got = filter_audit.audit(documents(frame, [(1, None), (2, "")]), labels)
    assert got.count() == 600 and got.filter("good_lost > 0").count() == 0


def test_sketch_clears_unique_texts_only(spark, frame):
    rows = [(i, f"text {i}", "s") for i in range(5000)] + [(6000 + i, f"text {i}", "s") for i in range(50)]
    rows += [(7000 + i, "hot", "s") for i in range(1000)]
    docs = documents(frame, rows)
    masked = filter_audit.masked(docs)
    for sketch_bytes in (filter_audit.SKETCH_BYTES, 0):
        left = [r.text for r in filter_audit.possible_repeats(docs, masked, sketch_bytes).collect()]
        assert left.count("hot") == 1000
        assert all(left.count(f"text {i}") == 2 for i in range(50))
        # The sketch errs on few of the unique texts.
        assert len(left) < 1100 + 0.03 * 5000


def test_counters_merge():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63, 3000, dtype=np.int64)
    cells = {}
    for part in (keys[:2000], keys[1500:]):
        for page, data in zip(*filter_audit.counted(part, 8)):
            filter_audit.add(cells.setdefault(page, np.zeros(filter_audit.PAGE, np.uint8)), data)
    seen = np.zeros((8, filter_audit.PAGE), np.int64)
    for page, own in zip(*filter_audit.places(np.concatenate([keys[:2000], keys[1500:]]), 8)):
        seen[page, np.unique(own)] += 1
    for page in range(8):
        assert (np.minimum(seen[page], 2) == cells[page]).all()
        assert (filter_audit.unpack(filter_audit.pack(cells[page])) == cells[page]).all()
