"""Repeated passages against a table of all 200-byte strings; suffix orders against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from velotrace.llm import repeats, suffixes


def by_all_strings(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + 200] for _, b in raw for k in range(len(b) - 199))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(6)

    def prose(n):
        return " ".join(words(rng, n, 20_000))

    passage, other = prose(60), "é漢\U0001f600 " * 40
    rows = [(i, prose(rng.randrange(1, 80))) for i in range(30)]
    rows += [(100 + i, f"{prose(20)} {passage} {prose(10)}") for i in range(12)]
    rows += [(200 + i, f"{prose(5)}{other}{prose(5)}") for i in range(3)]
    rows += [(300, passage[:199]), (301, passage[:200]), (302, passage[:201]), (303, prose(30) + passage + passage)]
    rows += [(400, "a" * 3000), (401, "ab" * 700), (402, "abc" * 66), (403, "a" * 201), (404, "b" * 200)]
    rows += [(500, rows[2][1]), (2, rows[2][1]), (None, prose(50)), (None, passage)]
    return rows + [(600 + i, t) for i, t in enumerate(ODD_TEXTS)]


@pytest.mark.parametrize("anchor_bytes", [repeats.ANCHOR_BYTES, 1000])
def test_same_as_all_strings(frame, anchor_bytes):
    rows = corpus()
    got = repeats.removal_counts(documents(frame, rows, extra=True).repartition(4), anchor_bytes).collect()
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == by_all_strings(rows)


def test_cleaned_keeps_rows_and_columns(frame, spark):
    rows = corpus()
    table = documents(frame, rows, extra=True)
    got = repeats.cleaned(table)
    assert got.columns == table.columns
    found = sorted((str(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest(), r.n_chars == len(r.text or "")) for r in got.collect())
    want = sorted((str(i), d, True) for i, _, _, _, d in by_all_strings(rows))
    # Cuts through a character drop the rest of it, which is rare: most texts are the kept bytes.
    same = sum(a == b for a, b in zip(found, want))
    assert [a[0] for a in found] == [b[0] for b in want] and same >= len(want) - 6
    none = spark.createDataFrame([], DOCUMENTS)
    assert repeats.removal_counts(none).collect() == [] and repeats.cleaned(none).collect() == []


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(120):
        text = rng.integers(0, rng.integers(2, 5), rng.integers(1, 120)).astype(np.uint8) * np.uint8(rng.integers(1, 60))
        text = np.tile(text, 3)[:200] if trial % 3 == 0 else text
        raw = text.tobytes() + bytes(500)
        wanted, words_ = rng.random(len(text)) < 0.6, suffixes.words_at(text)
        order = suffixes.suffix_order(text, wanted, words_, 400)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        keys = [raw[i : i + 400] for i in order]
        assert keys == sorted(keys)
        shared = suffixes.common_prefixes(order, words_, 40)
        for k in range(1, len(order)):
            a, b = keys[k][:40], keys[k - 1][:40]
            assert shared[k] == next((j for j in range(40) if a[j] != b[j]), 40)


def test_long_texts_are_cut_alike():
    rng = random.Random(7)
    text = " ".join(words(rng, 250_000, 10**6)).encode()
    anchor, content, first, count, back = repeats.Segments().of(text)
    assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and count.sum() == len(text) - 199
    cut = text[1_100_000:1_400_000]
    again = repeats.Segments().of(cut)
    # Inside, the same bytes give the same segments, wherever the text is cut.
    mine = {(a, c) for a, c in zip(anchor.tolist(), content.tolist())}
    inner = list(zip(again[0].tolist(), again[1].tolist()))[1:-1]
    assert all(x in mine for x in inner)
