"""Fingerprints: the hashes against a plain version, likeness against Jaccard, and odd texts."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from velotrace.llm import fingerprint as fp
from velotrace.llm.fingerprint_query import edited_and_next

GAP = re.compile(r"[\x20\x09-\x0D]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64((v % (1 << 64)).to_bytes(8, "little"), seed).intdigest()
    return signed(seed)


def plain(text):
    """The fingerprint, bin by bin."""
    w = [signed(xxhash.xxh64(x.encode(), 42).intdigest()) for x in GAP.split(text or "") if x]
    if not w:
        return ""
    grams = [chain(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [chain(w)]
    bins = {}
    for g in grams:
        bins[g >> 57] = min(g, bins.get(g >> 57, g))
    ends = [b for b, g in bins.items() if g & (2**57 - 1) == 2**57 - 1]
    assert not ends
    order = sorted(bins)
    out = []
    for b in range(-64, 64):
        if b not in bins:
            rank = [(chain([b, x]) & -128) | i for i, x in enumerate(order)]
            out.append(bins[order[min(rank) & 127]])
        else:
            out.append(bins[b])
    return "".join(f"{x & 255:02x}" for x in out)


def jaccard(a, b):
    def grams(t):
        w = [x for x in GAP.split(t) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_same_as_bin_by_bin(frame):
    rng = random.Random(2)
    texts = ODD_TEXTS + [" ".join(words(rng, n, 50)) for n in (3, 5, 6, 30, 100, 400, 3000)]
    rows = documents(frame, list(enumerate(texts)), extra=True)
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(rows).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_likeness_is_near_jaccard(frame):
    rng = random.Random(3)
    pairs = []
    for i in range(60):
        a = words(rng, 600)
        b = list(a)
        for _ in range(i * 2):
            b[rng.randrange(len(b))] = "new"
        pairs.append((i, " ".join(a), " ".join(b)))
    rows = frame("i long, a string, b string", *pairs).select(
        "i", fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("x")
    )
    errors = [r.x - jaccard(*pairs[r.i][1:]) for r in rows.collect()]
    assert max(map(abs, errors)) < 0.17 and abs(sum(errors) / len(errors)) < 0.03


def test_edited_text_and_next_document(frame):
    texts = ["abcdef", "xyz", None, "é漢\U0001f600four", "", "long " * 50]
    ids = [3, 700, 701, -5, 10**12, 256]
    by_id = sorted((i, t or "") for i, t in zip(ids, texts))
    got = {r.doc_id: r for r in edited_and_next(documents(frame, list(zip(ids, texts)))).collect()}
    import hashlib

    assert len(got) == len(ids)
    for k, (i, text) in enumerate(by_id):
        after = by_id[(k + 1) % len(by_id)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.edited_fingerprint == plain(edited) and r.fingerprint == plain(text)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_null_ids_repeats_one_row_and_no_rows(frame, spark):
    rows = documents(frame, [(None, "a b"), (None, "c d"), (1, "e f"), (1, "e f"), (2, "g")])
    assert edited_and_next(rows).count() == 5
    one = edited_and_next(documents(frame, [(1, "a b c d e f")])).first()
    assert one.near_next == 1.0 and one.near_edited == pytest.approx(1.0, abs=1) and one.n_chars == 11
    assert edited_and_next(spark.createDataFrame([], DOCUMENTS)).collect() == []
