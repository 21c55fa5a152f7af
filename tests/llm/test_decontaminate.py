"""Decontamination against a plain score of every passage and item."""

import math
import random
from collections import Counter

import corpus_pipeline
from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from velotrace.llm import decontaminate as d
from velotrace.llm import decontaminate_query

ITEM = "item_id long, text string"


def plain_leaks(text, items):
    """All passages, all parts, all words: no index and no bounds."""
    w = d.tokens(text)
    parts = []
    for item_id, t in items:
        own = d.tokens(t)
        if len(own) < d.RUN:
            continue
        parts += [(item_id, own, at, own[at : at + d.PART]) for at in range(0, len(own), d.PART)]
    df = Counter(x for p in parts for x in set(p[3]))
    mean = sum(len(p[3]) for p in parts) / max(1, len(parts))

    def weight(x, part):
        tf = part.count(x)
        idf = math.log(1 + (len(parts) - df[x] + 0.5) / (df[x] + 0.5))
        return idf * tf * (d.K1 + 1) / (tf + d.K1 * (1 - d.B + d.B * len(part) / mean))

    hits = {}
    for k in range(max(1, -(-len(w) // d.PART) - 1)):
        at = k * d.PART
        window = set(w[at : at + 2 * d.PART])
        if k == max(1, -(-len(w) // d.PART) - 1) - 1:
            window = set(w[at:])
        found = set(d.runs(w[at : at + 2 * d.PART + d.RUN - 1]))
        for item_id, own, begin, part in parts:
            full = sum(weight(x, part) for x in set(part))
            if sum(weight(x, part) for x in set(part) & window) >= d.SCORE_SHARE * full - 1e-9:
                runs = d.runs(own)[begin : begin + d.PART]
                half = max(0, math.ceil(len(own) / 2) - begin)
                q, a = hits.setdefault((item_id, tuple(own)), (set(), set()))
                q |= set(runs[:half]) & found
                a |= set(runs[half:]) & found
    out = []
    for (item_id, own), (q, a) in hits.items():
        runs, half = d.runs(own), math.ceil(len(own) / 2)
        nq, na = len(set(runs[:half])), len(set(runs[half:]))
        x = len(q) / max(1, nq)
        y = len(a) / na if na else x
        if x >= d.OVERLAP and y >= d.OVERLAP:
            out.append((item_id, round(x, 9), round(y, 9)))
    return sorted(out, key=str)


def tables(frame):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, rng.randrange(5, 60), 300)).capitalize() + ".") for i in range(40)]
    items += [(100, " ".join(words(rng, 400))), (101, "too short"), (102, None), (103, ""), (104, items[0][1]), (None, items[1][1])]
    rows = [(i, " ".join(words(rng, rng.randrange(1, 500), 300))) for i in range(60)]
    for k in range(30):
        w = words(rng, rng.randrange(0, 400), 300)
        at = rng.randrange(len(w) + 1)
        own = items[k][1].split()
        if k % 3 == 1:
            own = own[: len(own) // 2]
        if k % 3 == 2:
            own = [x.upper() for x in own]
            own[rng.randrange(len(own))] = "changed"
        rows.append((1000 + k, " ".join(w[:at] + own + w[at:])))
    rows += [(2000, " ".join(words(rng, 70)) + " " + items[40][1]), (2001, items[40][1][:900]), (None, items[5][1]), (1000, rows[60][1])]
    rows += [(3000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    return items, rows


def test_same_as_plain_scores(frame):
    items, rows = tables(frame)
    bench = frame(ITEM + ", lang string, score int", *[(*i, "x", 1) for i in items])
    got = d.leaks(documents(frame, rows, extra=True), bench).collect()
    found = sorted(str((r.doc_id, r.item_id, round(r.question_overlap, 9), round(r.answer_overlap, 9))) for r in got)
    want = sorted(str((i, *hit)) for i, t in rows for hit in plain_leaks(t, items))
    assert found == want and len(want) > 15 and all(r.score > 0 for r in got)
    assert any(r.doc_id == 2000 and r.item_id == 100 for r in got)
    assert not any(r.doc_id == 2001 for r in got)


def test_clean_documents_stay_as_they_are(frame):
    items, rows = tables(frame)
    table, bench = documents(frame, rows, extra=True), frame(ITEM, *items)
    kept = d.without_leaks(table, bench)
    assert kept.columns == table.columns
    want = sorted(str((i, t)) for i, t in rows if not plain_leaks(t, items))
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want


def test_split_indexes_find_the_same(frame, monkeypatch):
    items, rows = tables(frame)
    table, bench = documents(frame, rows), frame(ITEM, *items)
    one = sorted(str((r.doc_id, r.item_id)) for r in d.leaks(table, bench).collect())
    monkeypatch.setattr(d.indexes, "__defaults__", (1000,))
    assert len(list(d.indexes(bench))) > 3
    many = {str((r.doc_id, r.item_id)) for r in d.leaks(table, bench).collect()}
    # Weights differ between splits, but whole items always reach their threshold.
    whole = {str((1000 + k, k)) for k in range(0, 30, 3)}
    assert whole <= many and whole <= set(one)


def test_no_items_and_no_documents(frame, spark):
    none = spark.createDataFrame([], ITEM)
    table = documents(frame, [(1, "a b c d e f g")])
    assert d.leaks(table, none).collect() == [] and d.without_leaks(table, none).count() == 1
    empty = spark.createDataFrame([], DOCUMENTS)
    assert d.leaks(empty, frame(ITEM, (1, "a b c d e f"))).collect() == []
    assert d.leaks(table, frame(ITEM, (1, "a b c d e f"))).first().item_id == 1


def plain_edits(own, text):
    """Row by row, without bit vectors."""
    row = [0] * (len(text) + 1)
    for x in own:
        new = [row[0] + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edits():
    rng = random.Random(5)
    for _ in range(300):
        own, text = words(rng, rng.randrange(1, 80), 6), words(rng, rng.randrange(0, 90), 6)
        assert d.edits(own, text) == plain_edits(own, text)


def test_edited_copies_are_found(frame, spark, tmp_path):
    items, rows = tables(frame)
    table, bench = documents(frame, rows), frame(ITEM, *items)
    found = {(r.doc_id, r.item_id) for r in d.leaks(table, bench, edited=True).collect()}
    assert {(r.doc_id, r.item_id) for r in d.leaks(table, bench).collect()} < found
    assert {(1000 + k, k) for k in range(30) if k % 3 == 2} <= found
    # Nothing else: halves that are not there, and texts without items.
    assert not any(i < 1000 or i < 2000 and (i - 1000) % 3 == 1 for i, _ in found if i is not None)
    assert (2001, 100) not in found
    table.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontaminate_query.op4_benchmark_decontamination(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == found
    kept = {r.doc_id for r in corpus_pipeline.decontamination_stage(spark, table, str(tmp_path)).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in found}


def test_any_single_edit_is_found():
    rng = random.Random(6)
    items = [(n, " ".join(words(rng, n, 300))) for n in (5, 6, 7, 8, 9, 10, 15, 30, 64, 65, 70, 129)]
    index = d.Index(items, edited=True)
    for n, text in items:
        own = text.split()
        for at in range(n):
            for copy in (own[:at] + ["new"] + own[at + 1 :], own[:at] + own[at + 1 :], own[:at] + ["new"] + own[at:]):
                before, after = words(rng, rng.randrange(0, 150), 300), words(rng, rng.randrange(0, 150), 300)
                assert n in {hit[0] for hit in index.leaks(" ".join(before + copy + after))}, (n, at, copy)


def test_any_number_of_indexes_gives_equal_rows(frame, monkeypatch):
    items, rows = tables(frame)
    bench = frame(ITEM, *items)
    # Partial items, whose scores are not those of the items' own words.
    rows = rows + [(5000 + k, " ".join(items[k][1].split()[: -1 - k % 3])) for k in range(40)]
    table = documents(frame, rows, extra=True)

    def results():
        found = [d.leaks(table, bench, edited=x).collect() for x in (False, True)]
        return [sorted(map(str, x)) for x in (*found, d.without_leaks(table, bench, edited=True).collect())]

    one = results()
    for size, least in ((3000, 2), (1200, 6)):
        monkeypatch.setattr(d.indexes, "__defaults__", (size,))
        assert len(list(d.indexes(bench))) >= least
        assert results() == one


def test_short_items_are_found(frame, monkeypatch):
    items = [(1, "Too short!"), (2, "alone"), (3, "one two three four"), (4, "Too, short"), (5, "..."), (6, "a b c d e f g")]
    rows = [(1, "it is too short here"), (2, "too long, short"), (3, "x alone"), (4, "one two three FOUR five"), (5, "alone"), (6, "one two four"), (7, None), (8, "")]
    bench, table = frame(ITEM, *items), documents(frame, rows)
    want = {(1, 1), (1, 4), (3, 2), (4, 3), (5, 2)}

    def found(bench):
        got = d.leaks(table, bench, edited=True).collect()
        assert all(r.score > 0 and r.question_overlap == r.answer_overlap == 1 for r in got)
        return sorted(map(str, got)), {(r.doc_id, r.item_id) for r in got}

    one = found(bench)
    assert one[1] == want and {r.doc_id for r in d.without_leaks(table, bench).collect()} == {2, 6, 7, 8}
    assert found(frame(ITEM, *items[:5]))[1] == want
    monkeypatch.setattr(d.indexes, "__defaults__", (25,))
    assert len(list(d.indexes(bench))) > 1 and found(bench) == one
