"""Benchmark decontamination by BM25 with block-max WAND.

The test items are cut into parts of at most ``PART`` words and indexed: postings by term, in
blocks of neighbouring parts, with the highest weight of each term in each block. Every passage of
every training text, a window of twice ``PART`` words at every ``PART``-th word, is a query. Sums of
block maxima rule out passages and blocks for a whole text at a time; what is left goes through
block-max WAND, which retrieves every part whose score reaches its threshold: a share of the score
that the part's own words would have. A retrieved item counts as leaked if enough of the runs of
five words of its first half, the question, and of its second half, the answer, are in the text.

One changed word breaks up to five runs. With ``edited``, as the queries have it, a half also counts
by its words in order: those that its best alignment with the text around the retrieved passages
keeps. An item with any one word changed, added or left out is then found, beside all that runs find.

The index is read on the driver and sent to the tasks. Its size is checked: larger sets of items
are split by item, and the texts pass each split's index in turn, one index at a time. Weights come
from counts over all items, so the number of splits changes no row.

Defined results: null texts and texts without words contain nothing, and items without words are in
no text; an item of fewer than five words is found where all its words stand in a row, even with
``edited`` unchanged, and scored by the counts of the longer ones; an item that repeats is found
under each of its ids; a text that repeats is found each time. No items find nothing. Other columns
are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.llm.common import map_arrow, unused
from velotrace.operators.joins import small_side
from velotrace.session import written

#: Words of an index part, and of a run that question and answer must share with a text.
PART, RUN = 64, 5
#: Parts in a block of the index.
BLOCK = 4
#: Shares of a part's own score, and of the runs of question and answer, that make a leak.
SCORE_SHARE, OVERLAP = 0.75, 0.8
#: Bytes of item texts in one index.
INDEX_BYTES = 8 << 20
K1, B = 1.2, 0.75

_TOKEN = re.compile(r"\w+")
COUNT_SCHEMA = "split int, term string, parts long, words long"
HIT_SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def runs(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(*(words[i:] for i in range(RUN))))


def edits(words: list[str], text: list[str]) -> int:
    """The fewest words to change, add or leave out to have ``words`` in a row in the text."""
    # Myers' bit vectors: bit i of up and down tells how the count changes at word i.
    places: dict[str, int] = {}
    for i, w in enumerate(words):
        places[w] = places.get(w, 0) | 1 << i
    every, last = (1 << len(words)) - 1, 1 << len(words) - 1
    up, down = every, 0
    now = best = len(words)
    for w in text:
        same = places.get(w, 0)
        level = (((same & up) + up) ^ up) | same
        right = down | every & ~(level | up)
        left = up & level
        now += bool(right & last) - bool(left & last)
        best = min(best, now)
        right <<= 1
        up, down = every & (left << 1 | ~(same | down | right)), right & (same | down)
    return best


def in_parts(words: list[str]) -> list[list[str]]:
    """The parts of an item; none if it has no run."""
    return [words[at : at + PART] for at in range(0, len(words), PART)] if len(words) >= RUN else []


class Counts(NamedTuple):
    """Counts over all items: parts, their words, and the parts that hold a term."""

    parts: int
    words: int
    holding: dict[str, int]


class Index:
    """Parts of items in blocks, postings by term, and block maxima, as flat arrays."""

    def __init__(
        self,
        items: list[tuple[int | None, str | None]],
        score_share: float = SCORE_SHARE,
        edited: bool = False,
        counts: Counts | None = None,
    ):
        """counts: those over all items, if these are not all."""
        self.edited, self.split = edited, counts is not None
        self.words: list[list[str]] = []
        self.items: list[tuple[int | None, int, int]] = []  # id, question runs, answer runs
        self.part_item: list[int] = []
        self.question: list[set] = []
        self.answer: list[set] = []
        parts: list[list[str]] = []
        short: list[tuple[int | None, tuple[str, ...]]] = []
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
            words = tokens(text)
            if len(words) < RUN:
                if words:
                    short.append((item_id, tuple(words)))
                continue
            found = runs(words)
            half = math.ceil(len(words) / 2)
            question, answer = set(found[:half]), set(found[half:])
            self.items.append((item_id, len(question), len(answer)))
            self.words.append(words)
            for at, part in zip(range(0, len(words), PART), in_parts(words)):
                parts.append(part)
                # Runs belong to the part they start in; a window holds the words that follow.
                mine = found[at : at + PART]
                cut = max(0, half - at)
                self.part_item.append(len(self.items) - 1)
                self.question.append(set(mine[:cut]))
                self.answer.append(set(mine[cut:]))

        self.size = len(parts)
        self.blocks = -(-self.size // BLOCK)
        df = Counter(t for p in parts for t in set(p))
        self.term = {t: i for i, t in enumerate(sorted(df))}
        counts = counts or Counts(self.size, sum(map(len, parts)), df)
        mean = counts.words / max(1, counts.parts)
        idf = {t: math.log(1 + (counts.parts - n + 0.5) / (n + 0.5)) for t, n in counts.holding.items()}
        self.short: dict[tuple[str, ...], list[tuple[int | None, float]]] = {}
        for item_id, own in short:
            score = 0.0
            for t, tf in Counter(own).items():
                n = counts.holding.get(t, 0)
                weight = math.log(1 + (counts.parts - n + 0.5) / (n + 0.5))
                score += weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / (mean or len(own))))
            self.short.setdefault(own, []).append((item_id, score))
        self.short_lengths = sorted({len(own) for own in self.short})
        lists: list[list[tuple[int, float]]] = [[] for _ in self.term]
        full, most = np.zeros(self.size), np.zeros(self.size)
        for number, part in enumerate(parts):
            for t, tf in Counter(part).items():
                w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(part) / mean))
                lists[self.term[t]].append((number, w))
                full[number] += w
                most[number] = max(most[number], w)
        self.threshold = full * score_share
        if edited:
            # One word less still retrieves an item of one part; of a longer item another part is whole.
            alone = np.array([len(self.words[i]) <= PART for i in self.part_item], dtype=bool)
            self.threshold = np.where(alone, np.minimum(self.threshold, full - most), self.threshold)
        self.lowest = float(self.threshold.min()) if self.size else 0.0
        self.block_threshold = np.full(self.blocks, np.inf)
        np.minimum.at(self.block_threshold, np.arange(self.size) // BLOCK, self.threshold)

        self.part = [[p for p, _ in x] for x in lists]
        self.weight = [[w for _, w in x] for x in lists]
        self.highest = [max(x) for x in self.weight]
        block_max: list[dict[int, float]] = []
        for x in lists:
            best: dict[int, float] = {}
            for p, w in x:
                best[p // BLOCK] = max(best.get(p // BLOCK, 0.0), w)
            block_max.append(best)
        self.block_max = block_max
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in block_max])]).astype(np.int64)
        self.block_of = np.array([b for x in block_max for b in x], dtype=np.int64)
        self.block_weight = np.array([w for x in block_max for w in x.values()])

    def promising(self, ids: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Windows in which some block may reach its threshold, with their different terms.

        ids: the term of each word of a text, -1 for words that no item has.
        """
        windows = max(1, -(-len(ids) // PART) - 1)
        at = np.flatnonzero(ids >= 0)
        cell, term, n = at // PART, ids[at], len(self.term)
        keys = np.concatenate([cell * n + term, (cell - 1) * n + term])
        keys = np.unique(keys[(keys >= 0) & (keys < windows * n)])
        window, term = keys // n, keys % n
        step = max(1, 4_000_000 // max(1, self.blocks))
        for low in range(0, windows, step):
            lo, hi = np.searchsorted(window, [low, low + step])
            w, t = window[lo:hi] - low, term[lo:hi]
            count = self.first[t + 1] - self.first[t]
            if not count.sum():
                continue
            begins = np.cumsum(count) - count
            post = np.repeat(self.first[t] - begins, count) + np.arange(count.sum())
            cells = np.repeat(w, count) * self.blocks + self.block_of[post]
            high = min(step, windows - low)
            bound = np.bincount(cells, self.block_weight[post], high * self.blocks)
            reach = bound.reshape(high, self.blocks) >= self.block_threshold - 1e-9
            for k in np.flatnonzero(reach.any(axis=1)):
                a, b = np.searchsorted(w, [k, k + 1])
                yield low + int(k), t[a:b].tolist()

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: the parts whose score for these terms reaches their threshold."""
        found = []
        cursors = [[self.part[t][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for part, _, t in cursors:
                total += self.highest[t]
                if total >= self.lowest - 1e-9:
                    pivot = part
                    break
            if pivot < 0:
                break
            block = pivot // BLOCK
            upto = [c for c in cursors if c[0] <= pivot]
            bound = sum(self.block_max[t].get(block, 0.0) for _, _, t in upto)
            if bound < self.block_threshold[block] - 1e-9:
                # No part up to the end of the block, or to the next list's part, can reach it.
                after = min([(block + 1) * BLOCK, *(c[0] for c in cursors if c[0] > pivot)])
            elif cursors[0][0] == pivot:
                # Exact, as the order of the terms depends on the split.
                score = math.fsum(self.weight[t][i] for _, i, t in upto)
                if score >= self.threshold[pivot] - 1e-9:
                    found.append((pivot, score))
                after = pivot + 1
            else:
                after = pivot
            for c in upto:
                if c[0] < after:
                    c[1] = bisect_left(self.part[c[2]], after, c[1])
                    c[0] = self.part[c[2]][c[1]] if c[1] < len(self.part[c[2]]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def leaks(self, text: str | None, overlap: float = OVERLAP) -> list[tuple[int | None, float, float, float]]:
        """(item_id, score, question overlap, answer overlap) of the items that a text contains."""
        words = tokens(text)
        out = []
        for n in self.short_lengths:
            for own in self.short.keys() & set(zip(*(words[i:] for i in range(n)))):
                out += [(item_id, score, 1.0, 1.0) for item_id, score in self.short[own]]
        if words and self.size:
            out += self._long(words, overlap)
        return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1:]))

    def _long(self, words: list[str], overlap: float) -> list[tuple[int | None, float, float, float]]:
        get = self.term.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        best: dict[int, tuple[float, set, set]] = {}
        seen: dict[int, list[int]] = {}
        for window, terms in self.promising(ids):
            hits = self.retrieve(terms)
            if not hits:
                continue
            # The last window reaches the end; a run that starts in a part may end after it.
            at = window * PART
            mine = set(runs(words[at : at + 2 * PART + RUN - 1]))
            for part, score in hits:
                old = best.get(part, (0.0, set(), set()))
                best[part] = (
                    max(old[0], score),
                    old[1] | (self.question[part] & mine),
                    old[2] | (self.answer[part] & mine),
                )
                seen.setdefault(self.part_item[part], []).append(at)
        by_item: dict[int, list[tuple[float, set, set]]] = {}
        for part, hit in best.items():
            by_item.setdefault(self.part_item[part], []).append(hit)
        out = []
        for item, hits in by_item.items():
            item_id, n_question, n_answer = self.items[item]
            question = len(set().union(*(h[1] for h in hits))) / max(1, n_question)
            answer = len(set().union(*(h[2] for h in hits))) / n_answer if n_answer else question
            found = question >= overlap and answer >= overlap
            if self.edited and not found:
                in_order = self.in_order(item, words, seen[item])
                question, answer = max(question, in_order[0]), max(answer, in_order[1])
                found = (question >= overlap and answer >= overlap) or in_order[2]
            if found:
                out.append((item_id, sum(h[0] for h in hits), question, answer))
        return out


    def in_order(self, item: int, words: list[str], windows: list[int]) -> tuple[float, float, bool]:
        """Shares of the words of question and answer that stand in order around the windows, and
        whether the whole item stands there with one edit at most."""
        own = self.words[item]
        half, near = math.ceil(len(own) / 2), len(own) + RUN
        spans: list[list[int]] = []
        for at in sorted(windows):
            low, high = max(0, at - near), at + 2 * PART + near
            if spans and low <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], high)
            else:
                spans.append([low, high])
        texts = [words[low:high] for low, high in spans]
        question, answer, whole = (min(edits(x, t) for t in texts) for x in (own[:half], own[half:], own))
        return 1 - question / half, 1 - answer / (len(own) - half), whole <= 1


def indexes(benchmark: DataFrame, index_bytes: int = INDEX_BYTES, *, edited: bool = False) -> Iterator[Index]:
    """One index, or several of about ``index_bytes`` bytes of item texts each, built when asked for."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splits = math.ceil(total / index_bytes)
    if splits <= 1:
        yield Index([tuple(row) for row in items.collect()], edited=edited)
        return

    split = F.pmod(F.xxhash64("item_id", "text"), F.lit(splits)).cast("int")
    items = written(items.select(split.alias("split"), "item_id", "text"), "benchmark-items")
    counted = items.select("split", "text").mapInArrow(_count, COUNT_SCHEMA)
    counted = counted.groupBy("split", "term").agg(F.sum("parts").alias("parts"), F.sum("words").alias("words"))
    counted = written(counted, "benchmark-counts")
    parts, words = counted.filter("term is null").agg(F.sum("parts"), F.sum("words")).first()
    holding = counted.filter("term is not null").groupBy("term").agg(F.sum("parts").alias("parts"))
    holding = written(counted.select("split", "term").join(holding, "term"), "benchmark-terms")
    for k in range(splits):
        mine = holding.filter(F.col("split") == k).select("term", "parts")
        counts = Counts(parts or 0, words or 0, dict(tuple(row) for row in mine.collect()))
        rows = items.filter(F.col("split") == k).select("item_id", "text")
        yield Index([tuple(row) for row in rows.collect()], edited=edited, counts=counts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split the parts that hold a term, and under a null term the parts and their words."""
    for batch in batches:
        holding: Counter = Counter()
        length: Counter = Counter()
        for split, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = tokens(text)
            # The terms of a short item are looked up, but it has no part.
            if len(words) < RUN:
                holding.update(dict.fromkeys(((split, t) for t in words), 0))
            for part in in_parts(words):
                holding.update((split, t) for t in (None, *set(part)))
                length[split] += len(part)
        rows = [(k, t, n, length[k] if t is None else 0) for (k, t), n in holding.items()]
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        names = ["split", "term", "parts", "words"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def leaks(documents: DataFrame, benchmark: DataFrame, edited: bool = False) -> DataFrame:
    """One row for each item that a document contains, with ``edited`` also if edited; see HIT_SCHEMA."""

    def found_by(index: Index) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc_id, *hit)
                    for doc_id, text in zip(*(c.to_pylist() for c in batch.columns))
                    for hit in index.leaks(text)
                ]
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        found = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, HIT_SCHEMA)
        return written(found, "benchmark-leaks") if index.split else found

    return reduce(DataFrame.unionByName, map(found_by, indexes(benchmark, edited=edited)))


def without_leaks(documents: DataFrame, benchmark: DataFrame, edited: bool = False) -> DataFrame:
    """The documents, as they are, that contain no item, with ``edited`` no edited one either."""

    def kept_by(index: Index) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not index.leaks(t) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return map_arrow(documents, keep, documents.schema)

    def leaking(index: Index) -> DataFrame:
        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, t in pairs if index.leaks(t)], pa.string())], ["_text"])

        texts = documents.select(digest.alias("_text"), "text")
        return written(texts.mapInArrow(digests, "_text string"), "benchmark-texts")

    digest = F.sha2(F.col("text").cast("binary"), 256)
    texts = None
    for index in indexes(benchmark, edited=edited):
        if not index.split:
            return kept_by(index)
        texts = leaking(index) if texts is None else texts.unionByName(leaking(index))
    # Null texts have no digest and stay.
    texts = written(texts.distinct(), "benchmark-texts")
    key = unused(documents, "text_digest")
    return documents.join(small_side(texts.toDF(key)), digest == F.col(key), "left_anti")
