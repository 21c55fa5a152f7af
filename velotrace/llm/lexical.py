"""Ranked search of documents for many items by an Aho-Corasick scan of their texts.

1. The distinct terms of the items, each between two guards, become one automaton that every task
   builds from a broadcast list. It runs over the texts, in which all that is no term is a guard, so
   that it finds whole terms only, and gives each document's length and counts of item terms. No
   index of the documents is built; the counts are written, one row per document.
2. Totals over that table give the terms' weights.
3. Tasks turn counts into scores by the lists of items that hold each term, and keep each item's
   best documents; these are ranked in two steps, first over slices of the documents.

Items go in blocks of bounded text, each with an automaton of its own, as many as there need be.
Every document is scored in every block, and results do not depend on the blocks.

Defined results: a null text has no terms; rows that share an item_id, a null one too, are one item
with the terms of all; an item without terms, or without a document that scores above 0, has no
rows; each row of the documents is ranked by itself, without a doc_id last among equal scores; no
documents or no items give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotrace.session import written

#: Bytes of item texts that one automaton serves, about.
BLOCK_BYTES = 4 << 20
#: Bytes of text that are scanned at once, and scores that are held at once.
SCAN_BYTES, SCORES = 1 << 20, 1 << 18
#: Slices of the documents in the first step of ranking.
SLICES = 32
GUARD = b" "

# Bytes of a term are digits, letters, and all above 0x7F; letters are lower-cased.
FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else GUARD[0]
    for b in range(256)
)
COUNT_SCHEMA = "doc_id long, n long, terms array<int>, counts array<long>"
BEST_SCHEMA = "item int, doc_id long, score long"
_built: dict[str, ahocorasick.Automaton] = {}


def folded(text: str | None) -> bytes:
    """The text with terms lower-cased and anything else as guards."""
    return (text or "").encode().translate(FOLDED)


def automaton(name: str, terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds each term between guards; built once in a worker for a block's name."""
    if name not in _built:
        _built.clear()
        machine = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            # One character per byte, which keeps the tree of the automaton narrow.
            machine.add_word((GUARD + term + GUARD).decode("latin-1"), i)
        machine.make_automaton()
        _built[name] = machine
    return _built[name]


class Items:
    """A block of items: its terms, and the items that hold each."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        held: dict[int | None, set[bytes]] = {}
        for item_id, text in rows:
            held.setdefault(item_id, set()).update(folded(text).split())
        self.item_ids = list(held)
        self.terms = sorted(set().union(*held.values()))
        place = {t: i for i, t in enumerate(self.terms)}
        pairs = [(place[t], k) for k, own in enumerate(held.values()) for t in own]
        pairs = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.items = pairs[:, 1]
        self.start = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))


def scan(machine: ahocorasick.Automaton, texts: list[bytes], terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of the folded texts, in the order of text and term."""
    joined = GUARD + GUARD.join(texts) + GUARD
    found = np.fromiter(chain.from_iterable(machine.iter(joined.decode("latin-1"))), dtype=np.int64).reshape(-1, 2)
    # Where the guard after each text stands; a match ends at the guard after its term.
    ends = np.cumsum([len(t) + 1 for t in texts])
    pair, count = np.unique(np.searchsorted(ends, found[:, 0]) * terms + found[:, 1], return_counts=True)
    return pair // terms, pair % terms, count


def term_counts(documents: DataFrame, items: Items, name: str) -> DataFrame:
    """Length and counts of item terms of each document; written once."""
    spark = documents.sparkSession
    shared, size = spark.sparkContext.broadcast(items.terms), len(items.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(name, shared.value)
        for batch in batches:
            ids = batch.column(0)
            for low, high in _runs(pc.binary_length(batch.column(1)).to_pylist(), SCAN_BYTES):
                texts = [folded(t) for t in batch.column(1).slice(low, high - low).to_pylist()]
                at, term, times = scan(machine, texts, size)
                offsets = pa.array(np.searchsorted(at, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low),
                        pa.array([len(t.split()) for t in texts], pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return written(rows.mapInArrow(count, COUNT_SCHEMA), "term-counts")


def _runs(sizes: list[int | None], most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours of about ``most`` in all; a larger one stands alone."""
    low, held = 0, 0
    for i, size in enumerate(sizes):
        if i > low and held + (size or 0) > most:
            yield low, i
            low, held = i, 0
        held += size or 0
    if sizes:
        yield low, len(sizes)


def holding(counts: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], ["term", "df"])

    rows = counts.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df"))
    df = np.zeros(terms, dtype=np.int64)
    for term, n in rows.collect():
        df[term] = n
    return df


class Best:
    """The best documents of each item so far, by score and then doc_id, null last."""

    def __init__(self, items: int, keep: int):
        self.keep, self.least = keep, np.ones(items, dtype=np.int64)
        self.held = np.zeros((4, 0), dtype=np.int64)

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, null: np.ndarray) -> None:
        at, item = np.nonzero(scores >= self.least)
        if not len(at):
            return
        new = np.stack([item, scores[at, item], null[at].astype(np.int64), doc_ids[at]])
        held = np.concatenate([self.held, new], axis=1)
        held = held[:, np.lexsort((held[3], held[2], -held[1], held[0]))]
        first = np.searchsorted(held[0], np.arange(len(self.least)))
        self.held = held[:, np.arange(held.shape[1]) - first[held[0]] < self.keep]
        first = np.searchsorted(self.held[0], np.arange(len(self.least) + 1))
        full = np.flatnonzero(np.diff(first) == self.keep)
        self.least[full] = self.held[1, first[full] + self.keep - 1]

    def batch(self) -> pa.RecordBatch:
        item, score, null, doc_id = self.held
        columns = [pa.array(item, pa.int32()), pa.array(doc_id, mask=null.astype(bool)), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])


def best(counts: DataFrame, items: Items, weights: np.ndarray, documents: int, words: int, keep: int) -> DataFrame:
    """Each task's best documents of each item of the block."""
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast((items.start, items.items, weights))
    n_items = len(items.item_ids)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, item, weight = shared.value
        lists = np.diff(start)
        found, step = Best(n_items, keep), max(1, SCORES // n_items)
        for batch in batches:
            ids = batch.column(0)
            null = np.array(ids.is_null())
            doc_ids = ids.fill_null(0).to_numpy()
            # Whole numbers of any size, as lengths times documents may pass 64 bits.
            m = np.array([50 + 50 * n * documents // words for n in batch.column(1).to_pylist()], dtype=np.int64)
            terms, times = batch.column(2), batch.column(3)
            ends = np.concatenate(([0], np.cumsum(pc.list_value_length(terms).to_numpy())))
            terms, times = terms.flatten().to_numpy(), times.flatten().to_numpy()
            work = np.concatenate(([0], np.cumsum(lists[terms])))[ends]
            for low in range(0, batch.num_rows, step):
                high = min(low + step, batch.num_rows)
                scores = np.zeros((high - low) * n_items, dtype=np.int64)
                for a, b in _runs(np.diff(work[low : high + 1]).tolist(), 4 * SCORES):
                    of = slice(ends[low + a], ends[low + b])
                    term, tf = terms[of], times[of]
                    doc = np.repeat(np.arange(a, b), np.diff(ends[low + a : low + b + 1]))
                    value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[low + doc]))
                    size = lists[term]
                    # Places in the lists of items: a run from each term's start.
                    place = np.arange(size.sum()) + np.repeat(start[term] - (np.cumsum(size) - size), size)
                    np.add.at(scores, np.repeat(doc * n_items, size) + item[place], np.repeat(value, size))
                found.add(scores.reshape(-1, n_items), doc_ids[low:high], null[low:high])
        yield found.batch()

    return counts.filter("n > 0").mapInArrow(score, BEST_SCHEMA)


def blocks(items: DataFrame, block_bytes: int) -> Iterator[Items]:
    """The items in blocks of about ``block_bytes`` bytes of text, built when asked for."""
    items = items.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    split = math.ceil(total / block_bytes)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(1, split)))
    for k in range(split):
        found = Items([tuple(r) for r in items.filter(block == k).collect()])
        if found.terms:
            yield found


def search(documents: DataFrame, items: DataFrame, keep: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``keep`` best documents."""
    spark = documents.sparkSession
    out = []
    for k, block in enumerate(blocks(items, block_bytes)):
        counts = term_counts(documents, block, f"{spark.sparkContext.applicationId}-{id(block)}-{k}")
        found, words = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not words:
            break
        df = holding(counts, len(block.terms))
        weights = np.array([math.floor(1000 * math.log((2 * found + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
        top = best(counts, block, weights, found, words, keep)
        names = spark.createDataFrame(list(enumerate(block.item_ids)), "item int, item_id long")
        named = top.join(F.broadcast(names), "item")
        out.append(written(named.select("item_id", "doc_id", "score"), "best-documents"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = reduce(DataFrame.unionByName, out)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("item_id", "slice").orderBy(*order))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    sliced = sliced.withColumn("place", place).filter(F.col("place") <= keep)
    ranked = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= keep).select("item_id", "rank", "doc_id", "score")
