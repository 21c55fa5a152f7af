"""Audit of how text filters overlap, in every order of applying them.

1. One pass over the texts gives each row the mask of the filters it fails by its own text, a
   64-bit key and a 256-bit digest of the text.
2. Tasks count keys in sketches of small counters (a counting Bloom filter whose counters stop at
   two). Sketches are kept in pages and merged by adding counters; a key has all its counters in
   one page.
3. A key with a counter of one belongs to one row, so its text is unique. Only the other texts, the
   possible repeats, are shuffled and grouped as whole texts, which gives each repeated text's
   smallest doc_id.
4. Rows of repeated texts with a larger doc_id fail the duplicate filter. Rows are then counted by
   part and mask; there are at most 32 masks, and all figures of all orders are sums over them.

The sketch grows with the rows and is broadcast up to ``SKETCH_BYTES``. Beyond that, keys are
shuffled to their pages, and a join with the keys picks the possible repeats.

Defined results: a null text is empty; a null lang is the empty part; rows that share doc_id and
text are no duplicates of each other; a row without a doc_id is no duplicate and makes none, and
has no label; a doc_id with several labels counts as labelled if any of them is 1; rows without
words fail A and not B or C; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrace.operators.joins import lookup
from velotrace.session import written

LETTERS = "ABCDE"
DUPLICATE = LETTERS.index("E")
#: Counters for each row, counters that a key has, and counters of a page.
PER_ROW, PROBES, PAGE = 16, 3, 1 << 12
#: Bytes of the whole sketch up to which it is broadcast, at two bits a counter.
SKETCH_BYTES = 64 << 20
PAGE_BYTES = PAGE // 4
#: Keys that a task counts at once.
TASK_KEYS = 1 << 20

# What fails each filter.
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_mask(text: str) -> int:
    """Bits of the filters A to D that the text fails."""
    raw = text.encode()
    # Without an argument, bytes are split at the blank and the controls from tab to return.
    words = raw.split()
    upper = len(raw) - len(raw.translate(None, UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > MAX_UPPER_PERCENT * len(text)) << 2
        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    )


def masked(documents: DataFrame) -> DataFrame:
    """doc_id, part, mask of A to D, key and digest of the text of each row; written once."""

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array([own_mask(t) for t in batch.column("text").to_pylist()], pa.int32())
            kept = [batch.column(c) for c in ("doc_id", "part", "key", "digest")]
            yield pa.RecordBatch.from_arrays([*kept, mask], ["doc_id", "part", "key", "digest", "mask"])

    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    rows = texts_of(documents).select("doc_id", "part", "text", F.xxhash64("text").alias("key"), digest)
    return written(
        rows.mapInArrow(masks, "doc_id long, part string, key long, digest binary, mask int"), "audit-rows"
    )


def texts_of(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def page_count(rows: int) -> int:
    """Pages of the sketch, a power of two that grows with the rows."""
    return 1 << max(0, -(-rows * PER_ROW // PAGE) - 1).bit_length()


def places(keys: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """The page of each key, and its counters there, one column per probe."""
    mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    spread = mixed * np.uint64(0xD6E8FEB86659FD93)
    # High bits of a product, which the bits that chose the page do not settle.
    shifts = np.array([64 - 12 * (i + 1) for i in range(PROBES)], dtype=np.uint64)
    return (mixed % np.uint64(pages)).astype(np.int64), ((spread[:, None] >> shifts) % np.uint64(PAGE)).astype(np.int64)


def counted(keys: np.ndarray, pages: int) -> tuple[list[int], list[bytes]]:
    """The pages that the keys touch, and in each the counters above zero: 16 bits each, twelve for
    the place and one for more than one."""
    page, cells = places(keys, pages)
    # A key whose probes fall together counts there once.
    cells.sort(axis=1)
    first = np.ones(cells.shape, dtype=bool)
    first[:, 1:] = cells[:, 1:] != cells[:, :-1]
    flat, count = np.unique((page[:, None] * PAGE + cells)[first], return_counts=True)
    entries = (flat % PAGE | np.where(count > 1, PAGE, 0)).astype("<u2")
    touched, start = np.unique(flat // PAGE, return_index=True)
    return touched.tolist(), [x.tobytes() for x in np.split(entries, start[1:])]


def add(cells: np.ndarray, data: bytes) -> None:
    entries = np.frombuffer(data, "<u2")
    at = entries % PAGE
    cells[at] = np.minimum(cells[at] + 1 + entries // PAGE, 2)


def pack(counters: np.ndarray) -> bytes:
    four = counters.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    return np.stack([raw >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def _key_array(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def sketch_pages(rows: DataFrame, pages: int) -> DataFrame:
    """page, cells: the packed counters of the keys of all rows, merged; written once."""
    schema = "page long, cells binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(_key_array(batch.column(0)))
            size += batch.num_rows
            if size >= TASK_KEYS:
                yield _page_batch(*counted(np.concatenate(held), pages))
                held, size = [], 0
        if size:
            yield _page_batch(*counted(np.concatenate(held), pages))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, np.zeros(PAGE, dtype=np.uint8)
        for batch in batches:
            done, packed = [], []
            for page, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if page != now:
                    if now is not None:
                        done.append(now)
                        packed.append(pack(cells))
                    now = page
                    cells[:] = 0
                add(cells, more)
            yield _page_batch(done, packed)
        if now is not None:
            yield _page_batch([now], [pack(cells)])

    partial = rows.select("key").mapInArrow(count, schema)
    return written(partial.repartition("page").sortWithinPartitions("page").mapInArrow(merge, schema), "sketch")


def _page_batch(pages: list[int], cells: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(cells, pa.binary())], ["page", "cells"])


def possible_repeats(documents: DataFrame, rows: DataFrame, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """key, text, doc_id of the rows whose text the sketch cannot tell to be unique."""
    pages = page_count(rows.count())
    sketch = sketch_pages(rows, pages)
    texts = texts_of(documents).select(F.xxhash64("text").alias("key"), "text", "doc_id")
    if pages * PAGE_BYTES <= sketch_bytes:
        return _by_broadcast(texts, sketch, pages)
    return texts.join(_keys_by_page(rows, sketch, pages), "key", "left_semi")


def _by_broadcast(texts: DataFrame, sketch: DataFrame, pages: int) -> DataFrame:
    whole = bytearray(pages * PAGE_BYTES)
    for page, cells in sketch.collect():
        whole[page * PAGE_BYTES : (page + 1) * PAGE_BYTES] = cells
    shared = texts.sparkSession.sparkContext.broadcast(bytes(whole))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            page, cells = places(_key_array(batch.column(0)), pages)
            at = page[:, None] * PAGE + cells
            some = ((packed[at >> 2] >> (2 * (at & 3)).astype(np.uint8)) & 3 >= 2).all(axis=1)
            yield batch.filter(pa.array(some))

    return texts.mapInArrow(keep, "key long, text string, doc_id long")


def _keys_by_page(rows: DataFrame, sketch: DataFrame, pages: int) -> DataFrame:
    """The distinct keys that may repeat: keys, each once, are shuffled to the pages."""

    def with_page(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page = pa.array(places(_key_array(batch.column(0)), pages)[0], pa.int64())
            yield pa.RecordBatch.from_arrays([page, batch.column(0)], ["page", "key"])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, None
        for batch in batches:
            found = []
            for page, key, more in zip(*(c.to_pylist() for c in batch.columns)):
                if more is not None:
                    now, cells = page, unpack(more)
                elif page == now:
                    own = places(np.array([key], dtype=np.int64), pages)[1][0]
                    if (cells[own] >= 2).all():
                        found.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["key"])

    keys = rows.select("key").distinct().mapInArrow(with_page, "page long, key long")
    both = keys.withColumn("cells", F.lit(None).cast("binary")).unionByName(
        sketch.withColumn("key", F.lit(None).cast("long"))
    )
    placed = both.select("page", "key", "cells").repartition("page")
    placed = placed.sortWithinPartitions("page", F.col("cells").isNull())
    return written(placed.mapInArrow(test, "key long"), "audit-keys")


def with_duplicates(documents: DataFrame, rows: DataFrame, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """doc_id, part and mask of the rows, with E in it where a smaller doc_id has the same text."""
    possible = possible_repeats(documents, rows, sketch_bytes)
    # Copies are merged where they are read, so a text of many copies does not meet in one task.
    texts = possible.groupBy("text").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    met = lookup(rows, written(texts.filter("copies > 1").select(digest, "first"), "audit-texts"), ["digest"])
    late = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return met.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(late, 1 << DUPLICATE).otherwise(0)).alias("mask"))


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, and the rows of it: all, of quality 1, toxic."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    met = lookup(flagged, written(known, "audit-labels"), ["doc_id"])
    counts = met.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")],
    )
    return written(counts, "audit-counts")


def interactions(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, in each part."""
    orders = ",".join("".join(p) for p in permutations(LETTERS))
    steps = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))
    )
    bit = "shiftleft(1, ascii(substring(filter_order, {}, 1)) - ascii('A'))"
    earlier = f"aggregate(sequence(1, {len(LETTERS)}), 0, (m, i) -> if(i < step, m | {bit.format('i')}, m))"
    steps = steps.withColumns({"own": F.expr(bit.format("step")), "earlier": F.expr(earlier)})
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(which: Column, of: str, name: str) -> Column:
        return F.sum(F.when(which, F.col(of)).otherwise(0)).cast("long").alias(name)

    audit = steps.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~gone, "n", "kept"),
        total(fails & ~gone, "n", "removed"),
        total(fails & gone, "n", "redundant"),
        total(F.col("mask") == F.col("own"), "n", "unique_fails"),
        total(fails & ~gone, "good", "good_lost"),
        total(fails & ~gone, "toxic", "toxic_lost"),
    )
    # 120 orders of five steps each: a part has 600 rows, whatever its documents.
    shapley = F.sum("removed").over(Window.partitionBy("part", "own")).cast("long").alias("shapley")
    return audit.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; see the module for the figures."""
    return interactions(mask_counts(with_duplicates(documents, masked(documents)), labels))
