"""Removal of repeated passages with suffix arrays, over a whole corpus and exactly.

A passage is ``LENGTH`` bytes that also start anywhere else. Suffix arrays of parts of the corpus
find all of them if every two equal passages meet in one part. Each passage has an anchor: of the
hashes of its ``GRAM``-byte runs the smallest, the first of equals. Equal passages have equal
anchors at equal distances, so the corpus is cut into segments, each with the passages of one
anchor, and segments meet by the hash of their anchor.

1. Anchors that occur once are dropped. Segments with equal bytes are counted, and one stands for
   all: this is where copies, in any number, become one row.
2. The texts are read again for the bytes of the segments that are left.
3. Segments of an anchor meet in one task, which sorts the suffixes of many anchors at a time in
   two stages and compares neighbours: a start is repeated if it shares LENGTH bytes with the one
   before or after it, or if its whole segment occurs more than once.
4. Marks go back to every occurrence, and texts lose the bytes that marked passages cover.

An anchor whose different segments are more than a task should hold (a passage with another
neighbourhood in each of very many documents) is split by the passages themselves.

Texts are told apart by a 64-bit hash and their size, segments of one anchor by a second hash.

Defined results: null texts are empty; texts shorter than LENGTH bytes keep all; a text that occurs
in two rows is a repeat of itself, so all its bytes go; no rows give no rows. Rows without an id,
and with repeated ids, are judged by their texts like all others. Where a cut splits a character,
the rest of the character goes from the kept text too, but not from the kept bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.llm import suffixes
from velotrace.llm.common import unused
from velotrace.operators.joins import lookup
from velotrace.session import written, written_alone
from velotrace.settings import Settings

LENGTH, GRAM = 200, 32
#: Bytes of segments that are sorted at a time, and that an anchor may have before it is split.
BATCH_BYTES, ANCHOR_BYTES = 2 << 20, 4 << 20
#: Places of a text are packed with the smallest hashes in strips of this many bytes.
_STRIP = 1 << 20

_FACTOR = 0x9E3779B97F4A7C15
_POWERS = [np.uint64(pow(_FACTOR, 1 << k, 1 << 64)) for k in range(6)]
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "big") for b in range(256)],
    dtype=np.uint64,
)


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Segments:
    """Cuts texts into segments; keeps the powers that its hashes need."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = _powers_of(_FACTOR, n), _powers_of(_INVERSE, n)

    def of(self, text: bytes):
        """Of each segment: anchor hash, content hash, first start, number of starts, and how far
        the anchor lies behind the first start. None for texts without a passage."""
        n = len(text)
        if n < LENGTH:
            return None
        x = _BYTES[np.frombuffer(text, np.uint8)]
        span = 1
        for k in range(GRAM.bit_length() - 1):
            x = x[:-span] * _POWERS[k] + x[span:]
            span *= 2
        x ^= x >> np.uint64(31)
        x *= _POWERS[0]
        x ^= x >> np.uint64(29)

        window, starts = LENGTH - GRAM + 1, n - LENGTH + 1
        anchor = np.empty(starts, np.int64)
        for low in range(0, starts, _STRIP - window):
            high = min(starts, low + _STRIP - window)
            part = x[low : high + window - 1]
            m = (part & ~np.uint64(_STRIP - 1)) | np.arange(len(part), dtype=np.uint64)
            span = 1
            while 2 * span <= window:
                m = np.minimum(m[:-span], m[span:])
                span *= 2
            if span < window:
                m = np.minimum(m[: len(m) - (window - span)], m[window - span :])
            anchor[low:high] = (m & np.uint64(_STRIP - 1)).astype(np.int64) + low
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        count = np.diff(np.r_[first, starts])
        place = anchor[first]
        # The runs of the segment's bytes, weighed by their place in it.
        self._grow(len(x))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.up[: len(x)], dtype=np.uint64)])
        content = (sums[first + count + LENGTH - GRAM] - sums[first]) * self.down[first]
        content ^= count.astype(np.uint64)
        return x[place].view(np.int64), content.view(np.int64), first, count, place - first


def pack(first, count, back):
    """First start, number of starts and distance of the anchor as one number."""
    return (first << 16) | (count << 8) | back


def unpack(place):
    return place >> 16, (place >> 8) & 255, place & 255


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _texts(documents: DataFrame) -> DataFrame:
    """(text_id, size, text) of the texts that have a passage."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.xxhash64(text).alias("text_id"), F.octet_length(text).cast("long").alias("size"), text.alias("text")
    )
    return rows.filter(F.col("size") >= LENGTH)


def anchors(texts: DataFrame) -> DataFrame:
    """(anchor) that occur more than once. Of equal texts a task reads two."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, met = Segments(), {}
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for key, size, text in zip(*(c.to_pylist() for c in batch.columns)):
                met[key, size] = met.get((key, size), 0) + 1
                if met[key, size] <= 2:
                    found.append(segments.of(text.encode("utf-8", "surrogatepass"))[0])
            yield _batch({"anchor": pa.array(np.concatenate(found))})

    rows = texts.mapInArrow(read, "anchor long")
    counted = rows.groupBy("anchor").agg(F.count("*").alias("n"))
    return written(counted.filter("n > 1").select("anchor"), "anchors")


def occurrences(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """(anchor, content, text_id, size, place) of the segments whose anchor is repeated.

    A text that a task meets more than once is given twice, so that counts still tell.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, met = Segments(), {}
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)]
            for key, size, text in zip(*(c.to_pylist() for c in batch.columns)):
                met[key, size] = met.get((key, size), 0) + 1
                if met[key, size] > 2:
                    continue
                anchor, content, first, count, back = segments.of(text.encode("utf-8", "surrogatepass"))
                n = len(anchor)
                for column, values in zip(
                    columns, (anchor, content, np.full(n, key), np.full(n, size), pack(first, count, back))
                ):
                    column.append(values)
            names = ("anchor", "content", "text_id", "size", "place")
            yield _batch({k: pa.array(np.concatenate(c)) for k, c in zip(names, columns)})

    rows = texts.mapInArrow(read, "anchor long, content long, text_id long, size long, place long")
    return written(rows.join(repeated, "anchor", "left_semi"), "occurrences")


def packed_texts(texts: DataFrame) -> DataFrame:
    """(text_id, size, packed): compressed texts, once for each task that meets them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, met = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            rows = []
            for key, size, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, size) not in met:
                    met.add((key, size))
                    rows.append((key, size, squeeze.compress(text.encode("utf-8", "surrogatepass"))))
            keys, sizes, packed = zip(*rows) if rows else ((), (), ())
            yield _batch(
                {
                    "text_id": pa.array(keys, pa.int64()),
                    "size": pa.array(sizes, pa.int64()),
                    "packed": pa.array(packed, pa.binary()),
                }
            )

    return texts.mapInArrow(read, "text_id long, size long, packed binary")


def contents(occurring: DataFrame, texts: DataFrame) -> DataFrame:
    """(anchor, content, back, many, bytes): each different segment once for each task that cuts it."""
    different = (
        occurring.groupBy("anchor", "content")
        .agg((F.count("*") > 1).alias("many"), F.min(F.struct("text_id", "size", "place")).alias("at"))
    )
    asked = different.groupBy("at.text_id", "at.size").agg(
        F.collect_list(F.struct("anchor", "content", "many", "at.place")).alias("segments")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, segments in zip(*(batch.column(c).to_pylist() for c in ("packed", "segments"))):
                text = expand.decompress(packed)
                for s in segments:
                    first, count, back = unpack(s["place"])
                    rows.append((s["anchor"], s["content"], back, s["many"], text[first : first + count + LENGTH - 1]))
            anchor, content, back, many, raw = zip(*rows) if rows else ((), (), (), (), ())
            yield _batch(
                {
                    "anchor": pa.array(anchor, pa.int64()),
                    "content": pa.array(content, pa.int64()),
                    "back": pa.array(back, pa.int32()),
                    "many": pa.array(many, pa.bool_()),
                    "bytes": pa.array(raw, pa.binary()),
                }
            )

    met = packed_texts(texts).join(asked, ["text_id", "size"])
    return met.select("packed", "segments").mapInArrow(
        cut, "anchor long, content long, back int, many boolean, bytes binary"
    )


def repeated_starts(parts: list[bytes], many: list[bool]) -> list[np.ndarray]:
    """Of each part, which of its starts are repeated in any of the parts."""
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    starts = sizes - LENGTH + 1
    wanted = np.zeros(len(text), bool)
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + starts, -1)
    wanted = np.cumsum(change)[:-1] > 0
    words = suffixes.words_at(text)
    order = suffixes.suffix_order(text, wanted, words, LENGTH)
    shared = suffixes.common_prefixes(order, words, LENGTH) >= LENGTH
    shared[:-1] |= shared[1:]
    marked = np.zeros(len(text), bool)
    marked[order[shared]] = True
    return [
        np.ones(n, bool) if m else marked[b : b + n] for b, n, m in zip(begins, starts, many)
    ]


def ranges(flags: np.ndarray) -> list[int]:
    """Where the flags begin and end, one after the other."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge.tolist()


def marked(parts: DataFrame) -> DataFrame:
    """(key, part, many, bytes) to (part, marks): the repeated starts of parts, found within keys.

    The rows of a key meet in one task; several keys are sorted together. Equal part numbers of a
    key are one part.
    """
    together = parts.repartition("key").sortWithinPartitions("key", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None

        def out() -> pa.RecordBatch:
            flags = repeated_starts([r[3] for r in rows], [r[2] for r in rows])
            found = [(r[0], r[1], ranges(f)) for r, f in zip(rows, flags) if f.any()]
            keys, part, marks = zip(*found) if found else ((), (), ())
            return _batch(
                {
                    "key": pa.array(keys, pa.int64()),
                    "part": pa.array(part, pa.int64()),
                    "marks": pa.array(marks, pa.list_(pa.int32())),
                }
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "many", "bytes"))):
                if (row[0], row[1]) == last:
                    continue
                if rows and row[0] != last[0] and size >= BATCH_BYTES:
                    yield out()
                    rows, size = [], 0
                last = (row[0], row[1])
                rows.append(row)
                size += len(row[3])
        if rows:
            yield out()

    return together.mapInArrow(read, "key long, part long, marks array<int>")


def segment_marks(segments: DataFrame, occurring: DataFrame, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """(anchor, content, marks): the repeated starts of each different segment that has any."""
    count = F.shiftright("place", 8).bitwiseAND(F.lit(255))
    sizes = occurring.groupBy("anchor", "content").agg((F.first(count) + LENGTH - 1).alias("size"))
    heavy = written(
        sizes.groupBy("anchor").agg(F.sum("size").alias("size")).filter(F.col("size") > anchor_bytes).select("anchor"),
        "heavy-anchors",
    )
    plain = segments.select(F.col("anchor").alias("key"), F.col("content").alias("part"), "many", "bytes")
    names = {"key": "anchor", "part": "content"}
    if heavy.isEmpty():
        return written(marked(plain).withColumnsRenamed(names), "marks")

    # Of a heavy anchor, each passage is a part: equal passages, which lie equally far from the
    # anchor, are combined before they are shuffled, so a key keeps few rows.
    segments = written(segments, "segments")
    plain = segments.join(heavy, "anchor", "left_anti").select(
        F.col("anchor").alias("key"), F.col("content").alias("part"), "many", "bytes"
    )
    split = segments.join(heavy, "anchor").dropDuplicates(["anchor", "content"])
    each = split.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)))
    each = each.withColumn("passage", F.substring("bytes", F.col("start") + 1, F.lit(LENGTH)))
    each = written(
        each.select(
            "anchor", "content", "start", "many", "passage",
            F.xxhash64("anchor", F.col("back") - F.col("start"), "passage").alias("key"),
        ),
        "passages",
    )
    parts = each.groupBy("key", "passage").agg(((F.count("*") > 1) | F.max("many")).alias("many"))
    found = marked(
        parts.select("key", F.xxhash64("passage", F.lit(1)).alias("part"), "many", F.col("passage").alias("bytes"))
    )
    starts = each.join(found.select("key", "part"), (each["key"] == found["key"]) & (F.xxhash64("passage", F.lit(1)) == found["part"]))
    pieces = starts.groupBy("anchor", "content").agg(
        F.flatten(F.sort_array(F.collect_list(F.array(F.col("start"), F.col("start") + 1)))).alias("marks")
    )
    return written(marked(plain).withColumnsRenamed(names).unionByName(pieces), "marks")


def without_repeats(documents: DataFrame, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """(text_id, size, n_removed, n_spans, kept_sha256, kept) of the texts that lose bytes.

    A text may be given by several tasks, each time alike.
    """
    texts = _texts(documents)
    occurring = occurrences(texts, anchors(texts))
    marks = segment_marks(contents(occurring, texts), occurring, anchor_bytes)
    by_text = (
        occurring.select("anchor", "content", "text_id", "size", F.shiftright("place", 16).alias("first"))
        .join(marks, ["anchor", "content"])
        .groupBy("text_id", "size")
        .agg(F.collect_set(F.struct("first", "marks")).alias("found"))
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, met = zstandard.ZstdDecompressor(), set()
        for batch in batches:
            rows = []
            names = ("text_id", "size", "packed", "found")
            for key, size, packed, found in zip(*(batch.column(c).to_pylist() for c in names)):
                if (key, size) in met:
                    continue
                met.add((key, size))
                text = np.frombuffer(expand.decompress(packed), np.uint8)
                change = np.zeros(len(text) + 1, np.int64)
                for f in found:
                    edges = np.array(f["marks"], np.int64) + f["first"]
                    np.add.at(change, edges[::2], 1)
                    # The last start of a range covers LENGTH bytes from there.
                    np.add.at(change, edges[1::2] + LENGTH - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = text[~gone].tobytes()
                spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                rows.append(
                    (key, size, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore"))
                )
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ("text_id", "size", "n_removed", "n_spans", "kept_sha256", "kept")
            yield _batch({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds)})

    met = packed_texts(texts).join(by_text, ["text_id", "size"])
    return met.mapInArrow(
        remove, "text_id long, size long, n_removed long, n_spans long, kept_sha256 string, kept string"
    )


def removal_counts(documents: DataFrame, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per document."""
    changed = written_alone(
        lambda: without_repeats(documents, anchor_bytes).drop("kept").dropDuplicates(["text_id", "size"]), "changed"
    )
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id",
        F.xxhash64(text).alias("text_id"),
        F.octet_length(text).cast("long").alias("size"),
        F.sha2(text.cast("binary"), 256).alias("whole_sha256"),
    )
    met = lookup(rows, changed, ["text_id", "size"])
    return met.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def cleaned(documents: DataFrame, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """The documents with the bytes that are left as their text, and n_chars, if there, to match."""
    names = ["text_id", "size"]
    changed = written_alone(
        lambda: without_repeats(documents, anchor_bytes).select(*names, "kept").dropDuplicates(names), "changed-texts"
    )
    text = F.coalesce("text", F.lit(""))
    text_id, size, kept = (unused(documents, name) for name in ("text_id", "size", "kept"))
    keys = {text_id: F.xxhash64(text), size: F.octet_length(text).cast("long")}
    table = changed.select(F.col("text_id").alias(text_id), F.col("size").alias(size), F.col("kept").alias(kept))
    # Texts are too large to broadcast by their number, and so are spread in smaller groups.
    met = lookup(documents.withColumns(keys), table, list(keys), Settings(group_rows=10_000), small=False)
    new = {"text": F.coalesce(kept, "text")}
    if "n_chars" in documents.columns:
        length = F.length(kept).cast(documents.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col(kept).isNotNull(), length).otherwise(F.col("n_chars"))
    return met.withColumns(new).select(*[F.col(f"`{c}`") for c in documents.columns])
