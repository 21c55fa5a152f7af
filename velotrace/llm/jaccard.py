"""Exact n-gram Jaccard join by a blocked sparse matrix product.

Documents are rows and word n-grams columns of an incidence matrix; the product with its transpose
counts the n-grams that two documents share. Sizes bound the work: documents can only link if they
share some of the first columns of each, in one order of columns for all, so only those entries are
kept. The order puts n-grams that many documents hold last.

1. One pass gives each document's set size and a digest of its set; documents with equal sets are
   one class from here on. The same pass counts frequent n-grams, for the order of columns only.
2. A second pass emits the first entries of each class. Columns with few entries are multiplied
   where they meet: they give pairs, whose counts are summed over columns, and pairs below the
   bound that their sizes set go. Two pairs of each class are verified first, and then only pairs
   that are not yet connected, so that copies of one text are not all compared with each other.
3. Columns with many entries give a few pivots each, the same for columns of the same classes. They
   matter only to classes with enough of such entries to link by them alone: two sets that link
   share more kept entries than ``spare``, so others meet every partner in a short column as well.
   Classes that already link through pivots and pairs need no other link, so only columns that
   still hold different components are cut into blocks by size, and each pair of blocks whose sizes
   allow a link is multiplied whole in one task, which returns links and no other pairs. Classes of
   a column's largest component are multiplied with the others only, not among themselves.
4. Pairs that may link by the low bits of all their n-grams, which bound the overlap from above,
   are verified with both whole sets, and links become components.

Sets are of 64-bit hashes. Nothing is capped: the list of frequent n-grams is bounded, and changes
the order of columns but not the links.

Defined results: a text with fewer words than ``width`` has its whole sequence as its one n-gram; a
null text or one without words has the empty set and links with nothing; repeated rows have equal
sets; rows that share a doc_id are one document for links; rows without a doc_id link only through
sets equal to theirs, and their component is null if no row has an id. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.llm.common import unused
from velotrace.llm.components import components
from velotrace.operators.joins import fits, lookup
from velotrace.operators.ordered import ordered, row_count, scan
from velotrace.session import written, written_alone
from velotrace.settings import Settings

WIDTH, PERCENT = 4, 85
#: Entries of a column that are paired where they meet; longer columns are cut into blocks.
SMALL = 64
#: One more entry is kept for each this many n-grams of a set.
SPARE = 20
#: Classes in a block of the product.
BLOCK = 256
#: Share of a mixed cluster's documents whose sizes are near enough to link, for estimates only.
NEAR_SIZES = 0.3
#: Frequent n-grams: counters per task, listed n-grams, and the count from which one is listed.
COUNTERS, LISTED, FREQUENT = 1 << 16, 1 << 17, 64

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MASK = 2**64 - 1


class _Hashes(dict):
    """Numbers words and keeps their hashes."""

    def __init__(self):
        self.values_of: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.values_of)
        self.values_of.append(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "big"))
        return i


class Shingles:
    """Sorted distinct n-gram hashes of texts; forgets its words when it holds too many."""

    def __init__(self, width: int = WIDTH, keep: int = 300_000):
        self.width, self.keep = width, keep
        self.ids, self.table = _Hashes(), np.zeros(0, np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        return self.of_bytes((text or "").encode("utf-8", "surrogatepass"))

    def of_bytes(self, text: bytes) -> np.ndarray:
        # Splitting and lower-casing bytes touches ASCII only, as the word rule wants.
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.ids) > self.keep:
            self.ids, self.table = _Hashes(), np.zeros(0, np.uint64)
        at = np.array(list(map(self.ids.__getitem__, words)), dtype=np.int64)
        if len(self.table) < len(self.ids):
            new = self.ids.values_of[len(self.table) :]
            self.table = np.concatenate([self.table, np.array(new, dtype=np.uint64)])
        hashed = self.table[at]
        width = min(self.width, len(words))
        n = len(words) - width + 1
        grams = np.full(n, width, np.uint64)
        for k in range(width):
            grams = grams * _FACTOR + hashed[k : k + n]
        grams ^= grams >> np.uint64(32)
        grams *= _FACTOR
        grams ^= grams >> np.uint64(29)
        return np.unique(grams)


def digest(grams: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return tuple(int.from_bytes(raw[i : i + 8], "big", signed=True) for i in (0, 8))


def needed(size, percent: int):
    """The least overlap of a set of this size with any set that it links with."""
    return -(-percent * size // 100)


def spare(size):
    """Entries that are kept beyond those that show one common entry: pairs must share more."""
    return size // SPARE


def links(both, a, b, percent: int):
    """Whether sets of sizes a and b that share this many n-grams link."""
    return 100 * both >= percent * (a + b - both)


class Frequent:
    """Counts of the values that are most frequent, with a bounded number of counters.

    When there are too many, all counts fall by that of the first one beyond the limit, so a value
    with more than its share of all values is never lost.
    """

    def __init__(self, counters: int = COUNTERS):
        self.counters = counters
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.size += len(values)
        if self.size >= 1_000_000:
            self.settle()

    def settle(self) -> None:
        values = np.concatenate([self.values, *self.waiting])
        weights = np.concatenate([self.counts, np.ones(self.size, np.int64)])
        self.waiting, self.size = [], 0
        self.values, at = np.unique(values, return_inverse=True)
        self.counts = np.bincount(at, weights, len(self.values)).astype(np.int64)
        if len(self.values) > self.counters:
            cut = -np.partition(-self.counts, self.counters)[self.counters]
            kept = self.counts > cut
            self.values, self.counts = self.values[kept], self.counts[kept] - cut


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def sets_and_counts(documents: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, n, high, low, bits) of documents, and (value, count) of frequent n-grams.

    ``bits`` are the low 16 bits of each n-gram of the set, sorted. Sets share at most as many
    n-grams as these share values, which hardly ever is many more.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, frequent = Shingles(width), Frequent()

        def out(ids, n, high, low, bits, values, counts) -> pa.RecordBatch:
            return _batch(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "n": pa.array(n, pa.int64()),
                    "high": pa.array(high, pa.int64()),
                    "low": pa.array(low, pa.int64()),
                    "bits": pa.array(bits, pa.binary()),
                    "value": pa.array(values, pa.int64()),
                    "count": pa.array(counts, pa.int64()),
                }
            )

        for batch in batches:
            n, high, low, bits = [], [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingles.of(text)
                bits.append(np.sort(grams.astype(np.uint16)).tobytes())
                a, b = digest(grams)
                n.append(len(grams))
                high.append(a)
                low.append(b)
                # Only n-grams near the head of the order need a count.
                frequent.add(grams[: np.searchsorted(grams, np.uint64(1 << 62))])
            none = [None] * len(n)
            yield out(batch.column("doc_id"), n, high, low, bits, none, none)
        frequent.settle()
        often = frequent.counts > 1
        values, none = frequent.values[often].view(np.int64), [None] * int(often.sum())
        yield out(none, none, none, none, none, values, frequent.counts[often])

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return written(
        rows.mapInArrow(
            read, "doc_id long, n long, high long, low long, bits binary, value long, count long"
        ),
        "shingle-sets",
    )


def column_order(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The listed n-grams, sorted, and the level of each: they come after all others, by level."""
    top = (
        counted.groupBy("value")
        .agg(F.sum("count").alias("count"))
        .filter(F.col("count") >= FREQUENT)
        .orderBy(F.col("count").desc(), "value")
        .limit(LISTED)
    )
    found = top.toPandas()
    values = found["value"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    level = np.log2(found["count"].to_numpy(np.float64)).astype(np.int8)
    return values[order], level[order]


def first_entries(grams: np.ndarray, listed: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The entries of a set that any partner must share some of, first in the order of columns."""
    size = len(grams)
    keep = size - needed(size, percent) + 1 + spare(size)

    def levels(values: np.ndarray) -> np.ndarray:
        if not len(listed):
            return np.zeros(len(values), np.int8)
        at = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
        return np.where(listed[at] == values, level[at], 0)

    head = grams[: 2 * keep]
    plain = head[levels(head) == 0]
    if len(plain) >= keep:
        return plain[:keep]
    return grams[np.lexsort((grams, levels(grams)))[:keep]]


def entries(documents: DataFrame, width: int, percent: int, listed: np.ndarray, level: np.ndarray) -> DataFrame:
    """(gram, class, n): the kept entries of each class, once for each task that meets it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, met = Shingles(width), set()
        for batch in batches:
            grams, classes, sizes, counts = [np.zeros(0, np.uint64)], [], [], []
            for text in batch.column(0).to_pylist():
                found = shingles.of(text)
                key = digest(found)
                if not len(found) or key in met:
                    continue
                met.add(key)
                kept = first_entries(found, listed, level, percent)
                grams.append(kept)
                classes.append(key[1])
                sizes.append(len(found))
                counts.append(len(kept))
            yield _batch(
                {
                    "gram": pa.array(np.concatenate(grams).view(np.int64)),
                    "class": pa.array(np.repeat(np.array(classes, np.int64), counts)),
                    "n": pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                }
            )

    return documents.select("text").mapInArrow(read, "gram long, class long, n int")


def short_and_long(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) of short columns, and the entries (gram, a, na) of long ones.

    Rows of a column come together, by size. At most SMALL rows of a column are held.
    """
    together = rows.repartition("gram").sortWithinPartitions("gram", "n", "class")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(gram, a, b, na, nb) -> pa.RecordBatch:
            return _batch(
                {
                    "gram": pa.array(gram, pa.int64()),
                    "a": pa.array(a, pa.int64()),
                    "b": pa.array(b, pa.int64()),
                    "na": pa.array(na, pa.int32()),
                    "nb": pa.array(nb, pa.int32()),
                }
            )

        def pairs(g: np.ndarray, c: np.ndarray, n: np.ndarray) -> pa.RecordBatch | None:
            """All columns at once: each row with as many rows after it as sizes allow."""
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            length = np.diff(np.r_[first, len(g)])
            place = np.arange(len(g)) - np.repeat(first, length)
            left, a, b = np.repeat(length, length) - place - 1, [], []
            for step in range(1, int(length.max())):
                i = np.flatnonzero(left >= step)
                i = i[needed(n[i + step].astype(np.int64), percent) <= n[i]]
                a.append(i)
                b.append(i + step)
            if not a:
                return None
            a, b = np.concatenate(a), np.concatenate(b)
            different = c[a] != c[b]
            a, b = a[different], b[different]
            swap = c[a] > c[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            return out([None] * len(a), c[a], c[b], n[a], n[b])

        held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        long_gram: int | None = None  # a column that is known to be long
        for batch in batches:
            g, c, n = (np.concatenate([h, x.to_numpy(zero_copy_only=False)]) for h, x in zip(held, batch.columns))
            if not len(g):
                continue
            # Copies of a class from different tasks are one entry.
            new = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
            g, c, n = g[new], c[new], n[new]
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            length = np.diff(np.r_[first, len(g)])
            is_long = (length > SMALL) | (g[first] == long_gram if long_gram is not None else False)
            long_row = np.repeat(is_long, length)
            # The last column may go on in the next batch: it is held, or is long already.
            last = np.arange(len(g)) >= first[-1]
            long_gram = int(g[-1]) if is_long[-1] else None
            yield out(g[long_row], c[long_row], [None] * int(long_row.sum()), n[long_row], [None] * int(long_row.sum()))
            more = np.repeat(length > 1, length)
            ready = ~long_row & ~last & more
            if ready.any():
                found = pairs(g[ready], c[ready], n[ready])
                if found is not None:
                    yield found
            wait = last & ~long_row
            held = [g[wait], c[wait], n[wait]]
        if len(held[0]) > 1:
            found = pairs(*held)
            if found is not None:
                yield found

    return written(
        together.mapInArrow(multiply, "gram long, a long, b long, na int, nb int"), "columns"
    )


def keyed(low: np.ndarray) -> np.ndarray:
    """Sorted 16-bit values as distinct numbers: each value with the count of its equals before."""
    first = np.r_[True, low[1:] != low[:-1]]
    at = np.arange(len(low))
    return (low.astype(np.int64) << 32) | (at - np.maximum.accumulate(np.where(first, at, 0)))


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of doc_ids that may link by the bits (doc_id, n, bits) of their sets."""
    sketches = of_ids(sketches, ends(pairs))
    second = pairs.join(sketches.withColumnsRenamed({"doc_id": "b", "n": "nb", "bits": "bits_b"}), "b")
    both = second.join(sketches.withColumnRenamed("doc_id", "a"), "a").select("a", "b", "n", "bits", "nb", "bits_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for batch in batches:
            kept = []
            for a, n, own, m, other in zip(*(batch.column(c).to_pylist() for c in ("a", "n", "bits", "nb", "bits_b"))):
                if (a, own) != last:
                    last, mine = (a, own), keyed(np.frombuffer(own, np.uint16))
                theirs = keyed(np.frombuffer(other, np.uint16))
                shared = len(np.intersect1d(mine, theirs, assume_unique=True))
                kept.append(bool(shared) and links(shared, n, m, percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is among these distinct ids, so that no others are shuffled later."""
    if fits(ids, Settings().broadcast_rows):
        ids = F.broadcast(ids)
    return rows.join(ids, "doc_id", "left_semi")


def ends(pairs: DataFrame) -> DataFrame:
    """The distinct doc_ids of pairs (a, b)."""
    return written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ends")


def packed_texts(texts: DataFrame) -> DataFrame:
    """(doc_id, packed): texts in compressed form, for shuffling."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            packed = pa.array([squeeze.compress(r) for r in raw], pa.binary())
            yield _batch({"doc_id": batch.column("doc_id"), "packed": packed})

    return texts.mapInArrow(pack, "doc_id long, packed binary")


def unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of doc_ids whose whole sets link."""
    texts = of_ids(texts, ends(pairs))
    second = pairs.join(texts.withColumnsRenamed({"doc_id": "b", "packed": "packed_b"}), "b")
    both = second.join(texts.withColumnRenamed("doc_id", "a"), "a").select("a", "b", "packed", "packed_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, mine = Shingles(width), None, None
        for batch in batches:
            kept = []
            for a, own, other in zip(*(batch.column(c).to_pylist() for c in ("a", "packed", "packed_b"))):
                if (a, own) != last:
                    last, mine = (a, own), shingles.of_bytes(unpacked(own))
                grams = shingles.of_bytes(unpacked(other))
                shared = len(np.intersect1d(mine, grams, assume_unique=True))
                kept.append(bool(shared) and links(shared, len(mine), len(grams), percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The product of two blocks: how many n-grams each set on the left shares with each on the right.

    Columns with many entries are multiplied as dense strips, the others entry by entry.
    """
    sets, n, m = [*left, *right], len(left), len(right)
    columns, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n + m), [len(s) for s in sets])
    on_left = np.bincount(at[owner < n], minlength=len(columns))
    on_right = np.bincount(at[owner >= n], minlength=len(columns))
    counts = np.zeros((n, m), np.float32)
    work = on_left * on_right
    number = np.cumsum(work > 64) - 1
    dense = work[at] > 64
    i, c = owner[dense], number[at[dense]]
    strip = 2048
    order = np.argsort(c, kind="stable")
    i, c = i[order], c[order]
    for low in range(0, int(c[-1]) + 1 if len(c) else 0, strip):
        lo, hi = np.searchsorted(c, [low, low + strip])
        cells = np.zeros((n + m, strip), np.float32)
        cells[i[lo:hi], c[lo:hi] - low] = 1
        counts += cells[:n] @ cells[n:].T
    sparse = ~dense & (work[at] > 0)
    x = np.flatnonzero(sparse & (owner < n))
    y = np.flatnonzero(sparse & (owner >= n))
    y = y[np.argsort(at[y], kind="stable")]
    begins = np.searchsorted(at[y], at[x])
    reach = on_right[at[x]]
    pick = np.repeat(begins - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())
    key = np.repeat(owner[x], reach) * m + (owner[y][pick] - n)
    return (counts + np.bincount(key, minlength=n * m).reshape(n, m)).astype(np.int64)


def block_links(cut: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, i, j, side, doc_id, label, packed) to links: the product of blocks i and j of a key.

    Rows of a pair of blocks come together; a block has at most BLOCK classes. Only links between
    different labels are returned, and only as many as connect them.
    """
    together = cut.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "doc_id")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)

        def product(rows: list[tuple]) -> list[tuple[int, int]]:
            left = [r for r in rows if r[0] == 0]
            right = [r for r in rows if r[0] == 1] or left
            shared = overlaps([r[3] for r in left], [r[3] for r in right])
            a = np.array([len(r[3]) for r in left])[:, None]
            b = np.array([len(r[3]) for r in right])[None, :]
            parent: dict = {}

            def root(x):
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            found = []
            for x, y in np.argwhere((shared > 0) & links(shared, a, b, percent)):
                one, other = root(left[x][2]), root(right[y][2])
                if one != other:
                    parent[one] = other
                    found.append((left[x][1], right[y][1]))
            return found

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return _batch(
                {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
            )

        pair, rows = None, []
        names = ("key", "i", "j", "side", "doc_id", "label", "packed")
        for batch in batches:
            for key, i, j, side, doc_id, label, packed in zip(*(batch.column(c).to_pylist() for c in names)):
                if (key, i, j) != pair:
                    if rows:
                        yield out(product(rows))
                    pair, rows = (key, i, j), []
                rows.append((side, doc_id, label, shingles.of_bytes(unpacked(packed))))
        if rows:
            yield out(product(rows))

    return together.mapInArrow(multiply, "a long, b long")


def product_keys(long_rows: DataFrame) -> DataFrame:
    """(gram, doc_id, n, label) to (key, doc_id, n, label): the sets that are multiplied together.

    Columns that hold one label need nothing more. Columns of much the same documents, as those of
    many near copies, would repeat the same product: columns that are connected through documents
    are multiplied as one where that is less work than all of them one by one.
    """
    mixed = (
        long_rows.groupBy("gram")
        .agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.min("doc_id").alias("head"), F.count("*").alias("length"),
        )
        .filter("low <> high")
    )
    rows = lookup(long_rows, written(mixed.select("gram", "head", "length"), "mixed"), ["gram"])
    rows = written(rows.filter("head is not null"), "mixed-rows")
    chained = components(rows.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    chained = written(chained.withColumnsRenamed({"node": "doc_id", "component": "cluster"}), "clusters")
    rows = written(rows.join(chained, "doc_id"), "clustered-rows")
    # Work is counted in rows that meet: each document once for each block it may link with.
    per_row = 1 + F.col("length") / F.lit(2.0 * BLOCK)
    one_by_one = rows.groupBy("cluster").agg(F.sum(per_row).alias("singly"))
    sizes = chained.groupBy("cluster").agg(F.count("*").alias("size"))
    together = F.col("size") * (1 + F.col("size") * NEAR_SIZES / F.lit(2.0 * BLOCK))
    whole = one_by_one.join(sizes, "cluster").select(
        "cluster", (together <= F.col("singly")).alias("whole")
    )
    rows = lookup(rows, written(whole, "whole"), ["cluster"])
    key = F.when(F.col("whole"), F.struct(F.lit(0).alias("kind"), F.col("cluster").alias("id"))).otherwise(
        F.struct(F.lit(1).alias("kind"), F.col("gram").alias("id"))
    )
    text_key = F.concat_ws(":", key["kind"].cast("string"), key["id"].cast("string"))
    return rows.select(text_key.alias("key"), "doc_id", "n", "label").distinct()


def blocks_of(keyed: DataFrame, percent: int) -> DataFrame:
    """(key, doc_id, n, label) to (key, i, j, side, doc_id, label).

    Each key's documents are ordered by size and cut into blocks, those of its largest label apart
    from the others if they fill a block; each pair of blocks that sizes allow to link, and that are
    not both of the largest label, gets the rows of both.
    """
    keyed = written(keyed, "keyed-rows")
    sizes = keyed.groupBy("key", "label").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top")).filter(F.col("top.size") >= BLOCK)
    largest = written(largest.select("key", F.col("top.label").alias("largest")), "largest")
    inner = F.coalesce(F.col("label") == F.col("largest"), F.lit(False))
    rows = lookup(keyed, largest, ["key"]).withColumn("inner", inner)
    # Keys of many rows are numbered in parts.
    placed = scan(ordered(rows.drop("largest"), ["key", "inner"], ["n", "doc_id"]), place=row_count()).done()
    block = F.floor((F.col("place") - 1) / BLOCK).cast("int")
    # Blocks of the largest component have numbers below zero.
    rows = written(placed.withColumn("block", F.when(F.col("inner"), -1 - block).otherwise(block)), "long-rows")
    spans = rows.groupBy("key", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    either = (F.col("y.block") < 0) | (F.col("x.block") <= F.col("y.block"))
    near = (
        spans.filter("block >= 0").alias("x")
        .join(spans.alias("y"), (F.col("x.key") == F.col("y.key")) & either)
        .filter(F.col("y.least") * percent <= F.col("x.most") * 100)
        .filter(F.col("x.least") * percent <= F.col("y.most") * 100)
        .select(F.col("x.key").alias("key"), F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    )
    near = written(near, "block-pairs")
    sides = near.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    side = F.when(F.col("block") == F.col("i"), 0).otherwise(1)
    return sides.join(rows, ["key", "block"]).select("key", "i", "j", side.alias("side"), "doc_id", "label")


def spanning(pairs: DataFrame) -> DataFrame:
    """Of each document's pairs (a, b) those with its smallest partner, by id and by a hash of it."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    chosen = both.groupBy("a").agg(
        F.min("b").alias("one"), F.min(F.struct(F.xxhash64("b").alias("rank"), "b"))["b"].alias("other")
    )
    ends = chosen.select("a", F.explode(F.array("one", "other")).alias("b"))
    return ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component (node, component)."""
    for end in ("a", "b"):
        label = joined.select(F.col("node").alias(end), F.col("component").alias(f"label_{end}"))
        pairs = pairs.join(label, end, "left")
    different = F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    return pairs.filter(different).select("a", "b")


def jaccard_components(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text) to (doc_id, n_shingles, component_id), one row per document."""
    seen = sets_and_counts(documents, width)
    listed, level = column_order(seen.filter("value is not null"))
    members = seen.filter("value is null").select("doc_id", "n", "high", "low")
    sketches = seen.filter("doc_id is not null").select("doc_id", "n", "bits")
    # One document stands for each class.
    classes = written(
        members.filter("n > 0").groupBy("high", "low").agg(F.min("doc_id").alias("first")), "classes"
    )
    ids = classes.filter("first is not null").select(F.col("low").alias("class"), F.col("first").alias("doc_id"))
    texts = documents.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")

    columns = short_and_long(entries(documents, width, percent, listed, level), percent)
    long_entries = columns.filter("gram is not null").select("gram", F.col("a").alias("class"), F.col("na").alias("n")).distinct()
    long_entries = written(long_entries, "long-entries")
    counted = (
        columns.filter("gram is null")
        .groupBy("a", "b", "na", "nb")
        .agg(F.count("*").alias("shared"))
    )
    # Entries of long columns were not counted; a class may share as many as it has.
    uncounted = long_entries.groupBy("class").agg(F.count("*").alias("long"))
    counted = counted.join(uncounted.withColumnsRenamed({"class": "a", "long": "long_a"}), "a", "left").join(
        uncounted.withColumnsRenamed({"class": "b", "long": "long_b"}), "b", "left"
    )
    # Of what two sets must share, each may have as many outside its kept entries as were not kept;
    # the set whose entries end first in the order decides, so the weaker bound holds.
    needed_of = lambda c: F.ceil(F.col(c) * percent / 100.0 - 1e-9)
    outside = lambda c: needed_of(c) - 1 - F.floor(F.col(c) / SPARE)
    both_need = F.ceil((F.col("na") + F.col("nb")) * percent / (100.0 + percent) - 1e-9)
    at_least = (
        both_need
        - F.greatest(outside("na"), outside("nb"))
        - F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    )
    pairs = counted.filter(F.col("shared") >= at_least).select("a", "b")

    # Sets a and b that link share at least ``needed`` of the larger, and so 1 + spare(smaller) +
    # needed(larger) - needed(smaller) kept entries, which is spare(n) or more for the n of either.
    # One with fewer entries in long columns shares a short one with each partner: pairs has it.
    enough = uncounted.join(long_entries.select("class", "n").distinct(), "class")
    enough = enough.filter(F.col("long") >= F.floor(F.col("n") / SPARE)).select("class")
    long_entries = written(long_entries.join(enough, "class", "left_semi"), "needed-entries")

    by_hash = F.struct(F.xxhash64("class").alias("rank"), F.col("class"))
    pivots = long_entries.groupBy("gram").agg(
        F.min("class").alias("p1"), F.max("class").alias("p2"), F.min(by_hash)["class"].alias("p3")
    )
    to_pivots = lookup(long_entries, written(pivots, "pivots"), ["gram"]).select(
        F.col("class").alias("a"), F.explode(F.array("p1", "p2", "p3")).alias("b")
    )
    pairs = pairs.unionByName(to_pivots.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    asked = written(
        pairs.distinct()
        .join(ids.withColumnsRenamed({"class": "a", "doc_id": "doc_a"}), "a")
        .join(ids.withColumnsRenamed({"class": "b", "doc_id": "doc_b"}), "b")
        .select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"))
        .filter("a <> b"),
        "pairs",
    )
    first = written(spanning(asked), "first-pairs")
    likely = written(possible(first, sketches, percent), "possible")

    # Texts that may be needed, of pairs or of rows of long columns, are shuffled once.
    wanted = ends(asked).unionByName(long_entries.join(ids, "class").select("doc_id")).distinct()
    wanted = written(wanted, "wanted")
    if fits(wanted, Settings().broadcast_rows):
        texts = packed_texts(of_ids(texts, wanted))
    else:
        texts = of_ids(packed_texts(texts), wanted)
    texts = written(texts, "texts")
    edges = written(verified(likely, texts, width, percent), "links")
    joined = written(components(edges), "first-components")
    open_pairs = written(apart(asked.join(first, ["a", "b"], "left_anti"), joined), "open-pairs")
    if not open_pairs.isEmpty():
        likely = written(possible(open_pairs, sketches, percent), "possible")
        edges = written(edges.unionByName(verified(likely, texts, width, percent)), "more-links")

    if not long_entries.isEmpty():
        joined = written(components(edges), "first-components")
        long_rows = long_entries.join(ids, "class").join(
            joined.withColumnsRenamed({"node": "doc_id", "component": "label"}), "doc_id", "left"
        )
        long_rows = long_rows.select("gram", "doc_id", "n", F.coalesce("label", "doc_id").alias("label"))
        cut = blocks_of(product_keys(written(long_rows, "long-labels")), percent)
        more = block_links(cut.join(texts, "doc_id"), width, percent)
        edges = written(edges.unionByName(more), "all-links")

    found = written(components(edges), "components")
    by_class = written(
        classes.join(found.withColumnRenamed("node", "first"), "first", "left").select(
            "high", "low", F.coalesce("component", "first").alias("component_id")
        ),
        "class-components",
    )
    met = lookup(members, by_class, ["high", "low"])
    return met.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, as they are, of which one of each component is kept: that of the smallest id.

    Rows without an id are kept. Where several rows share an id, different texts among them are
    judged each by itself, and equal ones are one document.
    """
    known = documents.filter("doc_id is not null")
    nameless = documents.filter("doc_id is null")
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # Sketches and entries are larger than what is left of them, and the texts are shuffled next.
        kept = written_alone(
            lambda: jaccard_components(documents, width, percent).filter("component_id = doc_id").select("doc_id"),
            "found",
        )
        return documents.join(kept, "doc_id", "left_semi").unionByName(nameless)

    # A text under an id is a document with a number of its own.
    own, name = F.xxhash64("doc_id", "text"), unused(documents, "own")
    numbered = known.select(own.alias("doc_id"), F.col("doc_id").alias("named"), "text")
    found = written_alone(
        lambda: jaccard_components(numbered.select("doc_id", "text"), width, percent).select("doc_id", "component_id"),
        "found",
    )
    ids = numbered.select("doc_id", "named").distinct()
    first = F.min(F.struct("named", "doc_id"))["doc_id"].alias(name)
    kept = written(found.distinct().join(ids, "doc_id").groupBy("component_id").agg(first).select(name), "kept")
    rows = known.withColumn(name, own).join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
    return rows.select(*[F.col(f"`{c}`") for c in documents.columns]).unionByName(nameless)
