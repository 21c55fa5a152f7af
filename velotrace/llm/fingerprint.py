"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

Each shingle of five words is hashed once; the top bits of the hash name one of ``bins`` bins and
the smallest hash of a bin stays. An empty bin takes the value of a filled one, chosen by a hash
of the pair of bins that is the same for all documents (optimal densification). The low-order
``BITS`` bits of each bin, in hexadecimal, are the fingerprint. Two fingerprints agree in a bin with
the sets' similarity, or by chance with probability 2^-BITS, which the likeness takes out.

Defined results: a text of fewer than five words is one shingle of all its words; a null text, or
one without words, has the empty fingerprint, whose likeness is 1 to itself and 0 to any other.
Equal texts have equal fingerprints, and words are compared as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrace.llm.common import GAP, let
from velotrace.session import written

SHINGLE = 5
#: 2^7 bins, and the bits kept of each.
BIN_BITS = 7
BITS = 8

_VALUE_BITS = 64 - BIN_BITS
_HIGHEST = 2**_VALUE_BITS - 1
#: Ids that share a chunk when each document is put beside the next one.
CHUNK_IDS = 256


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """A hash for each run of ``width`` words; one for all words if there are fewer."""

    def of_words(hashed: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(hashed) - width),
            lambda i: F.xxhash64(*[F.get(hashed, i + j) for j in range(width)]),
        )
        return (
            F.when(F.size(hashed) >= width, runs)
            .when(F.size(hashed) > 0, F.array(F.xxhash64(hashed)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    words = F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")
    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def _bin(value: Column) -> Column:
    return F.shiftright(value, _VALUE_BITS)


def bin_minima(hashes: Column, bin_bits: int = BIN_BITS) -> Column:
    """The smallest hash of each bin in the order of bins; the highest of its range if empty.

    The highest value of every bin's range is added, so one sort brings each bin's smallest value
    to the head of the bin.
    """
    half = 2 ** (bin_bits - 1)
    ends = F.transform(
        F.sequence(F.lit(-half), F.lit(half - 1)),
        lambda b: F.shiftleft(b.cast("bigint"), 64 - bin_bits) + F.lit(_HIGHEST),
    )
    return let(
        F.sort_array(F.concat(hashes, ends)),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))),
    )


def _filled(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_HIGHEST)) != F.lit(_HIGHEST)


def densified(minima: Column) -> Column:
    """Empty bins take a filled bin's value: the one whose hash with the empty bin is smallest."""

    def borrow(filled: Column, empty: Column) -> Column:
        # The low bits of the hash give way to the place in the list of filled bins.
        ranks = F.transform(
            filled,
            lambda x, i: F.xxhash64(_bin(empty), _bin(x))
            .bitwiseAND(F.lit(-(2**BIN_BITS)))
            .bitwiseOR(i.cast("bigint")),
        )
        return F.get(filled, F.array_min(ranks).bitwiseAND(F.lit(2**BIN_BITS - 1)).cast("int"))

    return let(
        F.filter(minima, _filled),
        lambda filled: F.when(F.size(filled) == 0, F.array().cast("array<bigint>"))
        .when(F.size(filled) == 2**BIN_BITS, minima)
        .otherwise(F.transform(minima, lambda x: F.when(_filled(x), x).otherwise(borrow(filled, x)))),
    )


def packed(values: Column) -> Column:
    """The low-order bits of all bins as hexadecimal digits."""
    digits = BITS // 4
    low = F.transform(
        values, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(2**BITS - 1))), digits, "0")
    )
    return F.lower(F.array_join(low, ""))


def fingerprint(text: Column) -> Column:
    minima = bin_minima(shingle_hashes(text))
    return packed(let(minima, densified))


def likeness(a: Column, b: Column) -> Column:
    """The similarity of two fingerprints, without the agreement that is due to chance."""
    size = BITS // 8
    bins = F.sequence(F.lit(0), F.lit(2**BIN_BITS - 1))

    def part(packed: Column, i: Column) -> Column:
        return F.substring(packed, i * size + 1, F.lit(size))

    both = F.struct(F.unhex(a).alias("a"), F.unhex(b).alias("b"))
    same = let(both, lambda p: F.size(F.filter(bins, lambda i: part(p["a"], i) == part(p["b"], i))))
    chance = 2.0**-BITS
    estimate = (same / F.lit(float(2**BIN_BITS)) - chance) / (1 - chance)
    return (
        F.when(a == b, F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), estimate))
    )


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, fingerprint), without a shuffle."""
    return documents.select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


def with_next(documents: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """Each document with the columns ``carried``, and as ``next_*`` those of the next document.

    Next is by ascending doc_id, then text; after the last comes the first. Null ids come last, in
    the order of a hash of the text. Documents meet in chunks of neighbouring ids, so the texts
    are shuffled once. The first document of each chunk is also sent to the chunk before it: one
    id a chunk is looked up, which Spark broadcasts if the ids' table is small enough for that.
    """
    text_hash = F.shiftright(F.xxhash64("text"), 44)
    place = F.coalesce(
        F.floor(F.col("doc_id") / CHUNK_IDS).cast("bigint"), F.lit(2**61) + text_hash
    )
    rows = documents.select("doc_id", "text", place.alias("_chunk"))

    # Chunks in order; the chunk before each is found within ranges of chunks, then across them.
    chunks = written(
        rows.groupBy("_chunk").agg(F.min("doc_id").alias("first_id")), "chunks"
    ).withColumn("range", F.expr("_chunk div 65536"))
    in_range = Window.partitionBy("range").orderBy("_chunk")
    near = chunks.withColumn("before", F.lag("_chunk").over(in_range))
    # One row per 65,536 chunks, or 16 million ids.
    ranges = chunks.groupBy("range").agg(F.max("_chunk").alias("last"))
    across = Window.orderBy("range")
    ends = ranges.select(
        "range",
        F.coalesce(
            F.lag("last").over(across), F.max("last").over(Window.partitionBy())
        ).alias("end_before"),
    )
    firsts = written(
        near.join(ends, "range").select(
            F.col("_chunk").alias("of"), "first_id", F.coalesce("before", "end_before").alias("before")
        ),
        "chunk-firsts",
    )
    tails = rows.join(
        firsts, (rows["_chunk"] == firsts["of"]) & rows["doc_id"].eqNullSafe(firsts["first_id"])
    ).select("doc_id", "text", F.col("before").alias("_chunk"), F.lit(True).alias("_tail"))

    both = rows.withColumn("_tail", F.lit(False)).unionByName(tails)
    both = both.withColumns({c: e for c, e in carried.items() if c not in ("doc_id", "text")})
    order = Window.partitionBy("_chunk").orderBy(
        "_tail", F.col("doc_id").asc_nulls_last(), F.shiftright(F.xxhash64("text"), 44), "text"
    )
    beside = both.select(
        "*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]
    )
    return beside.filter(~F.col("_tail")).drop("_tail", "_chunk")
