"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Slot i of the schedule takes the i-th van der Corput point, which falls into one source's part of
the cumulative targets; the k-th slot of a source takes the source's k-th block. Blocks are equal
cuts, ``block`` words long, of the source's shuffled documents, laid end to end twice. A document
is taken as often as its words lie in blocks that a slot took.

Running totals go through buckets of hash prefixes (documents) and ranges of slots, so that a
source with most of the rows is spread over many tasks. Only one row per source, and one per source
and bucket, is ever ordered as a whole.

Defined results: null texts and texts without words have size 0 and are taken 0 times; the null
source is a source, last in order; repeated rows are documents of their own; a source without words
has target 0; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrace.llm.common import word_count
from velotrace.operators.joins import lookup
from velotrace.session import written

WEIGHTS = (5, 2, 1)
#: Parts of the unit interval by which slots meet the sources' shares.
CELLS = 4096
#: Bits of a van der Corput point; a double holds them exactly.
POINT_BITS = 52


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """(source, size) per document to one row per source: place, source_size, target, low, high.

    Targets are proportional to the weights and sum to ``share`` of all sizes, but none is above
    ``repeats`` times its source's size. ``low`` and ``high`` bound the source's part of the
    targets laid end to end on the unit interval.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(w) for w in weights])
    placed = by_source.withColumn("place", F.row_number().over(by_code_point) - 1).withColumns(
        {
            "weight": F.get(kinds, F.col("place") % len(weights)),
            "most": F.col("source_size") * repeats,
        }
    )
    # Sources reach their limit in the order of limit by weight. Before each, what is left of the
    # whole is divided by the weights that are left; the first that stays below sets the level.
    whole = Window.partitionBy()
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "place")
    upto = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(upto), F.lit(0))
    ) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    leveled = placed.withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "level"))).over(whole)["level"]
    )
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    by_place = Window.orderBy("place")
    laid = leveled.withColumn("target", F.coalesce(target, F.lit(0.0))).withColumns(
        {
            "_upto": F.sum("target").over(by_place),
            "_all": F.sum("target").over(by_place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    high = F.when(F.col("_all") > 0, F.col("_upto") / F.col("_all")).otherwise(F.lit(0.0))
    return laid.withColumn("high", high).select(
        "source",
        "place",
        "source_size",
        "target",
        F.coalesce(F.lag("high").over(by_place), F.lit(0.0)).alias("low"),
        # The points end before 1, whatever the rounding of the sums.
        F.when(F.col("high") >= F.max("high").over(whole), F.lit(1.0)).otherwise(F.col("high")).alias("high"),
    )


def radical_inverse(i: Column) -> Column:
    """The i-th van der Corput point: the bits of i mirrored behind the point."""
    mirrored = F.reverse(F.lpad(F.bin(i), POINT_BITS, "0"))
    return F.conv(mirrored, 2, 10).cast("long") / F.lit(float(2**POINT_BITS))


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """(slot, place, rank): which source each slot takes, and its number among that source's.

    Slots are ranked within ranges, of which a source has at most 10,000 to add up.
    """
    spark = sources.sparkSession
    slots_per_range = max(8192, math.ceil(slots / 10_000))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), radical_inverse(F.col("id")).alias("point")
    ).withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    parts = sources.filter("high > low").select(
        "place",
        "low",
        "high",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * CELLS).cast("int"),
                F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)).cast("int"),
            )
        ).alias("cell"),
    )
    taken = (
        points.join(parts, "cell")
        .filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
        .select("slot", "place", F.expr(f"slot div {slots_per_range}").alias("range"))
    )
    taken = written(taken, "schedule")
    before = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = taken.groupBy("place", "range").count()
    offsets = counts.select(
        "place", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("place", "range").orderBy("slot")
    ranked = taken.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(offsets, ["place", "range"]).select(
        "slot", "place", (F.col("rank") + F.col("offset")).alias("rank")
    )


def shuffled_streams(sizes: DataFrame, seed: str, rows_per_bucket: int = 20_000) -> DataFrame:
    """``start``: the words before each document in its source's shuffled stream."""
    digits = max(1, math.ceil(math.log(max(sizes.count(), 1) / rows_per_bucket + 1, 16)))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    rows = sizes.withColumn("key", key).withColumn("bucket", F.substring("key", 1, digits))
    before = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("place", "bucket").agg(F.sum("size").alias("sum"))
    offsets = sums.select(
        "place", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset")
    )
    within = (
        Window.partitionBy("place", "bucket")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return inside.join(offsets, ["place", "bucket"]).withColumn(
        "start", F.col("inside") + F.col("offset")
    ).drop("inside", "offset", "key", "bucket")


def mix(
    documents: DataFrame,
    weights=WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
    block: int = 128,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """The mix, and the documents with what the mix takes of them.

    The mix has (slot, source, doc_id, first_word, words), one row per slot and document: a reader
    that goes through the slots in order sees every prefix near the targets. The second table has
    (doc_id, source, size, source_size, target, taken).
    """
    sizes = written(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sources = written(targets(sizes, weights, share, repeats), "sources")
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    placed = lookup(sizes, sources.drop("low", "high"), ["source"])
    streams = shuffled_streams(placed, seed)

    start = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    passes = streams.withColumn("pass", start).withColumn(
        "start", F.col("start") + F.col("pass") * F.col("source_size")
    )
    cut = F.when(
        F.col("size") > 0,
        F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")),
    )
    pieces = passes.withColumn("rank", F.explode_outer(cut))
    first = F.greatest(F.col("start"), F.col("rank") * block)
    words = F.least(F.col("start") + F.col("size"), (F.col("rank") + 1) * block) - first
    pieces = pieces.withColumns({"first_word": first - F.col("start"), "words": words})

    slots = schedule(sources, math.ceil(total / block))
    met = written(pieces.join(slots, ["place", "rank"], "left"), "mix")
    in_order = met.filter("slot is not null").select("slot", "source", "doc_id", "first_word", "words")
    # The place in the stream tells repeated rows apart; rows without words may share it.
    stream_start = F.col("start") - F.col("pass") * F.col("source_size")
    sized = (
        met.filter("size > 0")
        .groupBy("doc_id", "source", "size", "source_size", "target", stream_start.alias("_start"))
        .agg(F.sum(F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)).alias("taken"))
        .drop("_start")
    )
    empty = met.filter("size = 0 and pass = 0").select(
        "doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")
    )
    return in_order, sized.unionByName(empty)
