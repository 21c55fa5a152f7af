"""Window functions over ordered series, with no limit on the size of one series.

A plain window puts every row of a key in one task. Here the keys are counted first. Keys of at
most ``group_rows`` rows use the plain window. The rows of larger keys are range-partitioned on
(key, order) into chunks of about that size (larger ones beyond 20,000 chunks), each function is computed inside the chunks, and the
state at the start of each chunk is carried over from a table with one row per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from velotrace.operators.joins import restrict, same_keys, small_side
from velotrace.session import written
from velotrace.settings import Settings

CHUNK = "_chunk"
TIE = "_tie"
ROW = "_row"
MOST_PIECES = 20_000


@dataclass(frozen=True)
class Series:
    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: DataFrame | None = None

    @property
    def parts(self) -> list[str]:
        return list(self.keys) + ([CHUNK] if self.split is not None else [])

    @property
    def forward(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(
            *[F.col(c).asc_nulls_last() for c in self.order]
        )

    @property
    def backward(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(
            *[F.col(c).desc_nulls_first() for c in self.order]
        )

    @property
    def place(self) -> Column:
        """The order as one comparable value, nulls last."""
        return F.struct(*[x for c in self.order for x in (F.col(c).isNull(), F.col(c))])

    def map(self, change: Callable[[DataFrame], DataFrame]) -> "Series":
        """Apply a row-wise change."""
        split = None if self.split is None else change(self.split)
        return replace(self, rows=change(self.rows), split=split)

    def done(self) -> DataFrame:
        return self.rows.drop(CHUNK, TIE, ROW)


def key_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, as a table that several steps on the same rows can share."""
    return written(df.groupBy(*keys).count(), "key-sizes")


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    settings: Settings = Settings(),
    sizes: DataFrame | None = None,
) -> Series:
    """Rows of each key in the given order, nulls last, ties broken by row content.

    The rows are counted per key unless ``sizes`` (from ``key_sizes``) already tells.
    """
    keys = tuple(keys)
    columns = tuple(c for c in order if c in df.columns) + (TIE,)
    rows = df.withColumn(TIE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))

    if sizes is None:
        sizes = rows.groupBy(*keys).count() if keys else rows.agg(F.count("*").alias("count"))
    hot = sizes.filter(F.col("count") > settings.group_rows)
    found = hot.agg(F.count("*").alias("keys"), F.sum("count").alias("rows")).first()
    if not found["keys"]:
        return Series(rows, keys, columns)

    if keys:
        hot_keys = small_side(written(hot.select(*keys), "hot-keys"), settings)
        hot_rows = restrict(rows, hot_keys, keys, "left_semi")
        cold_rows = restrict(rows, hot_keys, keys, "left_anti")
    else:
        hot_rows, cold_rows = rows, None

    # The row number is written before it decides a partition, so that exact copies of a row
    # can part ways and a repeated task still sees the same numbers.
    numbered = written(hot_rows.withColumn(ROW, F.monotonically_increasing_id()), "hot-rows")
    columns = columns + (ROW,)
    # Chunks grow with the whole beyond a number that one job can handle.
    pieces = min(2 * math.ceil(found["rows"] / settings.group_rows), MOST_PIECES)
    split = written(
        numbered.repartitionByRange(
            pieces, *[F.col(c).asc_nulls_last() for c in keys + columns]
        ).withColumn(CHUNK, F.spark_partition_id() + 1),
        "hot-chunks",
    )
    everything = split
    if cold_rows is not None:
        everything = split.unionByName(
            cold_rows.withColumn(ROW, F.lit(None).cast("long")).withColumn(CHUNK, F.lit(0))
        )
    return Series(everything, keys, columns, split)


@dataclass(frozen=True)
class Scan:
    """One window function: its value inside a chunk, and how chunks of a key connect."""

    local: Callable[[Series], Column]
    summary: Callable[[Series], Column]
    carry: Callable[[Column, Series], Column]
    combine: Callable[[Column, Column], Column]


def _chunks(series: Series) -> WindowSpec:
    return Window.partitionBy(*series.keys).orderBy(CHUNK)


_BEFORE = (Window.unboundedPreceding, -1)


def previous(value: Column) -> Scan:
    """``value`` of the row before; must be a struct, so that null means no such row."""
    return Scan(
        local=lambda s: F.lag(value).over(s.forward),
        summary=lambda s: F.max_by(value, s.place),
        carry=lambda v, s: F.lag(v).over(_chunks(s)),
        combine=F.coalesce,
    )


def last_before(value: Column) -> Scan:
    """The last non-null ``value`` strictly before the row."""
    return Scan(
        local=lambda s: F.last(value, ignorenulls=True).over(s.forward.rowsBetween(*_BEFORE)),
        summary=lambda s: F.max_by(value, F.when(value.isNotNull(), s.place)),
        carry=lambda v, s: F.last(v, ignorenulls=True).over(_chunks(s).rowsBetween(*_BEFORE)),
        combine=F.coalesce,
    )


def first_after(value: Column) -> Scan:
    """The first non-null ``value`` strictly after the row.

    Computed as the last one before it in reverse order: a frame that is unbounded on the right
    would be evaluated again for every row.
    """
    return Scan(
        local=lambda s: F.last(value, ignorenulls=True).over(s.backward.rowsBetween(*_BEFORE)),
        summary=lambda s: F.min_by(value, F.when(value.isNotNull(), s.place)),
        carry=lambda v, s: F.last(v, ignorenulls=True).over(
            Window.partitionBy(*s.keys).orderBy(F.col(CHUNK).desc()).rowsBetween(*_BEFORE)
        ),
        combine=F.coalesce,
    )


def running_sum(value: Column) -> Scan:
    """Sum up to and including the row."""
    return Scan(
        local=lambda s: F.sum(value).over(
            s.forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
        summary=lambda s: F.sum(value),
        carry=lambda v, s: F.sum(v).over(_chunks(s).rowsBetween(*_BEFORE)),
        combine=lambda a, b: F.coalesce(a + b, a, b),
    )


def running_max(value: Column) -> Scan:
    """Maximum up to and including the row."""
    return Scan(
        local=lambda s: F.max(value).over(
            s.forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
        summary=lambda s: F.max(value),
        carry=lambda v, s: F.max(v).over(_chunks(s).rowsBetween(*_BEFORE)),
        combine=F.greatest,
    )


def row_count() -> Scan:
    """Position of the row in its series, from 1."""
    return running_sum(F.lit(1).cast("long"))


def numbered(series: Series, name: str) -> Series:
    """Add each row's position, from 1, and order the series by it from here on.

    Exact copies of a row may come in any order. Once numbered, their order is the same for
    every later function, in either direction.
    """
    return replace(scan(series, **{name: row_count()}), order=(name,))


def series_size() -> Scan:
    """Rows of the whole series."""
    return Scan(
        local=lambda s: F.count("*").over(Window.partitionBy(*s.parts)),
        summary=lambda s: F.count("*"),
        carry=lambda v, s: F.sum(v).over(Window.partitionBy(*s.keys)),
        combine=lambda a, b: F.coalesce(b, a),
    )


def series_total(value: Column) -> Scan:
    """Sum over the whole series."""
    return Scan(
        local=lambda s: F.sum(value).over(Window.partitionBy(*s.parts)),
        summary=lambda s: F.sum(value),
        carry=lambda v, s: F.sum(v).over(Window.partitionBy(*s.keys)),
        combine=lambda a, b: F.coalesce(b, a),
    )


def scan(series: Series, **scans: Scan) -> Series:
    """Add one column per window function."""
    local = {f"_l_{n}": s.local(series) for n, s in scans.items()}
    if series.split is None:
        return replace(
            series, rows=series.rows.withColumns({n: local[f"_l_{n}"] for n in scans})
        )

    totals = series.split.groupBy(*series.parts).agg(
        *[s.summary(series).alias(f"_s_{n}") for n, s in scans.items()]
    )
    carried = totals.select(
        *series.parts, *[s.carry(F.col(f"_s_{n}"), series).alias(f"_c_{n}") for n, s in scans.items()]
    )
    # A chunk is a run of the sorted hot rows, so there are at most chunks + hot keys rows here.
    carried = small_side(written(carried, "carry"))

    def attach(df: DataFrame) -> DataFrame:
        kept = [F.col(f"l.`{c}`") for c in df.columns]
        joined = (
            df.withColumns(local)
            .alias("l")
            .join(carried.alias("r"), same_keys(series.parts), "left")
        )
        return joined.select(
            *kept,
            *[
                s.combine(F.col(f"l._l_{n}"), F.col(f"r._c_{n}")).alias(n)
                for n, s in scans.items()
            ],
        )

    return series.map(attach)
