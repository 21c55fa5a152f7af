"""Combining regions into the published daily trips table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.operators.clean import sort_rows
from velotrace.schemas import TRIP_COLUMNS

DROPPED = [
    "position_latitude",
    "position_longitude",
    "was_snapped",
    "trip_break",
    "time_diff",
    "source_region",
]
RENAMED = {"snapped_lat": "position_latitude", "snapped_lon": "position_longitude"}


def union_regions(regions: Mapping[str, DataFrame]) -> DataFrame:
    """Union by column name; a column that a region lacks is null there."""
    tagged = [df.withColumn("source_region", F.lit(name)) for name, df in regions.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_by_position(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by position, under the first table's column names."""
    return reduce(DataFrame.union, tables)


def extra_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in TRIP_COLUMNS]


def final_columns(df: DataFrame) -> DataFrame:
    """The published columns in their order, then all others.

    Raw coordinates give way to the snapped ones, so dropping comes before renaming.
    """
    kept = df.drop(*DROPPED).withColumnsRenamed(RENAMED)
    first = [c for c in TRIP_COLUMNS if c in kept.columns]
    return kept.select(*[F.col(f"`{c}`") for c in first + extra_columns(kept)])


def publish(rows: DataFrame) -> DataFrame:
    """The daily trips table of united regions: final columns, in row order."""
    return final_columns(sort_rows(rows))


def daily_summary(trips: DataFrame) -> DataFrame:
    """Rows and distinct devices of a published table; rows without a device are not a device."""
    return trips.agg(
        F.count("*").alias("total_rows"), F.count_distinct("device_id").alias("devices")
    )
