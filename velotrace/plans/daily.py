"""The daily run, from messages to events, as one function per published table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.operators import clean, events, manifest, publish, regions, roads, segments, trips
from velotrace.operators.ordered import key_sizes, ordered
from velotrace.schemas import DEVICE, TIME_ORDER
from velotrace.session import scratch, written
from velotrace.settings import Settings
from velotrace.sources import messages as message_source
from velotrace.sources import quarantine, sinks, tables

SLICE = ("region", "date")


def enrich(
    df: DataFrame,
    settings: Settings = Settings(),
    road_points: DataFrame | None = None,
    routes: DataFrame | None = None,
    road_distances: DataFrame | None = None,
    road_lines: DataFrame | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Snap, fill gaps, and measure trips, for any number of region-days in one job.

    Positions go to the nearest of ``road_points(lat, lon)``, or to the nearest place on one of
    ``road_lines(road_id, seq, lat, lon)``.
    Devices are counted once for all steps, since none of them adds or removes rows.
    """
    rows = clean.add_trip_columns(clean.coerce_numeric(clean.without_serial(df)))
    sizes = key_sizes(rows, [*within, DEVICE])
    rows = clean.blank_repeats(rows, settings, within)
    if road_points is not None and road_lines is not None:
        raise ValueError("roads are either points or lines")
    index = None if road_points is None else roads.road_index(road_points, settings)
    index = index if road_lines is None else segments.segment_index(road_lines, settings)
    rows = roads.snap(rows, index, settings)
    if routes is None:
        # All further steps follow the same ordered series, so a large device is split once.
        series = clean.time_diff(ordered(rows, [*within, DEVICE], TIME_ORDER, settings, sizes))
        series = roads.interpolate_lines(series, settings, index)
        series = roads.fill_lines(series, settings)
        return trips.measure(series, settings, road_distances=road_distances).drop("_at")

    rows = written(clean.add_time_diff(rows, settings, within, sizes), "timed-rows")
    # Both passes join the rows to routes; without a cut the second would repeat the first.
    rows = written(
        roads.interpolate_gaps(rows, settings, routes, index, within, sizes), "filled-rows"
    )
    rows = roads.fill_missing(rows, settings, routes, within, sizes)
    return trips.trip_metrics(
        rows, settings, road_distances=road_distances, within=within, sizes=sizes
    )


def convert_messages(
    spark: SparkSession,
    root: str,
    out: str,
    day: date | None = None,
    rejects: str | None = None,
    extra_fields: Sequence[str] = (),
) -> DataFrame:
    """Message files to telemetry in dated folders; returns how many were read and rejected.

    Files that cannot be decoded are written to the folder ``rejects``, with their text, if it is
    given.
    """
    found = message_source.read_messages(spark, root, day, extra_fields)
    return store_messages(found, out, rejects, extra_fields)


def store_messages(
    messages: DataFrame, out: str, rejects: str | None = None, extra_fields: Sequence[str] = ()
) -> DataFrame:
    """Decoded messages to telemetry in dated folders, as ``convert_messages`` says."""
    found = written(messages, "messages")
    sinks.write_days(message_source.to_telemetry(found, extra_fields=extra_fields), out)
    if rejects is not None:
        message_source.rejected(found).write.mode("overwrite").parquet(rejects)
    return message_source.conversion_totals(found)


def converted_day(spark: SparkSession, converted: str, day: date) -> DataFrame:
    """The telemetry that ``convert_messages`` wrote for a day."""
    return tables.read_day_folder(spark, converted, day, "csv")


def split_day(df: DataFrame, day: date, out: str) -> None:
    """One slice per region; rows without a region are not written."""
    rows = regions.region_rows(df).withColumn("date", F.lit(day))
    sinks.write_slices(rows, out)


def enrich_slices(
    spark: SparkSession,
    split: str,
    out: str,
    settings: Settings = Settings(),
    force: bool = False,
    day: date | None = None,
    **road_tables: DataFrame,
) -> None:
    """Enrich the slices that have no output yet; other slices are listed, not read."""
    asked = pending_slices(spark, split, out, force)
    if day is not None:
        asked = asked.filter(F.col("date") == F.lit(day))
    # One row per region and day.
    todo = [(r.region, r.date) for r in asked.orderBy("date", "region").collect()]
    if todo:
        with scratch(spark):
            rows = tables.read_listed(spark, split, todo)
            sinks.write_slices(enrich(rows, settings, within=SLICE, **road_tables), out)


def pending_slices(spark: SparkSession, split: str, out: str, force: bool = False) -> DataFrame:
    """(region, date) of the slices that have input and, unless forced, no output."""

    def listed(root: str, stage: str) -> DataFrame:
        return manifest.manifest(tables.list_files(spark, root, "*.parquet"), stage)

    inputs = listed(split, "split").select("region", "date").distinct()
    return inputs if force else manifest.unprocessed_slices(inputs, listed(out, "enriched"))


def publish_day(spark: SparkSession, enriched: str, day: date) -> DataFrame:
    """The daily trips table: all regions, final columns with those that any region has, in row order."""
    rows = tables.read_slices(spark, enriched, day=day).drop("date")
    return publish.publish(rows.withColumnRenamed("region", "source_region"))


def publish_good(
    spark: SparkSession, enriched: str, day: date, rejects: str | None = None, kind: str = "parquet"
) -> DataFrame | None:
    """``publish_day`` of the files that can be read; None if there are none.

    Files that are empty or cannot be read are left out, and written with the reason to the folder
    ``rejects``, if it is given.
    """
    found = quarantine.read_good(spark, f"{enriched.rstrip('/')}/region=*/date={day}", kind, "part-*")
    if rejects is not None:
        found.rejects.write.mode("overwrite").parquet(rejects)
    if found.rows is None:
        return None
    region = F.regexp_extract("source_file", "/region=([^/]*)/", 1)
    return publish.publish(found.rows.withColumn("source_region", region).drop("source_file"))


def write_trips(
    spark: SparkSession, enriched: str, day: date, out: str, force: bool = False
) -> bool:
    """Publish a day to its folder below ``out`` unless it is there; tells whether it wrote."""
    if not force and day in tables.days_in(spark, out):
        return False
    with scratch(spark):
        sinks.write_day(publish_day(spark, enriched, day), out, day)
    return True


def read_trips(spark: SparkSession, published: str, day: date) -> DataFrame:
    """A published day."""
    return tables.read_day_folder(spark, published, day)


def detect_day(
    daily_trips: DataFrame, day: date, out: str, settings: Settings = Settings()
) -> None:
    """The day's events; a day without any still gets an empty table."""
    with scratch(daily_trips.sparkSession):
        sinks.write_day(events.abnormal_events(daily_trips, settings), out, day)
