"""The same operators on streams of message files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from velotrace.operators.events import active_rows, axis_statistics, explode_hits, settle
from velotrace.operators.regions import region_rows
from velotrace.schemas import DEVICE
from velotrace.settings import Settings
from velotrace.sources.messages import FILES, decoded, to_telemetry


def message_stream(spark: SparkSession, root: str, files_per_batch: int = 10_000) -> DataFrame:
    """Telemetry rows with ``event_time`` from new message files below a folder."""
    files = spark.readStream.options(**FILES).option("maxFilesPerTrigger", files_per_batch)
    messages = decoded(files.text(root))
    return with_event_time(to_telemetry(messages))


def with_event_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_time", F.timestamp_seconds(F.col("timestamp")))


def daily_region_counts(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """Rows per region and UTC day."""
    return (
        region_rows(rows)
        .withWatermark("event_time", late)
        .groupBy(F.window("event_time", "1 day"), "region")
        .agg(F.count("*").alias("rows"))
        .select(F.col("window.start").alias("day"), "region", "rows")
    )


def daily_event_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events per type and UTC day."""
    return (
        events.withWatermark("event_time", late)
        .groupBy(F.window("event_time", "1 day"), "event_type")
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("day"), "event_type", "events")
    )


def live_trips(
    rows: DataFrame, settings: Settings = Settings(), late: str = "1 hour"
) -> DataFrame:
    """Trips as sessions of a device that end after the trip gap.

    Rows without a device belong to no trip, as in the batch rule; rows without a time cannot be
    placed in a session and are left out too.
    """
    gap = f"{int(settings.trip_gap_s)} seconds"
    return (
        rows.filter(F.col(DEVICE).isNotNull())
        .withWatermark("event_time", late)
        .groupBy(F.session_window("event_time", gap).alias("session"), DEVICE)
        .agg(
            F.count("*").alias("points"),
            F.min("timestamp").alias("started"),
            F.max("timestamp").alias("ended"),
            F.max("position_speed").alias("max_speed"),
        )
        .drop("session")
    )


def thresholds_of(history: DataFrame, settings: Settings = Settings()) -> dict[str, Column]:
    """Statistics of past trips, to be refreshed daily and held against new rows."""
    return settle(axis_statistics(active_rows(history), settings), ())


def live_events(
    rows: DataFrame, thresholds: dict[str, Column], settings: Settings = Settings()
) -> DataFrame:
    """Events among new rows; stateless, so it keeps up with any number of devices."""
    found = explode_hits(active_rows(rows).withColumns(thresholds), settings)
    return found.drop(*thresholds)


def alerts(events: DataFrame, least: int = 8) -> DataFrame:
    return events.filter(F.col("severity") >= least)


def run_batches(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process all files that are there, batch by batch."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
