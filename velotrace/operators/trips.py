"""Time, distance, speed and trip breaks along each device's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.functions.geo import haversine, ms_to_kmh, point_key
from velotrace.operators.joins import lookup, one_per_key
from velotrace.operators.ordered import (
    Series,
    ordered,
    previous,
    running_max,
    running_sum,
    scan,
    series_size,
)
from velotrace.schemas import DEVICE, TIME_ORDER
from velotrace.settings import Settings


def trip_metrics(
    df: DataFrame,
    settings: Settings = Settings(),
    lat: str = "snapped_lat",
    lon: str = "snapped_lon",
    first_fix_rule: str = "reference",
    road_distances: DataFrame | None = None,
    within: Sequence[str] = (),
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add ``time_s``, ``trip_break``, ``distance_m``, ``trip_id`` and recompute the speed.

    A break is a gap above the limit: ``time_s`` is -1 there and distance starts again at 0. With
    ``first_fix_rule="reference"`` the first located row after a trip's opening row also gets
    distance 0; ``"strict"`` measures it from the opening row. Devices with one row, and rows
    without a device, keep null distance and time. ``road_distances(from_key, to_key, total_m)``
    replaces the great-circle distance where it has the pair.
    """
    return measure(
        ordered(df, [*within, DEVICE], TIME_ORDER, settings, sizes),
        settings,
        lat,
        lon,
        first_fix_rule,
        road_distances,
    )


def measure(
    series: Series,
    settings: Settings = Settings(),
    lat: str = "snapped_lat",
    lon: str = "snapped_lon",
    first_fix_rule: str = "reference",
    road_distances: DataFrame | None = None,
) -> DataFrame:
    """``trip_metrics`` on the rows of each device."""
    within = series.keys[:-1]
    series = series.map(lambda d: d.drop("time_s", "trip_break", "distance_m", "trip_id"))
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    series = scan(
        series,
        _prev=previous(
            F.struct(
                F.col("timestamp").alias("ts"), F.col(lat).alias("lat"), F.col(lon).alias("lon")
            )
        ),
        _size=series_size(),
    )
    step = F.col("timestamp") - F.col("_prev.ts")
    has_device = F.col(DEVICE).isNotNull()

    def mark(rows: DataFrame) -> DataFrame:
        return rows.withColumn(
            "trip_break", F.coalesce(has_device & (step > settings.trip_gap_s), F.lit(False))
        ).withColumn("_opening", F.col("_prev").isNull() | F.col("trip_break"))

    series = scan(
        series.map(mark),
        _trip=running_sum(F.col("trip_break").cast("int")),
        _fixes=running_sum((known & ~F.col("_opening")).cast("int")),
    )
    series = scan(series, _fixes_before_trip=running_max(F.when(F.col("_opening"), F.col("_fixes"))))

    rows = series.done().withColumn(
        "_first_fix", known & (F.col("_fixes") - F.col("_fixes_before_trip") == 1)
    )
    measured = (
        haversine(F.col("_prev.lat"), F.col("_prev.lon"), F.col(lat), F.col(lon))
    )
    if road_distances is not None:
        rows = rows.withColumns(
            {
                "from_key": F.when(
                    known & F.col("_prev.lat").isNotNull(),
                    point_key(F.col("_prev.lat"), F.col("_prev.lon")),
                ),
                "to_key": F.when(known, point_key(F.col(lat), F.col(lon))),
            }
        )
        # Rows without a pair share a null key, which the lookup spreads like any hot key.
        rows = lookup(
            rows,
            one_per_key(
                road_distances.select("from_key", "to_key", "total_m"), ["from_key", "to_key"], "road_distances"
            ),
            ["from_key", "to_key"],
            settings,
        )
        measured = F.coalesce(F.col("total_m"), measured)
    skip_first = F.col("_first_fix") if first_fix_rule == "reference" else F.lit(False)
    counted = has_device & (F.col("_size") >= 2)
    rows = rows.withColumns(
        {
            "time_s": F.when(
                counted,
                F.when(F.col("_prev").isNull(), 0.0)
                .when(F.col("trip_break"), -1.0)
                .otherwise(step.cast("double")),
            ),
            "distance_m": F.when(
                counted,
                F.when(F.col("_opening") | skip_first, 0.0)
                .when(
                    known & F.col("_prev.lat").isNotNull() & F.col("_prev.lon").isNotNull(),
                    measured,
                )
                .otherwise(0.0),
            ),
            "trip_id": F.when(has_device, F.concat_ws("-", *within, DEVICE, "_trip")),
        }
    )
    if "position_speed" in rows.columns:
        speed = ms_to_kmh(F.col("distance_m") / F.col("time_s"))
        moving = F.when(
            F.coalesce(F.col("distance_m") > 0, F.lit(False)),
            F.when(speed <= settings.max_speed_kmh, speed).otherwise(0.0),
        ).otherwise(0.0)
        measurable = (
            F.col(lat).isNotNull() & F.col("_prev.lat").isNotNull() & (F.col("time_s") > 0)
        )
        rows = rows.withColumn(
            "position_speed",
            F.when(F.coalesce(measurable, F.lit(False)), moving).otherwise(F.col("position_speed")),
        )
    return rows.drop(
        "_prev", "_size", "_opening", "_trip", "_fixes", "_fixes_before_trip", "_first_fix",
        "from_key", "to_key", "total_m",
    )


def trip_summary(trips: DataFrame) -> DataFrame:
    """One row per trip."""
    return (
        trips.filter(F.col("trip_id").isNotNull())
        .groupBy(DEVICE, "trip_id")
        .agg(
            F.count("*").alias("points"),
            F.min("timestamp").alias("started"),
            F.max("timestamp").alias("ended"),
            (F.max("timestamp") - F.min("timestamp")).alias("duration_s"),
            F.sum("distance_m").alias("distance_m"),
            F.max("position_speed").alias("max_speed"),
            F.max("time_s").alias("longest_gap_s"),
        )
    )


def filter_trips(
    trips: DataFrame,
    min_duration_s: float = 60,
    min_distance_m: float = 100,
    max_gap_s: float = 300,
    settings: Settings = Settings(),
) -> DataFrame:
    """Rows of trips that last long enough, go far enough and have no longer gap."""
    kept = (
        trip_summary(trips)
        .filter(
            (F.col("duration_s") >= min_duration_s)
            & (F.col("distance_m") >= min_distance_m)
            & (F.coalesce("longest_gap_s", F.lit(0.0)) <= max_gap_s)
        )
        .select(DEVICE, "trip_id")
    )
    columns = trips.columns
    return lookup(trips, kept, [DEVICE, "trip_id"], settings, how="inner").select(*columns)


def coverage(trips: DataFrame) -> DataFrame:
    """Totals over the enriched rows, before publishing drops the flags."""
    return trips.agg(
        F.count("*").alias("total_rows"),
        F.count("snapped_lat").alias("located_rows"),
        F.when(F.count("*") > 0, F.count("snapped_lat") / F.count("*") * 100).alias("filled_percent"),
        F.count_if("was_snapped").alias("snapped_rows"),
        F.count_if("trip_break").alias("trip_breaks"),
        F.count("distance_m").alias("valid_distances"),
        (F.count("*") - F.count("snapped_lat")).alias("missing_rows"),
    )
