"""Abnormal driving events from accelerometer peaks.

A peak is an event if it exceeds its axis's percentile, dominates both other axes and is far from
the median in units of the median absolute deviation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.operators.joins import lookup
from velotrace.operators.ordered import ordered, row_count, scan
from velotrace.operators.quantiles import approximate_quantiles, quantiles
from velotrace.schemas import ACCEL_CHANNELS, EVENT_SCHEMA, ROW_ORDER
from velotrace.session import written
from velotrace.settings import SEVERITY_LABELS, Settings

# The event type of each axis.
AXIS_EVENTS = {"x": "hard_brake", "y": "swerve", "z": "pothole"}
AXES = tuple(AXIS_EVENTS)


def missing_channels(df: DataFrame) -> list[str]:
    """Accelerometer channels that are present under neither of their names."""
    return [
        raw for raw, name in ACCEL_CHANNELS.items() if raw not in df.columns and name not in df.columns
    ]


def rename_channels(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({raw: n for raw, n in ACCEL_CHANNELS.items() if raw in df.columns})


def has_position(lat: str = "position_latitude", lon: str = "position_longitude") -> Column:
    """A known position other than (0, 0)."""
    return (
        F.col(lat).isNotNull() & F.col(lon).isNotNull() & ((F.col(lat) != 0) | (F.col(lon) != 0))
    )


def is_active() -> Column:
    """Any peak above zero."""
    return reduce(
        lambda a, b: a | b, [F.coalesce(F.col(f"peak_{a}") > 0, F.lit(False)) for a in AXES]
    )


def active_rows(df: DataFrame) -> DataFrame:
    """Rows that can hold an event, with channels renamed and NaN peaks as null."""
    renamed = rename_channels(df)
    peaks = {
        f"peak_{a}": F.when(~F.isnan(F.col(f"peak_{a}").cast("double")), F.col(f"peak_{a}").cast("double"))
        for a in AXES
    }
    return renamed.filter(has_position()).withColumns(peaks).filter(is_active())


def axis_statistics(
    active: DataFrame,
    settings: Settings = Settings(),
    by: Sequence[str] = (),
    null_policy: str = "ignore",
    accuracy: int | None = None,
) -> DataFrame:
    """One row per group: ``n`` and each axis's threshold, maximum, median and MAD.

    With ``null_policy="reference"`` an axis with any missing peak gets no threshold. Quantiles
    are exact unless an ``accuracy`` is given.
    """
    by = list(by)

    def find(df, probs, extra=()):
        if accuracy is None:
            return quantiles(df, peaks, probs, by, settings, extra)
        return approximate_quantiles(df, peaks, probs, by, accuracy, extra)

    peaks = [f"peak_{a}" for a in AXES]
    values = written(active.select(*by, *peaks), "peak-values")
    sizes = [F.count("*").alias("n")] + [
        x for p in peaks for x in (F.max(p).alias(f"{p}_max"), F.count(p).alias(f"{p}_known"))
    ]
    middle = settle(
        find(values, {"threshold": settings.quantile / 100, "median": 0.5}, sizes),
        by,
    )
    away = attach(values, middle, by, settings).select(
        *by, *[F.abs(F.col(p) - F.col(f"{p}_median")).alias(p) for p in peaks]
    )
    both = attach(find(away, {"mad": 0.5}), middle, by, settings)
    threshold = {
        a: F.when(F.col(f"peak_{a}_known") == F.col("n"), F.col(f"peak_{a}_threshold"))
        if null_policy == "reference"
        else F.col(f"peak_{a}_threshold")
        for a in AXES
    }
    return both.select(
        *by,
        "n",
        *[
            x
            for a in AXES
            for x in (
                threshold[a].alias(f"threshold_{a}"),
                F.col(f"peak_{a}_max").alias(f"max_{a}"),
                F.col(f"peak_{a}_median").alias(f"median_{a}"),
                F.col(f"peak_{a}_mad").alias(f"mad_{a}"),
            )
        ],
    )


def settle(table: DataFrame, by: Sequence[str]) -> DataFrame | dict[str, Column]:
    """Compute a table of statistics once: per group as a written table, else as literals."""
    if by:
        return written(table, "group-statistics")
    row = table.first()
    return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in table.schema.fields}


def attach(
    df: DataFrame,
    stats: DataFrame | dict[str, Column],
    by: Sequence[str],
    settings: Settings = Settings(),
) -> DataFrame:
    """Rows with the statistics of their group."""
    if isinstance(stats, dict):
        return df.withColumns(stats)
    return lookup(df, stats, by, settings, how="inner")


def dominates(axis: str, factor: float | Column) -> Column:
    """The axis's peak exceeds ``factor`` times each other peak; unknown peaks count as false."""
    others = [a for a in AXES if a != axis]
    return reduce(
        lambda x, y: x & y,
        [
            F.coalesce(F.col(f"peak_{axis}") > F.col(f"peak_{a}") * factor, F.lit(False))
            for a in others
        ],
    )


def is_far(value: Column, median: Column, mad: Column, limit: float | Column) -> Column:
    """More than ``limit`` MADs from the median; never if the MAD is zero."""
    return F.when(mad > 0, F.abs(value - median) / mad > limit).otherwise(False)


def severity(peak: Column, threshold: Column, highest: Column) -> Column:
    """1 up to the threshold, then 2 to 10 in proportion to the way to the highest peak."""
    ratio = F.when(highest > threshold, (peak - threshold) / (highest - threshold)).otherwise(0.0)
    score = (F.lit(2) + ratio * 8).cast("int")
    return F.when(peak <= threshold, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(10), score))
    )


def severity_label(event_type: Column, score: Column) -> Column:
    """The named band of a severity."""
    label = F.lit(None).cast("string")
    for name, bands in SEVERITY_LABELS.items():
        band = F.lit(None).cast("string")
        for top, text in reversed(bands):
            band = F.when(score <= top, F.lit(text)).otherwise(band)
        label = F.when(event_type == name, band).otherwise(label)
    return label


def axis_hit(
    axis: str, dominance: float | Column, mad_limit: float | Column, min_rows: int
) -> Column:
    """The event rule of one axis, on rows that carry their statistics."""
    peak = F.col(f"peak_{axis}")
    return (
        F.coalesce(peak > F.col(f"threshold_{axis}"), F.lit(False))
        & dominates(axis, dominance)
        & is_far(peak, F.col(f"median_{axis}"), F.col(f"mad_{axis}"), mad_limit)
        & (F.col("n") >= min_rows)
    )


def explode_hits(
    rows: DataFrame,
    settings: Settings = Settings(),
    dominance: Column | None = None,
    mad_limit: Column | None = None,
) -> DataFrame:
    """One row per event, with ``event_type``, ``severity`` and ``peak_value`` added.

    The two parameters may be given as columns instead of settings.
    """
    rules = {
        a: axis_hit(
            a,
            settings.dominance if dominance is None else dominance,
            settings.mad_limit if mad_limit is None else mad_limit,
            settings.min_active_rows,
        )
        for a in AXES
    }
    hits = F.array(
        *[
            F.when(
                rules[a],
                F.struct(
                    F.lit(AXIS_EVENTS[a]).alias("event_type"),
                    severity(
                        F.col(f"peak_{a}"), F.col(f"threshold_{a}"), F.col(f"max_{a}")
                    ).alias("severity"),
                    F.col(f"peak_{a}").alias("peak_value"),
                ),
            )
            for a in AXES
        ]
    )
    return (
        rows.filter(reduce(lambda a, b: a | b, rules.values()))
        .withColumn("_hit", F.explode(F.filter(hits, lambda h: h.isNotNull())))
        .select("*", "_hit.*")
        .drop("_hit")
    )


def abnormal_events(
    df: DataFrame,
    settings: Settings = Settings(),
    by: Sequence[str] = (),
    null_policy: str = "ignore",
    order: Sequence[str] = ROW_ORDER,
) -> DataFrame:
    """The events of a trips table, with the nine event columns (and ``by``, if grouped).

    Statistics are taken over the whole table, or per group of ``by``. A table without
    accelerometer channels has no events. The active rows are written once, since the
    statistics read them several times.
    """
    extra = [c for c in by if c not in EVENT_SCHEMA.names]
    if missing_channels(df):
        empty = df.limit(0).select(*extra, *[F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA])
        return empty.select(*EVENT_SCHEMA.names, *extra)

    rows = active_rows(df)
    peaks = [f"peak_{a}" for a in AXES]
    wanted = ["timestamp", "device_id", "trip_id", "position_latitude", "position_longitude"]
    kept = dict.fromkeys(
        c for c in [*by, *wanted, *order, *peaks] if c in rows.columns
    )
    active = written(rows.select(*kept), "active-rows")
    stats = settle(axis_statistics(active, settings, by, null_policy), by)
    numbered = scan(ordered(active, [], order, settings), _place=row_count()).done()
    events = explode_hits(attach(numbered, stats, by, settings), settings)

    source = {"latitude": "position_latitude", "longitude": "position_longitude"}
    columns = []
    for f in EVENT_SCHEMA:
        name = source.get(f.name, f.name)
        if f.name == "original_index":
            column = F.col("_place") - 1
        elif name in events.columns:
            column = F.col(name)
        else:
            column = F.lit(None)
        columns.append(column.cast(f.dataType).alias(f.name))
    return events.select(*columns, *extra)


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def events_by_severity(events: DataFrame) -> DataFrame:
    """Counts under ``severity_N``, in text order."""
    return (
        events.groupBy(F.concat(F.lit("severity_"), F.col("severity")).alias("severity_key"))
        .agg(F.count("*").alias("events"))
        .orderBy("severity_key")
    )


def event_rollup(events: DataFrame, levels: Sequence[str] = ("region", "event_type", "severity")) -> DataFrame:
    """Events counted over ``levels`` and each of their beginnings, up to the total.

    ``depth`` tells how many levels a row is about, so that a null region and the total differ. The
    finest counts are made first, and only they are repeated for the subtotals.
    """
    levels = list(levels)
    finest = events.groupBy(*levels).agg(F.count("*").alias("events"), F.max("peak_value").alias("highest_peak"))
    totals = finest.rollup(*levels).agg(
        F.sum("events").alias("events"), F.max("highest_peak").alias("highest_peak"), F.grouping_id().alias("_id")
    )
    # Bits of the levels that a row sums over; they are the last ones.
    depth = F.lit(len(levels)) - F.bit_count("_id")
    return totals.select(*levels, depth.cast("int").alias("depth"), "events", "highest_peak")


def events_by_file(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Detection per source file in one job: event counts of every file, zero included.

    ``df`` carries the file in ``source_file``. Its rows are written once, since opening many
    small files costs more than their rows.
    """
    df = written(df, "file-rows")
    events = abnormal_events(df, settings, by=["source_file"])
    found = events.groupBy("source_file").agg(F.count("*").alias("events_detected"))
    files = df.select("source_file").distinct()
    return files.join(found, "source_file", "left").select(
        "source_file", F.coalesce("events_detected", F.lit(0)).alias("events_detected")
    )
