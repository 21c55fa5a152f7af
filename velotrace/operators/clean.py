"""Row cleaning before road matching.

``within`` names columns, such as region and date, whose slices are handled apart from each other
in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.operators.ordered import Series, ordered, previous, row_count, scan
from velotrace.schemas import DEVICE, NUMERIC_COLUMNS, ROW_ORDER, TIME_ORDER
from velotrace.settings import Settings

LAT, LON = "position_latitude", "position_longitude"


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Read the columns as doubles; text that is no number, and NaN, become null."""
    def number(c: str) -> Column:
        value = F.col(c).try_cast("double")
        return F.when(~F.isnan(value), value)

    return df.withColumns({c: number(c) for c in columns if c in df.columns})


def without_serial(df: DataFrame) -> DataFrame:
    """Rows whose ``device_serial_number`` is null; all rows if there is no such column."""
    if "device_serial_number" not in df.columns:
        return df
    return df.filter(F.col("device_serial_number").isNull())


def can_snap(lat: str = LAT, lon: str = LON) -> Column:
    """Both coordinates known and neither of them zero."""
    return F.coalesce((F.col(lat) != 0) & (F.col(lon) != 0), F.lit(False))


def sort_rows(df: DataFrame, columns: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Global sort on the columns that are present, nulls last.

    The input partition breaks ties, so that copies of a row need not share one task.
    """
    order = [F.col(c).asc_nulls_last() for c in columns if c in df.columns]
    return df.withColumn("_part", F.spark_partition_id()).orderBy(*order, "_part").drop("_part")


def add_trip_columns(df: DataFrame) -> DataFrame:
    """The columns that later steps fill."""
    return df.withColumns(
        {
            "snapped_lat": F.lit(None).cast("double"),
            "snapped_lon": F.lit(None).cast("double"),
            "was_snapped": F.lit(False),
            "distance_m": F.lit(None).cast("double"),
            "time_s": F.lit(None).cast("double"),
            "trip_break": F.lit(False),
        }
    )


def add_time_diff(
    df: DataFrame,
    settings: Settings = Settings(),
    within: Sequence[str] = (),
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Seconds since the device's previous row; 0 for its first row and where unknown."""
    if "timestamp" not in df.columns:
        return df
    return time_diff(ordered(df, [*within, DEVICE], TIME_ORDER, settings, sizes)).done()


def time_diff(series: Series) -> Series:
    """``add_time_diff`` on the rows of each device."""
    series = scan(series, _prev=previous(F.struct(F.col("timestamp").alias("ts"))))
    known = F.when(F.col(DEVICE).isNotNull(), F.col("timestamp") - F.col("_prev.ts"))
    diff = F.coalesce(known, F.lit(0)).cast("double")
    return series.map(lambda d: d.withColumn("time_diff", diff).drop("_prev"))


def blank_repeats(
    df: DataFrame, settings: Settings = Settings(), within: Sequence[str] = ()
) -> DataFrame:
    """Keep a pair of coordinates on its first row in row order and null it on all others.

    The rule spans devices: a place seen by two of them stays on the first only.
    """
    # Rows without any coordinates have nothing to blank and are no group; each input partition
    # keeps its own apart, so they never meet in one task.
    nowhere = F.col(LAT).isNull() & F.col(LON).isNull()
    spread = F.when(nowhere, F.spark_partition_id()).otherwise(-1)
    keys = [*within, LAT, LON, "_spread"]
    sizes = df.filter(~nowhere).withColumn("_spread", F.lit(-1)).groupBy(*keys).count()
    series = ordered(df.withColumn("_spread", spread), keys, ROW_ORDER, settings, sizes)
    first = F.col("_nth") == 1
    return (
        scan(series, _nth=row_count())
        .done()
        .withColumns({c: F.when(first, F.col(c)) for c in (LAT, LON)})
        .drop("_nth", "_spread")
    )


def preprocess(
    df: DataFrame, settings: Settings = Settings(), within: Sequence[str] = ()
) -> DataFrame:
    """Filter, coerce, and add the columns that later steps fill."""
    return add_time_diff(add_trip_columns(coerce_numeric(without_serial(df))), settings, within)
