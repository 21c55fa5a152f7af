"""Which slices exist at each stage, and what is still to be done.

A manifest has the columns ``stage, region, date, path, bytes``. Slices are days of a region, so
it stays small beside the data it describes.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.functions.dates import day_of_path, parse_day
from velotrace.operators.joins import fits
from velotrace.session import written
from velotrace.settings import Settings


def manifest(listing: DataFrame, stage: str) -> DataFrame:
    """Slices from a listing with ``region=`` and ``date=`` folders."""
    return listing.select(
        F.lit(stage).alias("stage"),
        F.nullif(F.regexp_extract("path", r"region=([^/]+)/", 1), F.lit("")).alias("region"),
        parse_day(F.regexp_extract("path", r"date=([^/]+)/", 1)).alias("date"),
        "path",
        F.col("bytes"),
    )


def unprocessed_slices(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input slices without an output slice."""
    done = outputs.select("region", "date").distinct()
    return inputs.select("region", "date").distinct().join(done, ["region", "date"], "left_anti")


def unprocessed_days(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Days on which any region has input but no output."""
    return unprocessed_slices(inputs, outputs).select("date").distinct().orderBy("date")


def processable_days(outputs: DataFrame) -> DataFrame:
    return outputs.select("date").distinct().orderBy("date")


def latest_days(slices: DataFrame, days: int = 5) -> DataFrame:
    return slices.select("date").distinct().orderBy(F.col("date").desc()).limit(days)


def pending_rows(
    df: DataFrame, done: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Rows of slices that are not done yet."""
    finished = written(done.select("region", "date").distinct(), "finished-slices")
    if fits(finished, settings.broadcast_rows):
        finished = F.broadcast(finished)
    return df.join(finished, ["region", "date"], "left_anti")


def expired_slices(slices: DataFrame, as_of: datetime | date, retention_days: int) -> DataFrame:
    """Slices older than the retention; deletes nothing.

    An ``as_of`` with a time of day already expires the slice of exactly that many days ago.
    """
    cutoff = as_of - timedelta(days=retention_days)
    if isinstance(cutoff, datetime):
        last = cutoff.date() if cutoff.time() > datetime.min.time() else cutoff.date() - timedelta(days=1)
    else:
        last = cutoff - timedelta(days=1)
    return slices.filter(F.col("date") <= F.lit(last))


def days_present(listing: DataFrame) -> DataFrame:
    """Days found in the paths of a listing."""
    day = day_of_path(F.col("path"))
    return listing.select(day.alias("date")).filter("date is not null").distinct().orderBy("date")


def listing_totals(listing: DataFrame) -> DataFrame:
    return listing.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def file_day(name: str = "name"):
    """The day in a published file name, or null.

    The names are YYYYMMDD, combined_YYYYMMDD, combined_trips_YYYYMMDD and
    YYYYMMDD_abnormal_events.
    """
    shape = r"^(?:combined_|combined_trips_)?([0-9]{8})$|^([0-9]{8})_abnormal_events$"
    text = F.concat(F.regexp_extract(name, shape, 1), F.regexp_extract(name, shape, 2))
    return parse_day(text)
