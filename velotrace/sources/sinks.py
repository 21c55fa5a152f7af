"""Partitioned sinks, and checks of what they wrote."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.operators.joins import joined
from velotrace.operators.manifest import pending_rows
from velotrace.settings import Settings
from velotrace.sources.tables import CSV


def write_slices(
    df: DataFrame,
    root: str,
    by: Sequence[str] = ("region", "date"),
    kind: str = "parquet",
) -> None:
    """Write one folder per slice, replacing only the slices that ``df`` holds.

    Rows are gathered per slice first, and large slices split over several files.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV)
        .partitionBy(*by)
        .format(kind)
        .save(root)
    )


def write_pending(
    df: DataFrame, root: str, done: DataFrame, force: bool = False, settings: Settings = Settings()
) -> None:
    """Write the slices that are not in ``done``, or all of them if forced."""
    write_slices(df if force else pending_rows(df, done, settings), root)


def write_days(df: DataFrame, root: str, day: Column | str = "date", kind: str = "csv") -> None:
    """Write ``year=YYYY/month=MM/day=DD`` folders, zero-padded."""
    day = F.col(day) if isinstance(day, str) else day
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = df.withColumns({name: F.date_format(day, form) for name, form in parts.items()})
    write_slices(dated, root, list(parts), kind)


def write_day(df: DataFrame, root: str, day: date, kind: str = "parquet") -> None:
    """Write one day's folder, with its columns even if there are no rows."""
    folder = f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"
    df.write.mode("overwrite").options(**CSV).format(kind).save(folder)


def compare_written(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Row and null counts per column of a table and its stored copy; ``same`` if they agree."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        pairs = [
            F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`")).alias(name))
            for c in df.columns
        ]
        rows = F.struct(F.lit("*").alias("column"), F.count("*").alias(name))
        return df.agg(F.array(rows, *pairs).alias("x")).select(F.inline("x"))

    # One row per column of the table.
    return joined(counts(expected, "expected"), F.broadcast(counts(stored, "stored")), ["column"], "left").withColumn(
        "same", F.col("expected").eqNullSafe(F.col("stored"))
    )


def stored_report(listing: DataFrame) -> DataFrame:
    """File count, total bytes and the first three names of a listing."""
    first = listing.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    names = first.orderBy("name").limit(3).agg(F.sort_array(F.collect_list("name")).alias("names"))
    row = names.first()
    return listing.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.array(*[F.lit(n) for n in row["names"]]).cast("array<string>").alias("first_names"),
    )


def sample_lines(spark: SparkSession, path: str, lines: int = 3) -> DataFrame:
    return spark.read.text(path).limit(lines)
