"""Reads of damaged, dated and per-device files over the driver's tables, with SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.checks import event_queries
from velotrace.checks.event_queries import trips_with_accel
from velotrace.checks.telemetry_queries import REGION_CASE, with_day
from velotrace.checks.views import duck, telemetry
from velotrace.operators import events, regions
from velotrace.schemas import ACCEL_CHANNELS
from velotrace.session import new_path
from velotrace.sources import quarantine, sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


# ---- quarantine -----------------------------------------------------------------------------

CUT_COPY_OF = "wales"


def damaged_folders(spark: SparkSession, d: str, kind: str) -> str:
    """The telemetry in one folder per region, and beside them two folders with bad files: one with
    copies of a region's files that are cut off, and one without rows."""
    path = new_path(spark, f"damaged-{kind}")
    rows = regions.region_rows(telemetry(spark, d))
    sinks.write_slices(rows, path, ["region"], kind)
    content = F.col("content").cast("string")
    if kind == "csv":
        # A row without its last field ends the copy.
        cut = F.regexp_replace(content, ",[^,]*$", "")
    else:
        cut = F.expr("substring(content, 1, length div 2)").cast("string")
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/region={CUT_COPY_OF}")
    whole.select(cut.alias("value")).write.text(f"{path}/region=cut")
    rows.limit(0).drop("region").coalesce(1).write.option("header", True).format(kind).save(f"{path}/region=none")
    return path


def _region(path: str) -> Column:
    return F.regexp_extract(path, "/region=([^/]*)/", 1)


def _good(spark: SparkSession, d: str, kind: str) -> quarantine.Tried:
    return quarantine.read_good(spark, damaged_folders(spark, d, kind), kind, "part-*")


KINDS = "(SELECT unnest(['csv', 'parquet']) AS kind)"


@query(
    "united_files",
    duck(f"""SELECT kind, region, count(*) AS rows, CAST(sum(record_seqnum) AS BIGINT) AS total,
      round(sum(position_speed), 3) AS speed FROM
      (SELECT *, {REGION_CASE} AS region FROM telemetry), {KINDS} WHERE region IS NOT NULL GROUP BY ALL"""),
)
def united_files(spark, d):
    """The rows of all files that can be read; files that cannot be read add none."""
    parts = [
        _good(spark, d, kind).rows.groupBy(F.lit(kind).alias("kind"), _region("source_file").alias("region")).agg(
            F.count("*").alias("rows"),
            F.sum("record_seqnum").cast("long").alias("total"),
            F.round(F.sum("position_speed"), 3).alias("speed"),
        )
        for kind in ("csv", "parquet")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "quarantined_files",
    duck(f"""SELECT DISTINCT kind, region, 'ok' AS state FROM
      (SELECT {REGION_CASE} AS region FROM telemetry), {KINDS} WHERE region IS NOT NULL
      UNION ALL SELECT kind, 'cut', 'unreadable' FROM {KINDS} UNION ALL SELECT kind, 'none', 'empty' FROM {KINDS}"""),
)
def quarantined_files(spark, d):
    """The state of the files of each folder."""
    parts = [
        quarantine.tried_files(spark, [damaged_folders(spark, d, kind)], kind, "part-*").select(
            F.lit(kind).alias("kind"), _region("path").alias("region"), "state"
        )
        for kind in ("csv", "parquet")
    ]
    return parts[0].unionByName(parts[1]).distinct()


# ---- raw channels, files per device, days ---------------------------------------------------


@query("abnormal_events_of_raw_channels", event_queries.SQL["abnormal_events"])
def abnormal_events_of_raw_channels(spark, d):
    """Detection on rows whose channels still have the device's names."""
    raw = {name: channel for channel, name in ACCEL_CHANNELS.items()}
    return events.abnormal_events(trips_with_accel(spark, d).withColumnsRenamed(raw))


DEVICE_FOLDERS = 256


@query("events_of_device_files", event_queries.SQL["events_by_file"])
def events_of_device_files(spark, d):
    """Detection per stored file, of which there is one for each device."""
    path = new_path(spark, "device-files")
    rows = trips_with_accel(spark, d)
    # A folder of folders is written by one task, moved at once, and listed by one task.
    folder = F.pmod(F.xxhash64("device_id"), F.lit(DEVICE_FOLDERS))
    kept = rows.withColumns({"folder": folder, "of": F.col("device_id")})
    kept.repartition("folder").write.partitionBy("folder", "of").parquet(path)
    reader = spark.read.schema(rows.schema).option("recursiveFileLookup", True)
    stored = reader.parquet(path).withColumn("source_file", F.col("_metadata.file_path"))
    device = F.regexp_extract("source_file", "/of=([^/]*)/", 1)
    found = events.events_by_file(stored)
    return found.select(F.concat(F.lit("device-"), device).alias("source_file"), "events_detected")


@query(
    "stored_days",
    duck("""SELECT strftime(day, '%Y-%m-%d') AS date, count(*) AS rows, CAST(sum(record_seqnum) AS BIGINT) AS total,
      count(device_name) AS named, round(sum(position_speed), 3) AS speed FROM
      (SELECT *, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day FROM telemetry) GROUP BY ALL"""),
)
def stored_days(spark, d):
    """The telemetry in dated CSV folders, each read back on its own."""
    path = new_path(spark, "stored-days")
    sinks.write_days(with_day(telemetry(spark, d)), path)
    found = []
    # One entry per day there is.
    for day in tables.days_in(spark, path):
        rows = tables.read_day_folder(spark, path, day, "csv")
        found.append(
            rows.agg(
                F.lit(str(day)).alias("date"),
                F.count("*").alias("rows"),
                F.sum("record_seqnum").cast("long").alias("total"),
                F.count("device_name").alias("named"),
                F.round(F.sum("position_speed"), 3).alias("speed"),
            )
        )
    return reduce(DataFrame.unionByName, found)
