"""Tables in dated folders, and listings of the files in them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotrace.functions.values import as_type
from velotrace.operators.publish import union_by_position
from velotrace.schemas import ACCEL_CHANNELS, TELEMETRY_SCHEMA

KNOWN_TYPES = {f.name: f.dataType for f in TELEMETRY_SCHEMA} | {
    "snapped_lat": T.DoubleType(),
    "snapped_lon": T.DoubleType(),
    "was_snapped": T.BooleanType(),
    "distance_m": T.DoubleType(),
    "time_s": T.DoubleType(),
    "trip_break": T.BooleanType(),
    "time_diff": T.DoubleType(),
    **{raw: T.DoubleType() for raw in ACCEL_CHANNELS},
}

# CSV as most programs write it: a quote within quotes is doubled, and blanks are part of a value.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def typed(df: DataFrame) -> DataFrame:
    """Known columns in their types, text that does not fit as null; other columns unchanged."""
    return df.select(
        *[
            as_type(F.col(f"`{c}`"), KNOWN_TYPES[c]).alias(c) if c in KNOWN_TYPES else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def read_csv(spark: SparkSession, paths: str | Sequence[str], by_position: bool = False) -> DataFrame:
    """CSV files with headers, read as text and then typed.

    Files of one read share the first file's header. ``by_position=False`` reads each path on
    its own and unites them by name, with null for columns that a path lacks.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(pathGlobFilter="*.csv", recursiveFileLookup=True, **CSV)
    tables = [typed(reader.csv(p)) for p in paths]
    if by_position:
        return union_by_position(tables)
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def read_csv_day(spark: SparkSession, root: str, day: date) -> DataFrame:
    """All CSV files below ``root/YYYY/MM/DD``."""
    return read_csv(spark, f"{root.rstrip('/')}/{day:%Y/%m/%d}")


def read_slices(
    spark: SparkSession,
    root: str,
    region: str | None = None,
    day: date | None = None,
    schema: T.StructType | None = None,
    required: bool = False,
) -> DataFrame:
    """A table in ``region=``/``date=`` folders; only the folders asked for are listed and read.

    Columns are those of all files read, with null where a file lacks one. Without a ``schema`` a
    root that does not exist is an error; with one, it gives an empty table. Slices that do not
    exist give no rows, or are an error if they are ``required``.
    """
    root = root.rstrip("/")
    asked = f"{root}/region={'*' if region is None else region}/date={'*' if day is None else day}"
    if required and not exists(spark, asked):
        raise FileNotFoundError(f"no slice {asked}")
    if schema is not None and not exists(spark, root):
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    path = root
    if region is not None or day is not None:
        path = asked if exists(spark, asked) else root
    df = reader.parquet(path)
    if region is not None:
        df = df.filter(F.col("region") == region)
    if day is not None:
        df = df.filter(F.col("date") == F.lit(day))
    return df


def read_listed(spark: SparkSession, root: str, slices: Sequence[tuple[str, date]]) -> DataFrame:
    """The given (region, day) slices, with the columns of all of them."""
    root = root.rstrip("/")
    paths = [f"{root}/region={region}/date={day}" for region, day in slices]
    return spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths)


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches, in whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_day_folder(spark: SparkSession, root: str, day: date, kind: str = "parquet") -> DataFrame:
    """One day of a table in ``year=``/``month=``/``day=`` folders, such as published trips.

    A missing day is an error that names the days there are.
    """
    folder = f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"
    if not exists(spark, folder):
        raise FileNotFoundError(f"no {day} below {root}; there are {', '.join(map(str, days_in(spark, root))) or 'no days'}")
    if kind == "csv":
        return read_csv(spark, folder)
    return spark.read.option("mergeSchema", True).format(kind).load(folder)


def days_in(spark: SparkSession, root: str) -> list[date]:
    """The days of ``year=``/``month=``/``day=`` folders, in order; one entry per day.

    Folders of rows without a day are no days.
    """
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/year=*/month=*/day=*")
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    parts = [str(s.getPath()).rsplit("/", 3)[1:] for s in found or []]
    named = ([p.split("=")[1] for p in day] for day in parts)
    return sorted(date(*map(int, day)) for day in named if all(x.isdigit() for x in day))


def list_files(
    spark: SparkSession, root: str, pattern: str = "*", max_files: int | None = None
) -> DataFrame:
    """``path, bytes, modified`` of the files below a folder; their content is not read.

    A folder that does not exist has none; one that cannot be listed is an error.
    """
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, bytes long, modified timestamp")
    files = spark.read.format("binaryFile").options(
        pathGlobFilter=pattern, recursiveFileLookup=True
    ).load(root)
    listed = files.select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    return listed if max_files is None else listed.orderBy("path").limit(max_files)
