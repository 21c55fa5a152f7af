"""JSON messages: one flat object per file, in folders named after the day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotrace.functions.dates import day_of_path
from velotrace.functions.values import as_type
from velotrace.schemas import CORRUPT, MESSAGE_FIELDS

# Values are read as text and cast afterwards, so that one odd value costs only itself.
TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name, _ in MESSAGE_FIELDS]
    + [T.StructField(CORRUPT, T.StringType())]
)
FILES = {"wholetext": True, "pathGlobFilter": "*.json", "recursiveFileLookup": True}
DECODE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def decoded(files: DataFrame, extra_fields: Sequence[str] = ()) -> DataFrame:
    """Messages from whole files in ``value``; text that is no object is kept in ``_corrupt``."""
    extra = [T.StructField(name, T.StringType()) for name in extra_fields]
    parsed = files.select(
        "value",
        F.from_json("value", T.StructType(TEXT_SCHEMA.fields + extra), DECODE).alias("_m"),
        F.col("_metadata.file_path").alias("source_file"),
    )
    whole = F.when(F.col("_m").isNull(), F.col("value")).otherwise(F.col("_m")[CORRUPT])
    return parsed.select(
        *[F.col("_m").getField(name).alias(name) for name in [n for n, _ in MESSAGE_FIELDS] + list(extra_fields)],
        whole.alias(CORRUPT),
        "source_file",
    )


def read_messages(
    spark: SparkSession, root: str, day: date | None = None, extra_fields: Sequence[str] = ()
) -> DataFrame:
    """Messages below a folder with their ``source_file``, of one day if given.

    A file outside a folder of at least year, month and day is kept whatever the day.
    """
    messages = decoded(spark.read.options(**FILES).text(root), extra_fields)
    if day is None:
        return messages
    return messages.filter(on_day(F.col("source_file"), root, day))


def on_day(path: Column, root: str, day: date) -> Column:
    """Whether a file belongs to a day's run, by its path below the root."""
    inner = F.regexp_replace(path, "^.*" + _escaped(root.rstrip("/")) + "/", "")
    shallow = F.size(F.split(inner, "/")) < 4
    return shallow | F.coalesce(day_of_path(path) == F.lit(day), F.lit(False))


def _escaped(text: str) -> str:
    return "\\Q" + text + "\\E"


def to_telemetry(
    messages: DataFrame, date_policy: str = "path", extra_fields: Sequence[str] = ()
) -> DataFrame:
    """The 22 telemetry columns and ``date``; missing keys are null, other keys dropped.

    ``extra_fields`` that the messages were read with, such as accelerometer channels, follow as
    numbers under their own names.

    ``date`` is the day in the path, or today for ``date_policy="now"`` and for paths without a
    day. Undecodable files are left out.
    """
    today = F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
    day = today if date_policy == "now" else F.coalesce(day_of_path(F.col("source_file")), today)
    return messages.filter(F.col(CORRUPT).isNull()).select(
        *[
            as_type(F.col(f"`{name}`"), kind).alias(name.replace(".", "_"))
            for name, kind in MESSAGE_FIELDS
        ],
        *[as_type(F.col(f"`{name}`"), T.DoubleType()).alias(name) for name in extra_fields],
        day.alias("date"),
    )


def rejected(messages: DataFrame) -> DataFrame:
    """Files that could not be decoded, with all columns."""
    return messages.filter(F.col(CORRUPT).isNotNull())


def conversion_totals(messages: DataFrame) -> DataFrame:
    """Messages read, undecodable ones, and decoded ones with a timestamp."""
    return messages.agg(
        F.count("source_file").alias("files"),
        F.count(CORRUPT).alias("failed"),
        F.count("timestamp").alias("timestamped"),
    )
