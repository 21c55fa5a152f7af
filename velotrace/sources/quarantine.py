"""Reads that set aside the files that cannot be read, instead of failing or passing over them.

Every file is first read on its own, whole, in the tasks. A file is ``ok``; ``empty``, if it holds
no rows; or ``unreadable``: CSV that is not UTF-8, has a row of another length than its header or
ends within quotes, and Parquet whose footer or any page does not decode. Only files that are ok
are then read by Spark and united by column name; the others are reported with the reason.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.csv as arrow_csv
import pyarrow.parquet as arrow_parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.session import written
from velotrace.sources.tables import CSV, exists, typed

TRIED_SCHEMA = "path string, bytes long, rows long, columns array<string>, state string, reason string"
OK, EMPTY, UNREADABLE = "ok", "empty", "unreadable"


@dataclass(frozen=True)
class Tried:
    """The rows of all good files, and one row per file with its state."""

    rows: DataFrame | None
    files: DataFrame

    @property
    def rejects(self) -> DataFrame:
        return self.files.filter(F.col("state") != OK).select("path", "bytes", "state", "reason")


def _csv(content: bytes) -> tuple[int, list[str]]:
    """Rows and columns of a CSV file, all of whose rows are parsed."""
    options = {
        "read_options": arrow_csv.ReadOptions(use_threads=False),
        "parse_options": arrow_csv.ParseOptions(newlines_in_values=True),
    }
    names = arrow_csv.open_csv(pa.BufferReader(content), **options).schema.names
    # Any text is a value; only the shape of the rows and their encoding matter here.
    texts = arrow_csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()))
    table = arrow_csv.read_csv(pa.BufferReader(content), convert_options=texts, **options)
    if content.count(b'"') % 2:
        raise pa.ArrowInvalid("the file ends within quotes")
    return table.num_rows, table.column_names


def _parquet(content: bytes) -> tuple[int, list[str]]:
    file = arrow_parquet.ParquetFile(pa.BufferReader(content))
    rows = sum(batch.num_rows for batch in file.iter_batches(use_threads=False))
    return rows, file.schema_arrow.names


READERS: dict[str, Callable[[bytes], tuple[int, list[str]]]] = {"csv": _csv, "parquet": _parquet}


def try_content(kind: str, content: bytes) -> tuple[int, list[str], str, str | None]:
    """rows, columns, state and reason of a file's content."""
    if not content.strip():
        return 0, [], EMPTY, "no content"
    try:
        rows, columns = READERS[kind](content)
    except (pa.ArrowException, OSError, UnicodeDecodeError, ValueError) as problem:
        return 0, [], UNREADABLE, str(problem).splitlines()[0][:300]
    return (rows, columns, OK, None) if rows else (0, columns, EMPTY, "no rows")


def tried_files(spark: SparkSession, roots: Sequence[str], kind: str, pattern: str | None = None) -> DataFrame:
    """Every file below the folders with its state; written once. See ``TRIED_SCHEMA``.

    A file is held by one task while it is tried.
    """
    roots = [r for r in roots if exists(spark, r)]
    if not roots:
        return spark.createDataFrame([], TRIED_SCHEMA)
    # A file whose bytes the storage cannot give is missed by the scan, and found by the listing.
    files = spark.read.format("binaryFile").options(
        pathGlobFilter=pattern or f"*.{kind}", recursiveFileLookup=True, ignoreCorruptFiles=True
    ).load(list(roots))

    def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [try_content(kind, c.as_buffer().to_pybytes()) for c in batch.column(2)]
            rows, columns, state, reason = (list(x) for x in zip(*found)) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(rows, pa.int64()),
                    pa.array(columns, pa.list_(pa.string())), pa.array(state, pa.string()), pa.array(reason, pa.string()),
                ],
                ["path", "bytes", "rows", "columns", "state", "reason"],
            )

    tried = files.select("path", F.col("length").alias("bytes"), "content").mapInArrow(attempt, TRIED_SCHEMA)
    tried = written(tried, "tried-files")
    # A scan also passes over files of no bytes.
    names = spark.createDataFrame([(_plain(p),) for p in files.inputFiles()], "path string")
    plain = F.regexp_replace("path", "^file:/+", "file:/").alias("path")
    sizes = files.select(plain, F.col("length").alias("bytes"))
    missed = names.join(tried.select(plain), "path", "left_anti").join(sizes, "path", "left")
    some = F.col("bytes") > 0
    missed = missed.select(
        "path", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.lit(0).cast("long").alias("rows"),
        F.array().cast("array<string>").alias("columns"), F.when(some, UNREADABLE).otherwise(EMPTY).alias("state"),
        F.when(some, "the storage cannot read it").otherwise("no content").alias("reason"),
    )
    return written(tried.unionByName(missed), "listed-files")


def _plain(address: str) -> str:
    return re.sub("^file:/+", "file:/", unquote(address))


def read_good(spark: SparkSession, roots: Sequence[str] | str, kind: str, pattern: str | None = None) -> Tried:
    """The rows of the files that can be read, united by column name, and the state of each file.

    Known telemetry columns take their types. ``rows`` carry their ``source_file``, and is None if
    no file is good. Files with the same header are one read, so jobs grow with the different
    headers and not with the files.
    """
    files = tried_files(spark, [roots] if isinstance(roots, str) else list(roots), kind, pattern)
    # Paths only, as Spark's own listing holds them on the driver too.
    groups = files.filter(F.col("state") == OK).groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    tables = []
    for row in groups.orderBy("columns").collect():
        if kind == "csv":
            table = spark.read.options(multiLine=True, **CSV).csv(row["paths"])
        else:
            table = spark.read.option("mergeSchema", True).parquet(*row["paths"])
        kept = [F.col(f"`{c}`") for c in table.columns]
        table = table.select(*kept, F.col("_metadata.file_path").alias("source_file"))
        tables.append(typed(table) if kind == "csv" else table)
    rows = None
    for table in tables:
        rows = table if rows is None else rows.unionByName(table, allowMissingColumns=True)
    return Tried(rows, files)
