"""What the operators share: the word rule, reading of tables, and job-sized partition counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# A word is a run of anything but the blank and the control characters from tab to return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def word_count(text: Column) -> Column:
    """Words in the text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_totals(rows: DataFrame, order: list[str], size: str, name: str, group: int = 4096) -> DataFrame:
    """For each row the sum of ``size`` over the rows before it, where the first column of
    ``order`` is a number that counts up without large gaps.

    Rows are summed in groups of that number, and the groups' sums are carried, so that no task
    sees more than one group, or one row per group.
    """
    inside = Window.partitionBy("_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    grouped = rows.select(*order, size, F.floor(F.col(order[0]) / group).alias("_group"))
    totals = grouped.groupBy("_group").agg(F.sum(size).alias("_total"))
    carried = totals.select("_group", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_carry"))
    return grouped.withColumn("_before", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(
        carried, "_group"
    ).select(*order, (F.col("_before") + F.col("_carry")).cast("long").alias(name))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, with ``name`` in it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(rows: DataFrame, change, schema: StructType) -> DataFrame:
    """``rows.mapInArrow(change, schema)`` for column names of any kind, such as those with dots."""
    names, outer = rows.columns, schema.names
    plain = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in change(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(plain.names)

    numbered = rows.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.mapInArrow(renamed, plain).toDF(*outer)
