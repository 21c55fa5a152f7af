"""A sink that writes a stream into region and day slices, each batch exactly once.

A batch writes its rows into folders of their own, ``region=/date=/batch=``, and replaces only
those, so a batch that failed half way and is run again leaves the same files. Reading a slice reads
the batches of one folder; late files of a day add a batch to that day and touch no other.
``settle_days`` later writes chosen days as one.

Rows behind the watermark, the latest time of all earlier batches less the allowed delay, are kept,
and counted beside the slices: a day that has already been used downstream is then known to have
changed. The marks of earlier batches do not change, so a repeated batch counts the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.operators.regions import region_rows
from velotrace.sources.sinks import write_slices
from velotrace.sources.tables import exists, read_slices

BATCH = "batch"
MARK_SCHEMA = "latest double, rows long, late long, batch long"
LATE_SCHEMA = "region string, date date, late long, batch long"


class SliceSink:
    """For ``foreachBatch``: telemetry rows with ``timestamp`` in seconds, below ``root``."""

    def __init__(self, root: str, delay_s: float = 86_400.0):
        self.root, self.delay_s = root.rstrip("/"), delay_s

    @property
    def slices(self) -> str:
        return f"{self.root}/slices"

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        day = F.date_add(F.lit(date(1970, 1, 1)), F.floor(F.col("timestamp") / 86_400).cast("int"))
        rows = region_rows(batch).filter("timestamp is not null").withColumns({"date": day, BATCH: F.lit(number)})
        write_slices(rows, self.slices, ["region", "date", BATCH])

        before = self.marks(spark).filter(F.col(BATCH) < number).agg(F.max("latest")).first()[0]
        late = F.lit(False) if before is None else F.col("timestamp") < before - self.delay_s
        counted = rows.groupBy("region", "date").agg(F.count_if(late).alias("late"), F.count("*").alias("rows"), F.max("timestamp").alias("latest"))
        # One row per slice of the batch.
        found = counted.collect()
        behind = [(r.region, r.date, r.late) for r in found if r.late]
        latest = max((float(r.latest) for r in found), default=None)
        self._replace(spark.createDataFrame(behind, LATE_SCHEMA.rsplit(",", 1)[0]), "late", number)
        mark = [(latest, sum(r.rows for r in found), sum(r.late for r in found))]
        # The mark is written last: with it the batch is whole.
        self._replace(spark.createDataFrame(mark, MARK_SCHEMA.rsplit(",", 1)[0]), "marks", number)

    def _replace(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{kind}/{BATCH}={number}")

    def _side(self, spark: SparkSession, kind: str, schema: str) -> DataFrame:
        path = f"{self.root}/{kind}"
        if not exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path)

    def marks(self, spark: SparkSession) -> DataFrame:
        """One row per whole batch: its latest time, rows and late rows."""
        return self._side(spark, "marks", MARK_SCHEMA)

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows behind the watermark by slice and batch."""
        return self._side(spark, "late", LATE_SCHEMA)

    def read(self, spark: SparkSession, region: str | None = None, day: date | None = None) -> DataFrame:
        """The rows of all batches, without those of a batch that is not whole yet."""
        rows = read_slices(spark, self.slices, region, day)
        return rows.join(F.broadcast(self.marks(spark).select(BATCH)), BATCH, "left_semi").drop(BATCH)

    def settle_days(self, spark: SparkSession, days: Sequence[date], out: str) -> None:
        """Write the given days, each slice as one, below ``out``; other days stay as they are."""
        if days:
            rows = self.read(spark).filter(F.col("date").isin(list(days)))
            write_slices(rows, out)
