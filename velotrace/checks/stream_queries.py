"""Streams over files of the driver's tables, sketches, roll-ups and prefix tables, with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.checks.event_queries import trips_with_accel, with_events
from velotrace.checks.telemetry_queries import REGION_CASE, _text_days, with_day
from velotrace.checks.views import ACCEL_SQL, duck, table, telemetry
from velotrace.operators import events, regions, sketches
from velotrace.session import new_path, written
from velotrace.settings import Settings
from velotrace.streaming import live, rolling
from velotrace.streaming.slices import SliceSink

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


# ---- streams --------------------------------------------------------------------------------


def as_stream(spark: SparkSession, rows: DataFrame, files: int, per_batch: int, label: str) -> DataFrame:
    """A stream over the rows as files in the order of time, some files in each batch."""
    path = new_path(spark, label)
    rows.repartitionByRange(files, "timestamp", "record_seqnum").write.parquet(path)
    # Files are listed by age, which one job does not decide, so batches follow their names.
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def _rolling_sql(window: int) -> str:
    over = f"OVER (PARTITION BY device_id ORDER BY timestamp, event_id ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    cols = ", ".join(
        f"quantile_cont(peak_{a}, 0.95) {over} AS t{a}, max(peak_{a}) {over} AS m{a}, "
        f"median(peak_{a}) {over} AS d{a}, mad(peak_{a}) {over} AS a{a}"
        for a in "xyz"
    )
    kinds = {"x": ("hard_brake", "y", "z"), "y": ("swerve", "x", "z"), "z": ("pothole", "x", "y")}
    parts = [
        f"""SELECT device_id, event_id AS record_seqnum, '{kind}' AS event_type,
          CAST(greatest(1, least(10, trunc(2 + 8 * (CASE WHEN m{a} > t{a} THEN (peak_{a} - t{a}) / (m{a} - t{a}) ELSE 0 END)))) AS INT) AS severity,
          round(peak_{a}, 6) AS peak_value, CAST(n AS INT) AS window_rows
        FROM w WHERE n >= 10 AND peak_{a} > t{a} AND peak_{a} > 2 * peak_{o1} AND peak_{a} > 2 * peak_{o2}
          AND a{a} > 0 AND abs(peak_{a} - d{a}) / a{a} > 3"""
        for a, (kind, o1, o2) in kinds.items()
    ]
    return duck(
        "SELECT * FROM ev",
        five=ACCEL_SQL.replace("user_id AS device_id", "user_id % 5 AS device_id"),
        w=f"""SELECT *, count(*) {over} AS n, {cols} FROM five WHERE position_latitude IS NOT NULL
          AND position_longitude IS NOT NULL AND (position_latitude <> 0 OR position_longitude <> 0)
          AND (peak_x > 0 OR peak_y > 0 OR peak_z > 0)""",
        ev=" UNION ALL ".join(parts),
    )


def as_aging_stream(spark: SparkSession, rows: DataFrame, files: int, label: str) -> DataFrame:
    """A stream over the rows as files of equal spans of time, the earliest written first and each a
    batch of its own, so that no batch holds a reading before those of an earlier one."""
    path = new_path(spark, label)
    rows = written(rows, label)
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    span = F.floor((F.col("timestamp") - first) / ((last - first) / files + 1))
    for k in range(files):
        rows.filter(span == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def rolling_found(spark: SparkSession, d: str, window: int) -> DataFrame:
    """The events of the streamed table, all devices as five, so that windows move on."""
    rows = trips_with_accel(spark, d).withColumn("device_id", F.col("device_id") % 5)
    stream = as_aging_stream(spark, rows, 4, "readings")
    out, checkpoint = new_path(spark, "rolling"), new_path(spark, "rolling-state")
    # Silent devices keep their windows, as they do in the SQL.
    found = rolling.rolling_events(stream, window=window, silence=10 * 365 * 86_400)
    found.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(
        out
    ).awaitTermination()
    events_found = spark.read.schema(rolling.OUT_SCHEMA).parquet(out)
    return events_found.select(
        "device_id", F.col("record_seqnum").cast("long").alias("record_seqnum"), "event_type", "severity",
        F.round("peak_value", 6).alias("peak_value"), "window_rows",
    )


@query("rolling_events", _rolling_sql(1000))
def rolling_events(spark, d):
    return rolling_found(spark, d, 1000)


@query("rolling_events_short_window", _rolling_sql(50))
def rolling_events_short_window(spark, d):
    return rolling_found(spark, d, 50)


@query(
    "stream_slices",
    duck(f"""SELECT region, strftime(day, '%Y-%m-%d') AS date, count(*) AS rows, sum(record_seqnum) AS total FROM
      (SELECT {REGION_CASE} AS region, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day, record_seqnum FROM telemetry)
      WHERE region IS NOT NULL GROUP BY ALL"""),
)
def stream_slices(spark, d):
    """Telemetry files as a stream into slices, in several batches, one of which is run twice."""
    rows = telemetry(spark, d)
    stream, checkpoint = as_stream(spark, rows, 6, 2, "inbox"), new_path(spark, "slice-state")
    sink = SliceSink(new_path(spark, "streamed"))

    def twice(batch: DataFrame, number: int) -> None:
        for _ in range(2 if number == 1 else 1):
            sink(batch, number)

    live.run_batches(stream, checkpoint, twice).awaitTermination()
    return _text_days(
        sink.read(spark).groupBy("region", "date").agg(
            F.count("*").alias("rows"), F.sum("record_seqnum").alias("total")
        )
    )


# ---- sketches -------------------------------------------------------------------------------


def device_sketches(spark: SparkSession, d: str) -> DataFrame:
    """A sketch of devices and speeds for each region and day, as a stored table."""
    rows = with_day(regions.region_rows(telemetry(spark, d)))
    return written(
        sketches.slice_sketches(rows, ["region", "date"], ["device_id"], ["position_speed"]), "slice-sketches"
    )


@query(
    "sketched_devices",
    duck(f"""SELECT region, count(*) AS rows, count(DISTINCT device_id) AS devices FROM
      (SELECT *, {REGION_CASE} AS region FROM telemetry) WHERE region IS NOT NULL GROUP BY ROLLUP (region)"""),
)
def sketched_devices(spark, d):
    """Distinct devices of each region and of all, over all days, from the slices' sketches."""
    stored = device_sketches(spark, d)
    devices = sketches.distinct_counts(stored, ["device_id"])["device_id"].alias("devices")
    by_region = sketches.united(stored, ["region"]).select("region", "rows", devices)
    total = sketches.united(stored).select(F.lit(None).cast("string").alias("region"), "rows", devices)
    return by_region.unionByName(total)


@query(
    "sketched_thresholds",
    duck("""SELECT device_id, axis, count(*) AS n, true AS threshold_close, true AS median_close, true AS mad_close FROM
      (SELECT device_id, unnest(['x', 'y', 'z']) AS axis FROM accel WHERE peak_x > 0 OR peak_y > 0 OR peak_z > 0)
      GROUP BY ALL UNION ALL SELECT NULL, axis, count(*), true, true, true FROM
      (SELECT unnest(['x', 'y', 'z']) AS axis FROM accel WHERE peak_x > 0 OR peak_y > 0 OR peak_z > 0) GROUP BY ALL"""),
)
def sketched_thresholds(spark, d):
    """Whether the rank of each threshold, median and MAD from sketches of days is as near as it is
    said to be, per device and over all devices, by the readings themselves."""
    active = written(
        with_day(events.active_rows(trips_with_accel(spark, d))).select("device_id", "date", *rolling.PEAKS), "active"
    )
    stored = written(sketches.slice_sketches(active, ["device_id", "date"], (), rolling.PEAKS), "peak-sketches")
    parts = []
    for by in (["device_id"], []):
        merged = sketches.united(stored, by)
        answers = merged.select(
            *by,
            *[x for a in events.AXES for x in (
                sketches.quantile(f"peak_{a}", 0.95).alias(f"t{a}"),
                sketches.quantile(f"peak_{a}", 0.5).alias(f"d{a}"),
                sketches.deviation(f"peak_{a}", sketches.quantile(f"peak_{a}", 0.5)).alias(f"a{a}"),
            )],
        )
        answers = written(answers, "sketch-answers")
        met = active.join(F.broadcast(answers), by) if by else events.attach(active, events.settle(answers, ()), ())
        axes = met.select(
            F.col("device_id") if by else F.lit(None).cast("long").alias("device_id"),
            F.inline(F.array(*[
                F.struct(F.lit(a).alias("axis"), F.col(f"peak_{a}").alias("x"), F.col(f"t{a}").alias("t"), F.col(f"d{a}").alias("d"), F.col(f"a{a}").alias("a"))
                for a in events.AXES
            ])),
        )

        def close(low, high, prob, times=1):
            """Whether an answer's values stand on both sides of the wanted rank, but for the error."""
            slack = F.lit(times * sketches.RANK_ERROR) * F.count("*") + times
            return (F.count_if(low) - slack <= F.lit(prob) * F.count("*")) & (
                F.lit(prob) * F.count("*") <= F.count_if(high) + slack
            )

        x, away = F.col("x"), F.abs(F.col("x") - F.col("d"))
        parts.append(
            axes.groupBy("device_id", "axis").agg(
                F.count("*").alias("n"),
                close(x < F.col("t"), x <= F.col("t"), 0.95).alias("threshold_close"),
                close(x < F.col("d"), x <= F.col("d"), 0.5).alias("median_close"),
                # Two ranks enter the distance, and steps stand for the values.
                close(away < F.col("a") * (1 - 1e-9), away <= F.col("a") * (1 + 1e-9), 0.5, 2.2).alias("mad_close"),
            )
        )
    return parts[0].unionByName(parts[1])


# ---- roll-up and prefix table ---------------------------------------------------------------


@query(
    "event_rollup",
    with_events("""SELECT region, event_type, severity, CAST(3 - bit_count(grouping_id(region, event_type, severity)) AS INT) AS depth,
      count(*) AS events, max(peak_value) AS highest_peak FROM
      (SELECT *, CASE device_id % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'west' END AS region FROM ev)
      GROUP BY ROLLUP (region, event_type, severity)"""),
)
def event_rollup(spark, d):
    """Events with subtotals; a quarter of the devices have no region."""
    found = events.abnormal_events(trips_with_accel(spark, d))
    region = F.expr("CASE device_id % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'west' END")
    return events.event_rollup(found.withColumn("region", region))


PREFIX_SQL = """
SELECT 1000000 - s_suppkey AS ord, CONCAT('r', s_nationkey) AS region,
  CONCAT(CASE s_suppkey % 6 WHEN 0 THEN 'as' WHEN 1 THEN 'TEBT' WHEN 2 THEN 'Hel' WHEN 3 THEN 'SPIN' WHEN 4 THEN 'sw' ELSE 'XX' END,
    s_suppkey % 23) AS prefix FROM supplier
"""


@query(
    "region_by_table",
    duck(f"""SELECT record_seqnum, arg_min(p.region, p.ord) AS region FROM telemetry t
      LEFT JOIN ({PREFIX_SQL}) p ON starts_with(upper(trim(device_name)), upper(prefix)) GROUP BY record_seqnum"""),
)
def region_by_table(spark, d):
    """Regions from a table with a prefix for every supplier."""
    text = PREFIX_SQL.replace("FROM supplier", "FROM {supplier}")
    prefixes = spark.sql(text, supplier=table(spark, d, "supplier"))
    return regions.region_by_table(telemetry(spark, d), prefixes).select("record_seqnum", "region")


@query(
    "region_by_table_of_hot_names",
    SQL["region_by_table"],
)
def region_by_table_of_hot_names(spark, d):
    """The same where no table is small enough to broadcast and every name is hot."""
    text = PREFIX_SQL.replace("FROM supplier", "FROM {supplier}")
    prefixes = spark.sql(text, supplier=table(spark, d, "supplier"))
    hot = Settings(group_rows=5, broadcast_rows=5)
    return regions.region_by_table(telemetry(spark, d), prefixes, hot).select("record_seqnum", "region")
