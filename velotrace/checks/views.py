"""Telemetry-shaped views over the driver's ``events`` and ``orders`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The same text runs in both engines; only the base differs.
TELEMETRY_SQL = """
SELECT event_id AS record_seqnum, user_id AS device_id,
  CASE user_id % 8 WHEN 0 THEN CONCAT('AS',user_id) WHEN 1 THEN CONCAT('tebt',user_id)
    WHEN 2 THEN CONCAT(' HEL',user_id,' ') WHEN 3 THEN CONCAT('SPIN',user_id)
    WHEN 4 THEN CONCAT('SW',user_id) WHEN 5 THEN CONCAT('Xx',user_id)
    WHEN 6 THEN CONCAT('ZZ',user_id) ELSE NULL END AS device_name,
  CASE WHEN k % 10 = 0 THEN CONCAT('SN',k) END AS device_serial_number,
  tsec AS timestamp, tsec AS position_timestamp,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(51 AS DOUBLE) + ((user_id*37 + k) % 997) / CAST(10000 AS DOUBLE) END AS position_latitude,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 22 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(-0.5 AS DOUBLE) + ((user_id*53 + k*7) % 991) / CAST(10000 AS DOUBLE) END AS position_longitude,
  CASE WHEN k % 5 = 0 THEN NULL ELSE value END AS position_speed
FROM base
"""

ACCEL_SQL = """
SELECT event_id, user_id AS device_id, tsec AS timestamp,
  CAST(51 AS DOUBLE) + (k % 97) / CAST(10000 AS DOUBLE) AS position_latitude,
  CAST(-0.5 AS DOUBLE) + (k % 89) / CAST(10000 AS DOUBLE) AS position_longitude,
  value AS peak_x,
  CAST(k*k*k AS DOUBLE) / 10000 AS peak_y,
  CAST(power((event_id*7919 + k*31) % 100, 4) AS DOUBLE) / 1000000 AS peak_z
FROM base
"""

# Points every few hundred metres of a synthetic road mesh, one per order.
ROAD_SQL = """
SELECT CAST(o_orderkey AS BIGINT) AS road_id, CAST(o_custkey % 1000 AS INT) AS seq,
  CAST(51 AS DOUBLE) + ((o_orderkey*31) % 9973) / CAST(100000 AS DOUBLE) AS lat,
  CAST(-0.5 AS DOUBLE) + ((o_orderkey*57 + o_custkey*3) % 9967) / CAST(100000 AS DOUBLE) AS lon
FROM orders
"""

DUCK_BASE = """
SELECT *, CAST(json_extract(props,'$.k') AS INT) AS k,
       CAST(FLOOR(epoch_us(ts)/1000000.0) AS BIGINT) AS tsec FROM events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000000"
    # json_tuple is a generator, so a filter on what follows does not parse the text again.
    parsed = table(spark, sf_dir, "events").select("*", F.json_tuple("props", "k").alias("_k"))
    return parsed.withColumns({"k": F.col("_k").cast("int"), "tsec": F.expr(seconds)}).drop("_k")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TELEMETRY_SQL.replace("FROM base", "FROM {base}"), base=_base(spark, sf_dir))


def accel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ACCEL_SQL.replace("FROM base", "FROM {base}"), base=_base(spark, sf_dir))


def road_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return spark.sql(ROAD_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)


def duck(sql: str, **views: str) -> str:
    """DuckDB text with the telemetry views as common table expressions."""
    parts = {
        "base": DUCK_BASE,
        "telemetry": TELEMETRY_SQL,
        "accel": ACCEL_SQL,
        "road": ROAD_SQL,
        **views,
    }
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in parts.items()) + " " + sql
