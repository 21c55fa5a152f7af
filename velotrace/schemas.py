"""Schemas and column orders of the tables that cross a stage boundary."""

from __future__ import annotations

from pyspark.sql import types as T

# Message keys in table order, with the type each is read as.
MESSAGE_FIELDS = [
    ("battery.voltage", T.DoubleType()),
    ("device.id", T.LongType()),
    ("device.name", T.StringType()),
    ("device.serial.number", T.StringType()),
    ("device.temperature", T.DoubleType()),
    ("gsm.signal.quality", T.DoubleType()),
    ("ident", T.StringType()),
    ("loaded.battery.voltage", T.DoubleType()),
    ("position.accuracy", T.DoubleType()),
    ("position.altitude", T.DoubleType()),
    ("position.direction", T.DoubleType()),
    ("position.latitude", T.DoubleType()),
    ("position.longitude", T.DoubleType()),
    ("position.pdop", T.DoubleType()),
    ("position.speed", T.DoubleType()),
    ("position.timestamp", T.DoubleType()),
    ("record.seqnum", T.DoubleType()),
    ("report.reason", T.StringType()),
    ("rtc.timestamp", T.DoubleType()),
    ("server.timestamp", T.DoubleType()),
    ("timestamp", T.DoubleType()),
    ("trip.status", T.StringType()),
]

CORRUPT = "_corrupt"
MESSAGE_SCHEMA = T.StructType(
    [T.StructField(name, kind) for name, kind in MESSAGE_FIELDS]
    + [T.StructField(CORRUPT, T.StringType())]
)

TELEMETRY_COLUMNS = [name.replace(".", "_") for name, _ in MESSAGE_FIELDS]
TELEMETRY_SCHEMA = T.StructType(
    [T.StructField(name.replace(".", "_"), kind) for name, kind in MESSAGE_FIELDS]
)

# Rows of a device are ordered by these columns; the first one separates the devices.
DEVICE = "device_id"
TIME_ORDER = ["timestamp", "position_timestamp", "record_seqnum"]
ROW_ORDER = [DEVICE] + TIME_ORDER

NUMERIC_COLUMNS = TIME_ORDER + ["position_latitude", "position_longitude"]

TRIP_COLUMNS = TELEMETRY_COLUMNS + ["distance_m", "time_s"]

# Accelerometer channels and the names they are analysed under.
ACCEL_CHANNELS = {
    "ain.12": "peak_x",
    "ain.13": "peak_y",
    "ain.14": "peak_z",
    "ain.15": "avg_x",
    "ain.16": "avg_y",
    "ain.17": "avg_z",
}

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("device_id", T.LongType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("peak_value", T.DoubleType()),
        T.StructField("original_index", T.LongType()),
    ]
)

ROAD_POINT_SCHEMA = T.StructType(
    [
        T.StructField("road_id", T.LongType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

# One row per vertex of a route between two points; keys come from functions.geo.point_key.
ROUTE_SCHEMA = T.StructType(
    [
        T.StructField("from_key", T.StringType()),
        T.StructField("to_key", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("cum_m", T.DoubleType()),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
    ]
)
