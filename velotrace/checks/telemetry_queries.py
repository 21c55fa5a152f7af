"""Cleaning, trips, regions, roads, publishing and sources over the driver's tables, with SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.checks.event_queries import haversine_sql
from velotrace.checks.views import duck, road_points, table, telemetry
from velotrace.functions import dates
from velotrace.functions.geo import haversine, point_key
from velotrace.operators.events import has_position
from velotrace.operators import clean, manifest, publish, regions, roads, trips
from velotrace.operators.ordered import first_after, last_before, ordered, row_count, scan
from velotrace.plans import daily
from velotrace.schemas import MESSAGE_FIELDS, TIME_ORDER
from velotrace.session import new_path
from velotrace.settings import REGION_INFO, REGION_PREFIXES, Settings
from velotrace.sources import messages, sinks, tables
from velotrace.streaming import live

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DAY_GAP = Settings(trip_gap_s=86400.0)
ORDER = "timestamp NULLS LAST, position_timestamp NULLS LAST, record_seqnum NULLS LAST"


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


def duck_with(parts: str, sql: str) -> str:
    """SQL after further common table expressions."""
    return duck("@").replace("@", ", " + parts + " " + sql)


# ---- cleaning -------------------------------------------------------------------------------


@query("without_serial", duck("SELECT record_seqnum FROM telemetry WHERE device_serial_number IS NULL"))
def without_serial(spark, d):
    return clean.without_serial(telemetry(spark, d)).select("record_seqnum")


@query(
    "valid_coordinates",
    duck("""SELECT record_seqnum,
      coalesce(position_latitude <> 0 AND position_longitude <> 0, false) AS can_snap,
      position_latitude IS NOT NULL AND position_longitude IS NOT NULL
        AND (position_latitude <> 0 OR position_longitude <> 0) AS has_position FROM telemetry"""),
)
def valid_coordinates(spark, d):
    return telemetry(spark, d).select(
        "record_seqnum", clean.can_snap().alias("can_snap"), has_position().alias("has_position")
    )


@query(
    "numeric_coercion",
    """SELECT event_id, try_cast(CASE event_type WHEN 'click' THEN 'n/a' WHEN 'error' THEN NULL
      ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS position_latitude FROM events""",
)
def numeric_coercion(spark, d):
    text = (
        F.when(F.col("event_type") == "click", "n/a")
        .when(F.col("event_type") == "error", None)
        .otherwise(F.col("value").cast("string"))
    )
    rows = table(spark, d, "events").select("event_id", text.alias("position_latitude"))
    return clean.coerce_numeric(rows)


BLANK = """clean AS (SELECT * FROM telemetry WHERE device_serial_number IS NULL),
  nth AS (SELECT *, row_number() OVER (PARTITION BY position_latitude, position_longitude
    ORDER BY device_id, timestamp, position_timestamp, record_seqnum) AS nth FROM clean),
  blank AS (SELECT * EXCLUDE (nth, position_latitude, position_longitude),
    CASE WHEN nth = 1 THEN position_latitude END AS position_latitude,
    CASE WHEN nth = 1 THEN position_longitude END AS position_longitude FROM nth)"""


@query(
    "dedup_coordinates",
    duck_with(BLANK, "SELECT record_seqnum, position_latitude, position_longitude FROM blank"),
)
def dedup_coordinates(spark, d):
    rows = clean.blank_repeats(clean.without_serial(telemetry(spark, d)))
    return rows.select("record_seqnum", "position_latitude", "position_longitude")


@query(
    "sorted_nulls_last",
    "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY c_name NULLS LAST, o_orderkey) - 1 AS place "
    "FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey",
)
def sorted_nulls_last(spark, d):
    rich = table(spark, d, "customer").filter("c_acctbal > 0")
    rows = table(spark, d, "orders").join(rich, F.expr("o_custkey = c_custkey"), "left")
    series = scan(ordered(rows, [], ["c_name", "o_orderkey"]), _nth=row_count())
    return series.done().select("o_orderkey", "o_custkey", (F.col("_nth") - 1).alias("place"))


@query(
    "preprocess",
    duck("""SELECT record_seqnum, CAST(timestamp AS DOUBLE) AS timestamp, CAST(coalesce(timestamp - lag(timestamp)
      OVER (PARTITION BY device_id ORDER BY """ + ORDER + """), 0) AS DOUBLE) AS time_diff, CAST(NULL AS DOUBLE) AS snapped_lat,
      false AS was_snapped, false AS trip_break FROM telemetry WHERE device_serial_number IS NULL"""),
)
def preprocess(spark, d):
    rows = clean.preprocess(telemetry(spark, d))
    return rows.select(
        F.col("record_seqnum").cast("long").alias("record_seqnum"),
        "timestamp", "time_diff", "snapped_lat", "was_snapped", "trip_break",
    )


# ---- trips ----------------------------------------------------------------------------------


def located(spark: SparkSession, d: str) -> DataFrame:
    """Telemetry whose raw positions stand in for snapped ones."""
    return telemetry(spark, d).withColumns(
        {
            "snapped_lat": F.col("position_latitude"),
            "snapped_lon": F.col("position_longitude"),
            "was_snapped": F.col("position_latitude") > 51.05,
        }
    )


def trips_sql(gap: float, sql: str, first_fix: bool = True, source: str = "", before: str = "") -> str:
    """SQL over ``trips``: the rows of ``source`` with lat and lon, measured along their devices."""
    over = f"OVER (PARTITION BY device_id ORDER BY {ORDER})"
    fix = "WHEN lat IS NOT NULL AND lon IS NOT NULL AND nv = 1 THEN 0" if first_fix else ""
    metres = haversine_sql("plat", "plon", "lat", "lon")
    source = source or "(SELECT *, position_latitude AS lat, position_longitude AS lon FROM telemetry)"
    return duck_with(
        f"""{before} a AS (SELECT *, lag(timestamp) {over} AS pts, lag(lat) {over} AS plat,
          lag(lon) {over} AS plon, row_number() {over} AS place, count(*) OVER (PARTITION BY device_id) AS n FROM {source}),
        b AS (SELECT *, coalesce(timestamp - pts > {gap}, false) AS brk FROM a),
        c AS (SELECT *, place = 1 OR brk AS opening, sum(CAST(brk AS INT)) {over} AS trip FROM b),
        e AS (SELECT *, sum(CASE WHEN lat IS NOT NULL AND lon IS NOT NULL AND NOT opening THEN 1 ELSE 0 END)
          OVER (PARTITION BY device_id, trip ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS nv FROM c),
        m AS (SELECT *, CAST(CASE WHEN n < 2 THEN NULL WHEN place = 1 THEN 0 WHEN brk THEN -1
            ELSE timestamp - pts END AS DOUBLE) AS time_s,
          CASE WHEN n < 2 THEN NULL WHEN opening THEN 0 {fix}
            WHEN lat IS NOT NULL AND lon IS NOT NULL AND plat IS NOT NULL AND plon IS NOT NULL THEN {metres}
            ELSE 0 END AS distance_m, concat(device_id, '-', trip) AS trip_id FROM e),
        trips AS (SELECT * EXCLUDE (position_speed), brk AS trip_break, CASE
            WHEN lat IS NOT NULL AND plat IS NOT NULL AND time_s > 0 THEN
              CASE WHEN distance_m > 0 AND distance_m / time_s * 3.6 <= 200 THEN distance_m / time_s * 3.6 ELSE 0 END
            ELSE position_speed END AS position_speed FROM m)""",
        sql,
    )


@query(
    "time_diff",
    duck(f"""SELECT record_seqnum, CAST(coalesce(timestamp - lag(timestamp) OVER (PARTITION BY device_id
      ORDER BY {ORDER}), 0) AS DOUBLE) AS time_diff FROM telemetry"""),
)
def time_diff(spark, d):
    return clean.add_time_diff(telemetry(spark, d)).select("record_seqnum", "time_diff")


BREAKS = "SELECT record_seqnum, trip_break, time_s, trip_id FROM trips"


@query("trip_breaks", trips_sql(86400, BREAKS))
def trip_breaks(spark, d):
    return trips.trip_metrics(located(spark, d), DAY_GAP).select(
        "record_seqnum", "trip_break", "time_s", "trip_id"
    )


@query("trip_breaks_30_minutes", trips_sql(1800, BREAKS))
def trip_breaks_30_minutes(spark, d):
    return trips.trip_metrics(located(spark, d)).select(
        "record_seqnum", "trip_break", "time_s", "trip_id"
    )


@query(
    "trip_distance", trips_sql(86400, "SELECT record_seqnum, round(distance_m, 4) AS distance_m FROM trips")
)
def trip_distance(spark, d):
    return trips.trip_metrics(located(spark, d), DAY_GAP).select(
        "record_seqnum", F.round("distance_m", 4).alias("distance_m")
    )


@query(
    "trip_distance_strict",
    trips_sql(86400, "SELECT record_seqnum, round(distance_m, 4) AS distance_m FROM trips", False),
)
def trip_distance_strict(spark, d):
    return trips.trip_metrics(located(spark, d), DAY_GAP, first_fix_rule="strict").select(
        "record_seqnum", F.round("distance_m", 4).alias("distance_m")
    )


@query(
    "trip_speed", trips_sql(86400, "SELECT record_seqnum, round(position_speed, 4) AS position_speed FROM trips")
)
def trip_speed(spark, d):
    return trips.trip_metrics(located(spark, d), DAY_GAP).select(
        "record_seqnum", F.round("position_speed", 4).alias("position_speed")
    )


SUMMARY = """SELECT device_id, trip_id, count(*) AS points, min(timestamp) AS started, max(timestamp) AS ended,
  max(timestamp) - min(timestamp) AS duration_s, round(sum(distance_m), 3) AS distance_m,
  round(max(position_speed), 4) AS max_speed, max(time_s) AS longest_gap_s FROM trips GROUP BY device_id, trip_id"""


@query("trip_summary", trips_sql(86400, SUMMARY))
def trip_summary(spark, d):
    found = trips.trip_summary(trips.trip_metrics(located(spark, d), DAY_GAP))
    return found.withColumns(
        {"distance_m": F.round("distance_m", 3), "max_speed": F.round("max_speed", 4)}
    )


@query(
    "trip_filter",
    trips_sql(86400, """SELECT record_seqnum, trip_id FROM trips JOIN (SELECT trip_id FROM trips GROUP BY trip_id
      HAVING max(timestamp) - min(timestamp) >= 3600 AND sum(distance_m) >= 1000 AND coalesce(max(time_s), 0) <= 72000)
      USING (trip_id)"""),
)
def trip_filter(spark, d):
    rows = trips.trip_metrics(located(spark, d), DAY_GAP)
    return trips.filter_trips(rows, 3600, 1000, 72000).select("record_seqnum", "trip_id")


@query(
    "trip_coverage",
    trips_sql(86400, """SELECT count(*) AS total_rows, count(lat) AS located_rows,
      round(count(lat) / count(*) * 100, 6) AS filled_percent,
      count(*) FILTER (lat > 51.05) AS snapped_rows, count(*) FILTER (trip_break) AS trip_breaks,
      count(distance_m) AS valid_distances, count(*) - count(lat) AS missing_rows FROM trips"""),
)
def trip_coverage(spark, d):
    found = trips.coverage(trips.trip_metrics(located(spark, d), DAY_GAP))
    return found.withColumn("filled_percent", F.round("filled_percent", 6))


@query(
    "trip_road_distance",
    trips_sql(86400, """SELECT record_seqnum, round(CASE WHEN NOT opening AND nv <> 1 AND lat IS NOT NULL
        AND lon IS NOT NULL AND plat IS NOT NULL AND plon IS NOT NULL AND device_id % 2 = 0
      THEN distance_m * 1.25 ELSE distance_m END, 3) AS distance_m FROM trips"""),
)
def trip_road_distance(spark, d):
    rows = located(spark, d)
    # A road table of the even devices' steps, each a quarter longer than the straight line.
    measured = scan(
        ordered(rows.filter("device_id % 2 = 0"), ["device_id"], TIME_ORDER),
        _from=last_before(F.struct(F.col("snapped_lat").alias("lat"), F.col("snapped_lon").alias("lon"))),
    ).done()
    here = F.col("snapped_lat"), F.col("snapped_lon")
    there = F.col("_from.lat"), F.col("_from.lon")
    steps = (
        measured.filter(F.col("snapped_lat").isNotNull() & F.col("_from.lat").isNotNull())
        .select(
            point_key(*there).alias("from_key"),
            point_key(*here).alias("to_key"),
            (haversine(*there, *here) * 1.25).alias("total_m"),
        )
        .groupBy("from_key", "to_key")
        .agg(F.max("total_m").alias("total_m"))
    )
    even = trips.trip_metrics(rows.filter("device_id % 2 = 0"), DAY_GAP, road_distances=steps)
    odd = trips.trip_metrics(rows.filter("device_id % 2 = 1"), DAY_GAP)
    return even.unionByName(odd).select(
        "record_seqnum", F.round("distance_m", 3).alias("distance_m")
    )


@query(
    "haversine",
    duck("SELECT record_seqnum, round(" + haversine_sql("51.05", "-0.45", "position_latitude", "position_longitude")
         + ", 4) AS metres FROM telemetry"),
)
def haversine_query(spark, d):
    metres = haversine(
        F.lit(51.05), F.lit(-0.45), F.col("position_latitude"), F.col("position_longitude")
    )
    return telemetry(spark, d).select("record_seqnum", F.round(metres, 4).alias("metres"))


# ---- regions --------------------------------------------------------------------------------


def _region_sql(column: str = "device_name") -> str:
    name = f"upper(trim({column}))"
    cases = " ".join(
        "WHEN " + " OR ".join(f"starts_with({name}, '{p}')" for p in starts) + f" THEN '{region}'"
        for region, starts in REGION_PREFIXES.items()
    )
    return f"CASE {cases} END"


REGION_CASE = _region_sql()


@query("region_lookup", duck(f"SELECT record_seqnum, device_name, {REGION_CASE} AS region FROM telemetry"))
def region_lookup(spark, d):
    return regions.add_region(telemetry(spark, d)).select("record_seqnum", "device_name", "region")


@query(
    "region_lookup_exact",
    duck(f"""SELECT record_seqnum, coalesce({REGION_CASE}, CASE WHEN trim(device_name) IN ('ZZ6', 'ZZ14') THEN 'harbour'
      WHEN trim(device_name) IN ('ZZ14', 'AS8') THEN 'island' END) AS region FROM telemetry"""),
)
def region_lookup_exact(spark, d):
    exact = {"harbour": ["ZZ6", "ZZ14"], "island": ["ZZ14", "AS8"]}
    return regions.add_region(telemetry(spark, d), exact=exact).select("record_seqnum", "region")


@query(
    "region_counts",
    duck(f"SELECT region, count(*) AS rows FROM (SELECT {REGION_CASE} AS region FROM telemetry) "
         "WHERE region IS NOT NULL GROUP BY region"),
)
def region_counts(spark, d):
    return regions.region_counts(telemetry(spark, d))


@query(
    "unmatched_devices",
    duck(f"SELECT DISTINCT coalesce(device_name, 'nan') AS device_name FROM telemetry WHERE {REGION_CASE} IS NULL"),
)
def unmatched_devices(spark, d):
    return regions.unmatched_devices(telemetry(spark, d))


@query(
    "processed_vs_total",
    duck(f"SELECT count({REGION_CASE}) AS processed_rows, count(*) AS total_rows FROM telemetry"),
)
def processed_vs_total(spark, d):
    return regions.processed_and_total(telemetry(spark, d))


@query("probe", duck("SELECT record_seqnum, device_name FROM telemetry ORDER BY record_seqnum LIMIT 100"))
def probe(spark, d):
    return regions.probe(telemetry(spark, d), ["record_seqnum"]).select("record_seqnum", "device_name")


@query(
    "sample_devices",
    duck("""SELECT device_name FROM telemetry WHERE device_name IS NOT NULL GROUP BY device_name
      ORDER BY min(record_seqnum) LIMIT 10"""),
)
def sample_devices(spark, d):
    return regions.sample_devices(telemetry(spark, d), ["record_seqnum"])


@query(
    "sample_regions",
    duck(f"""SELECT coalesce({REGION_CASE}, 'unknown') AS region, count(*) AS devices FROM
      (SELECT DISTINCT device_name FROM telemetry WHERE device_name IS NOT NULL) GROUP BY 1"""),
)
def sample_regions(spark, d):
    return regions.sample_regions(telemetry(spark, d))


@query(
    "region_info",
    duck(f"SELECT record_seqnum, region, CASE region "
         + " ".join(f"WHEN '{r}' THEN '{c}'" for r, (c, _) in REGION_INFO.items())
         + " END AS country, CASE region "
         + " ".join(f"WHEN '{r}' THEN '{z}'" for r, (_, z) in REGION_INFO.items())
         + f" END AS timezone FROM (SELECT record_seqnum, {REGION_CASE} AS region FROM telemetry)"),
)
def region_info(spark, d):
    rows = regions.add_region(telemetry(spark, d)).select("record_seqnum", "region")
    return regions.add_region_info(rows).select("record_seqnum", "region", "country", "timezone")


# ---- roads ----------------------------------------------------------------------------------


def snapped(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.blank_repeats(clean.without_serial(telemetry(spark, d)))
    return clean.add_time_diff(roads.snap(rows, None))


SNAPPED = BLANK + f""", sn AS (SELECT *,
    CASE WHEN position_latitude <> 0 AND position_longitude <> 0 THEN position_latitude END AS slat,
    CASE WHEN position_latitude <> 0 AND position_longitude <> 0 THEN position_longitude END AS slon,
    coalesce(timestamp - lag(timestamp) OVER (PARTITION BY device_id ORDER BY {ORDER}), 0) AS time_diff,
    row_number() OVER (PARTITION BY device_id ORDER BY {ORDER}) AS rn FROM blank),
  pt AS (SELECT *, CASE WHEN slat IS NOT NULL THEN {{'rn': rn, 'lat': slat, 'lon': slon}} END AS p FROM sn),
  gp AS (SELECT *, last_value(p IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY {ORDER}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f,
    first_value(p IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY {ORDER}
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t FROM pt)"""

PROGRESS = SNAPPED + f""", gr AS (SELECT *, slat IS NULL AND f IS NOT NULL AND t IS NOT NULL AS gap,
    (rn - f.rn) / (t.rn - f.rn) AS ratio,
    position_speed IS NOT NULL AND time_diff > 0 AS moves FROM gp),
  rs AS (SELECT *, sum(CASE WHEN gap AND NOT moves THEN 1 ELSE 0 END) OVER (PARTITION BY device_id, f.rn
    ORDER BY {ORDER}) AS part FROM gr),
  pr AS (SELECT *, CASE WHEN gap THEN coalesce(max(CASE WHEN NOT moves THEN ratio END) OVER
      (PARTITION BY device_id, f.rn, gap, part), 0) END AS share,
    CASE WHEN gap THEN sum(CASE WHEN moves THEN greatest(position_speed, 0) / 3.6 * time_diff ELSE 0 END) OVER
      (PARTITION BY device_id, f.rn, gap, part ORDER BY {ORDER}) END AS moved FROM rs)"""


@query(
    "forward_fill",
    duck_with(SNAPPED, "SELECT record_seqnum, f.lat AS last_lat, f.lon AS last_lon FROM gp"),
)
def forward_fill(spark, d):
    rows = scan(ordered(snapped(spark, d), ["device_id"], TIME_ORDER), _from=last_before(_fix())).done()
    return rows.select("record_seqnum", F.col("_from.lat").alias("last_lat"), F.col("_from.lon").alias("last_lon"))


@query(
    "backward_fill",
    duck_with(SNAPPED, "SELECT record_seqnum, t.lat AS next_lat, t.lon AS next_lon FROM gp"),
)
def backward_fill(spark, d):
    rows = scan(ordered(snapped(spark, d), ["device_id"], TIME_ORDER), _to=first_after(_fix())).done()
    return rows.select("record_seqnum", F.col("_to.lat").alias("next_lat"), F.col("_to.lon").alias("next_lon"))


def _fix():
    point = F.struct(F.col("snapped_lat").alias("lat"), F.col("snapped_lon").alias("lon"))
    return F.when(F.col("snapped_lat").isNotNull(), point)


@query(
    "gap_progress",
    duck_with(PROGRESS, "SELECT record_seqnum, round(share, 9) AS share, round(moved, 3) AS moved_m FROM pr"),
)
def gap_progress(spark, d):
    series = ordered(snapped(spark, d), ["device_id"], TIME_ORDER)
    rows = roads.gap_progress(roads.gap_bounds(series)).done()
    return rows.select(
        "record_seqnum", F.round("_share", 9).alias("share"), F.round("_moved_m", 3).alias("moved_m")
    )


LINE = PROGRESS + ", ln AS (SELECT *, CASE WHEN gap THEN " + haversine_sql("f.lat", "f.lon", "t.lat", "t.lon") + """ END AS metres FROM pr),
  ix AS (SELECT *, ceil(least(1.0, share + moved / metres) * 10 - 0.5) AS i FROM ln),
  fi AS (SELECT *, CASE WHEN gap AND metres > 0 THEN f.lat + (t.lat - f.lat) * i / 10 ELSE slat END AS flat,
    CASE WHEN gap AND metres > 0 THEN f.lon + (t.lon - f.lon) * i / 10 ELSE slon END AS flon,
    gap AND metres > 0 AS placed FROM ix)"""


@query(
    "interpolated_gaps",
    duck_with(LINE, """SELECT record_seqnum, round(flat, 8) AS snapped_lat, round(flon, 8) AS snapped_lon,
      coalesce(placed, false) AS was_snapped FROM fi"""),
)
def interpolated_gaps(spark, d):
    return _places(roads.interpolate_gaps(snapped(spark, d)))


def _places(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("record_seqnum").cast("long").alias("record_seqnum"),
        F.round("snapped_lat", 8).alias("snapped_lat"),
        F.round("snapped_lon", 8).alias("snapped_lon"),
        "was_snapped",
    )


SPREAD = """ CASE WHEN m <= n - 2 THEN CASE WHEN k = m - 1 AND m > 1 THEN n - 2
    ELSE floor(k * ((n - 3) / greatest(m - 1, 1)) + 1) END ELSE least(k + 1, n - 2) END """

FILL = SNAPPED + """, k AS (SELECT *, slat IS NULL AND f IS NOT NULL AND t IS NOT NULL AS gap,
    rn - f.rn - 1 AS k, t.rn - f.rn - 1 AS m, 11 AS n FROM gp),
  i AS (SELECT *, """ + SPREAD + " AS i FROM k)"


@query(
    "gap_assignment",
    duck_with(FILL, """SELECT record_seqnum, round(CASE WHEN gap THEN f.lat + (t.lat - f.lat) * i / 10 ELSE slat END, 8) AS snapped_lat,
      round(CASE WHEN gap THEN f.lon + (t.lon - f.lon) * i / 10 ELSE slon END, 8) AS snapped_lon, gap AS was_snapped FROM i"""),
)
def gap_assignment(spark, d):
    return _places(roads.fill_missing(snapped(spark, d)))


NEAR = """pl AS (SELECT DISTINCT position_latitude AS lat, position_longitude AS lon FROM telemetry
    WHERE position_latitude <> 0 AND position_longitude <> 0),
  nr AS (SELECT p.lat, p.lon, min({'m': """ + haversine_sql("p.lat", "p.lon", "r.lat", "r.lon") + """,
      'lat': r.lat, 'lon': r.lon}) AS best FROM pl p JOIN road r
      ON r.lat BETWEEN p.lat - 0.001 AND p.lat + 0.001 AND r.lon BETWEEN p.lon - 0.0016 AND p.lon + 0.0016
    GROUP BY p.lat, p.lon),
  hit AS (SELECT lat, lon, best FROM nr WHERE best.m <= 100)"""


@query(
    "road_snap",
    duck_with(NEAR, """SELECT record_seqnum, CASE WHEN position_latitude <> 0 AND position_longitude <> 0
        THEN coalesce(best.lat, position_latitude) END AS snapped_lat,
      CASE WHEN position_latitude <> 0 AND position_longitude <> 0
        THEN coalesce(best.lon, position_longitude) END AS snapped_lon,
      best IS NOT NULL AS was_snapped
      FROM telemetry LEFT JOIN hit ON position_latitude = lat AND position_longitude = lon"""),
)
def road_snap(spark, d):
    close = Settings(snap_radius_m=100.0)
    rows = roads.snap(telemetry(spark, d), roads.road_index(road_points(spark, d), close), close)
    return rows.select("record_seqnum", "snapped_lat", "snapped_lon", "was_snapped")


@query(
    "road_snap_any_distance",
    duck_with("""pl AS (SELECT DISTINCT position_latitude AS lat, position_longitude AS lon FROM telemetry
        WHERE position_latitude <> 0 AND position_longitude <> 0),
      hit AS (SELECT p.lat, p.lon, min({'m': """ + haversine_sql("p.lat", "p.lon", "r.lat", "r.lon") + """,
        'lat': r.lat, 'lon': r.lon}) AS best FROM pl p, (SELECT DISTINCT lat, lon FROM road) r GROUP BY p.lat, p.lon)""",
      """SELECT record_seqnum, best.lat AS snapped_lat, best.lon AS snapped_lon, best IS NOT NULL AS was_snapped
      FROM telemetry LEFT JOIN hit ON position_latitude = lat AND position_longitude = lon"""),
)
def road_snap_any_distance(spark, d):
    rows = roads.snap(telemetry(spark, d), roads.road_index(road_points(spark, d)))
    return rows.select("record_seqnum", "snapped_lat", "snapped_lon", "was_snapped")


@query(
    "road_snap_refined_cells",
    SQL["road_snap"],
)
def road_snap_refined_cells(spark, d):
    fine = Settings(cell_points=4, broadcast_rows=400, group_rows=2000, snap_radius_m=100.0)
    rows = roads.snap(telemetry(spark, d), roads.road_index(road_points(spark, d), fine), fine)
    return rows.select("record_seqnum", "snapped_lat", "snapped_lon", "was_snapped")


def routes(spark: SparkSession, d: str) -> DataFrame:
    """One route per customer, through the customer's orders in key order."""
    rows = road_points(spark, d).join(
        table(spark, d, "orders").select(F.col("o_orderkey").alias("road_id"), "o_custkey"), "road_id"
    )
    key = F.col("o_custkey").cast("string")
    return rows.select(
        key.alias("from_key"), F.concat(F.lit("end-"), key).alias("to_key"),
        F.col("road_id").alias("seq"), "lat", "lon",
    )


ROUTES = "rt AS (SELECT o_custkey, road_id, lat, lon, row_number() OVER w - 1 AS seq, coalesce(" + haversine_sql(
    "lag(lat) OVER w", "lag(lon) OVER w", "lat", "lon"
) + """, 0) AS leg FROM road JOIN orders ON o_orderkey = road_id WINDOW w AS (PARTITION BY o_custkey ORDER BY road_id)),
  rc AS (SELECT *, sum(leg) OVER (PARTITION BY o_custkey ORDER BY seq) AS cum_m FROM rt)"""


@query(
    "route_lengths",
    duck_with(ROUTES, """SELECT CAST(o_custkey AS VARCHAR) AS from_key, CAST(seq AS INT) AS seq,
      round(cum_m, 3) AS cum_m FROM rc"""),
)
def route_lengths(spark, d):
    built = roads.build_routes(routes(spark, d))
    return built.select("from_key", "seq", F.round("cum_m", 3).alias("cum_m"))


@query(
    "nearest_vertex",
    duck_with(ROUTES + """, q AS (SELECT o_orderkey, o_custkey, o_totalprice / 10 AS progress_m FROM orders),
      best AS (SELECT q.o_orderkey, min({'gap': round(abs(cum_m - progress_m), 6), 'seq': seq}) AS v FROM q
        JOIN rc USING (o_custkey) GROUP BY q.o_orderkey)""",
              "SELECT o_orderkey, CAST(v.seq AS INT) AS vertex_seq FROM best"),
)
def nearest_vertex(spark, d):
    key = F.col("o_custkey").cast("string")
    asked = table(spark, d, "orders").select(
        "o_orderkey", key.alias("from_key"), F.concat(F.lit("end-"), key).alias("to_key"),
        (F.col("o_totalprice") / 10).alias("progress_m"),
    )
    found = roads.nearest_vertex(asked, roads.build_routes(routes(spark, d)), "progress_m")
    return found.select("o_orderkey", "vertex_seq")


@query(
    "enriched_places",
    duck_with(LINE, """SELECT record_seqnum, round(flat, 8) AS snapped_lat, round(flon, 8) AS snapped_lon,
      coalesce(placed, false) AS was_snapped FROM fi"""),
)
def enriched_places(spark, d):
    """The whole enrichment; with straight routes its fill pass has nothing left to place."""
    return _places(daily.enrich(telemetry(spark, d)))


# ---- publishing and manifest ----------------------------------------------------------------


@query(
    "union_by_name",
    "SELECT CAST(o_orderkey AS BIGINT) AS orderkey, o_totalprice AS price, NULL::DOUBLE AS quantity, 'orders' AS source_region FROM orders "
    "UNION ALL SELECT l_orderkey, NULL, l_quantity, 'lineitem' FROM lineitem",
)
def union_by_name(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"))
    b = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_quantity").alias("quantity"))
    return publish.union_regions({"orders": a, "lineitem": b})


@query(
    "union_by_position",
    "SELECT o_orderkey AS orderkey, o_totalprice AS price FROM orders UNION ALL SELECT l_orderkey, l_quantity FROM lineitem",
)
def union_by_position(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"))
    b = table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    return publish.union_by_position([a, b])


PUBLISHED = trips_sql(86400, f"""SELECT device_id, device_name, device_serial_number, lat AS position_latitude,
  lon AS position_longitude, round(position_speed, 4) AS position_speed, position_timestamp, record_seqnum, timestamp,
  round(distance_m, 4) AS distance_m, time_s, trip_id FROM trips WHERE {REGION_CASE} IS NOT NULL""")


@query("final_projection", PUBLISHED)
def final_projection(spark, d):
    rows = regions.region_rows(trips.trip_metrics(located(spark, d), DAY_GAP))
    trips_table = publish.publish(rows.withColumnRenamed("region", "source_region"))
    return trips_table.withColumns(
        {c: F.round(c, 4) for c in ("position_speed", "distance_m")}
    )


@query(
    "daily_summary",
    duck("SELECT count(*) AS total_rows, count(DISTINCT device_id) AS devices FROM telemetry"),
)
def daily_summary(spark, d):
    return publish.daily_summary(telemetry(spark, d))


def slices(spark: SparkSession, d: str) -> DataFrame:
    """A slice for every day of every event type."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("region"), F.col("ts").cast("date").alias("date")
    ).distinct()


SLICES = "SELECT DISTINCT event_type AS region, CAST(ts AS DATE) AS date FROM events"


def done(spark: SparkSession, d: str) -> DataFrame:
    """Slices with output: those of busy days only."""
    counts = table(spark, d, "events").groupBy(
        F.col("event_type").alias("region"), F.col("ts").cast("date").alias("date")
    ).agg(F.sum("value").alias("v"))
    return counts.filter("cast(v as bigint) % 5 <> 0").select("region", "date")


DONE_SQL = """SELECT event_type AS region, CAST(ts AS DATE) AS date FROM events GROUP BY ALL
  HAVING CAST(trunc(sum(value)) AS BIGINT) % 5 <> 0"""


def _text_days(df: DataFrame) -> DataFrame:
    return df.withColumn("date", dates.dash_day(F.col("date")))


@query(
    "unprocessed_days",
    f"SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM ({SLICES}) ANTI JOIN ({DONE_SQL}) USING (region, date)",
)
def unprocessed_days(spark, d):
    return _text_days(manifest.unprocessed_days(slices(spark, d), done(spark, d)))


@query("processable_days", f"SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM ({DONE_SQL})")
def processable_days(spark, d):
    return _text_days(manifest.processable_days(done(spark, d)))


@query("latest_days", f"SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM ({SLICES}) ORDER BY 1 DESC LIMIT 5")
def latest_days(spark, d):
    return _text_days(manifest.latest_days(slices(spark, d)))


@query(
    "expired_slices",
    f"SELECT region, strftime(date, '%Y-%m-%d') AS date FROM ({SLICES}) WHERE date < TIMESTAMP '2024-01-20 03:30:00' - INTERVAL 5 DAY",
)
def expired_slices(spark, d):
    return _text_days(manifest.expired_slices(slices(spark, d), datetime(2024, 1, 20, 3, 30), 5))


@query(
    "pending_rows",
    f"SELECT event_id FROM (SELECT event_id, event_type AS region, CAST(ts AS DATE) AS date FROM events) ANTI JOIN ({DONE_SQL}) USING (region, date)",
)
def pending_rows(spark, d):
    rows = table(spark, d, "events").withColumns(
        {"region": F.col("event_type"), "date": F.col("ts").cast("date")}
    )
    return manifest.pending_rows(rows, done(spark, d)).select("event_id")


SPELLED = """CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN strftime(o_orderdate, '%Y/%m%d')
  WHEN 4 THEN strftime(o_orderdate, '%Y/31/%d') ELSE o_orderpriority END"""


@query(
    "date_spellings",
    f"""SELECT o_orderkey, day IS NOT NULL AS is_day, strftime(day, '%Y/%m/%d') AS slash_day,
      strftime(day, '%Y-%m-%d') AS dash_day, strftime(day, '%Y%m%d') AS compact_day FROM
      (SELECT o_orderkey, CAST(CASE WHEN regexp_full_match(s, '[0-9]{{8}}') THEN try_strptime(s, '%Y%m%d') END AS DATE) AS day
       FROM (SELECT o_orderkey, replace(replace({SPELLED}, '/', ''), '-', '') AS s FROM orders))""",
)
def date_spellings(spark, d):
    text = F.expr(
        """CASE o_orderkey % 6 WHEN 0 THEN date_format(o_orderdate, 'yyyy/MM/dd')
        WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 2 THEN date_format(o_orderdate, 'yyyyMMdd')
        WHEN 3 THEN date_format(o_orderdate, 'yyyy/MMdd') WHEN 4 THEN date_format(o_orderdate, 'yyyy/31/dd')
        ELSE o_orderpriority END"""
    )
    day = dates.parse_day(F.col("_text"))
    return table(spark, d, "orders").withColumn("_text", text).select(
        "o_orderkey",
        dates.is_day(F.col("_text")).alias("is_day"),
        dates.slash_day(day).alias("slash_day"),
        dates.dash_day(day).alias("dash_day"),
        dates.compact_day(day).alias("compact_day"),
    )


# ---- sources and sinks ----------------------------------------------------------------------


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("date", dates.epoch_day(F.col("timestamp")))


@query(
    "json_projection",
    duck("""SELECT device_id, device_name, position_latitude, position_speed, CAST(record_seqnum AS DOUBLE) AS record_seqnum,
      CAST(timestamp AS DOUBLE) AS timestamp, CAST(NULL AS DOUBLE) AS battery_voltage,
      strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS date FROM telemetry"""),
)
def json_projection(spark, d):
    """Messages as JSON text, one unknown key in each, read with the message schema."""
    rows = with_day(telemetry(spark, d))
    dotted = {
        name: name.replace(".", "_")
        for name, _ in MESSAGE_FIELDS
        if name.replace(".", "_") in rows.columns
    }
    text = F.to_json(
        F.struct(*[F.col(c).alias(name) for name, c in dotted.items()], F.lit(1).alias("other.key"))
    )
    path = F.concat(F.lit("in/"), dates.slash_day(F.col("date")), F.lit("/m.json"))
    parsed = rows.select(
        F.from_json(text, messages.TEXT_SCHEMA).alias("_m"), path.alias("source_file")
    ).select("_m.*", "source_file")
    found = messages.to_telemetry(parsed)
    return found.select(
        "device_id", "device_name", "position_latitude", "position_speed", "record_seqnum",
        "timestamp", "battery_voltage", dates.dash_day(F.col("date")).alias("date"),
    )


ROUND_TRIP = duck("""SELECT device_id, device_name, device_serial_number, position_latitude, position_longitude,
  position_speed, CAST(record_seqnum AS DOUBLE) AS record_seqnum, CAST(timestamp AS DOUBLE) AS timestamp FROM telemetry""")


@query("csv_round_trip", ROUND_TRIP)
def csv_round_trip(spark, d):
    path = new_path(spark, "csv")
    sinks.write_days(with_day(telemetry(spark, d)), path)
    stored = tables.read_csv(spark, path)
    return stored.select(
        "device_id", "device_name", "device_serial_number", "position_latitude",
        "position_longitude", "position_speed", "record_seqnum", "timestamp",
    )


@query(
    "slice_round_trip",
    duck(f"""SELECT region, strftime(day, '%Y-%m-%d') AS date, count(*) AS rows, sum(record_seqnum) AS total FROM
      (SELECT {REGION_CASE} AS region, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day, record_seqnum FROM telemetry)
      WHERE region IS NOT NULL GROUP BY ALL"""),
)
def slice_round_trip(spark, d):
    path = new_path(spark, "slices")
    sinks.write_slices(regions.region_rows(with_day(telemetry(spark, d))), path)
    stored = tables.read_slices(spark, path)
    return _text_days(
        stored.groupBy("region", "date").agg(
            F.count("*").alias("rows"), F.sum("record_seqnum").alias("total")
        )
    )


@query(
    "slice_pruned",
    duck(f"""SELECT record_seqnum FROM telemetry WHERE {REGION_CASE} = 'wales'
      AND CAST(make_timestamp(timestamp * 1000000) AS DATE) = DATE '2024-01-15'"""),
)
def slice_pruned(spark, d):
    path = new_path(spark, "slices")
    sinks.write_slices(regions.region_rows(with_day(telemetry(spark, d))), path)
    return tables.read_slices(spark, path, "wales", date(2024, 1, 15)).select("record_seqnum")


@query(
    "manifest_of_slices",
    duck(f"""SELECT DISTINCT 'split' AS stage, {REGION_CASE} AS region,
      strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS date FROM telemetry WHERE {REGION_CASE} IS NOT NULL"""),
)
def manifest_of_slices(spark, d):
    path = new_path(spark, "slices")
    sinks.write_slices(regions.region_rows(with_day(telemetry(spark, d))), path)
    found = manifest.manifest(tables.list_files(spark, path, "*.parquet"), "split")
    return _text_days(found.select("stage", "region", "date").distinct())


@query(
    "written_counts",
    "SELECT * FROM (VALUES " + ", ".join(
        f"('{c}', (SELECT count({c}) FROM orders))"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    ) + ", ('*', (SELECT count(*) FROM orders))) AS t(\"column\", stored)",
)
def written_counts(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = new_path(spark, "orders")
    rows.write.parquet(path)
    found = sinks.compare_written(rows, spark.read.parquet(path))
    return found.filter("same").select("column", "stored")


# ---- streaming operators on a bounded table -------------------------------------------------


@query(
    "live_region_counts",
    duck(f"""SELECT strftime(day, '%Y-%m-%d') AS day, region, count(*) AS rows FROM
      (SELECT {REGION_CASE} AS region, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day FROM telemetry)
      WHERE region IS NOT NULL GROUP BY ALL"""),
)
def live_region_counts(spark, d):
    found = live.daily_region_counts(live.with_event_time(telemetry(spark, d)))
    # Window starts are instants; as Unix days they do not depend on the session's time zone.
    day = dates.epoch_day(F.unix_timestamp("day"))
    return found.select(dates.dash_day(day).alias("day"), "region", "rows")


@query(
    "live_trips",
    trips_sql(86400, """SELECT device_id, count(*) AS points, min(timestamp) AS started, max(timestamp) AS ended
      FROM trips GROUP BY device_id, trip_id"""),
)
def live_trips(spark, d):
    found = live.live_trips(live.with_event_time(telemetry(spark, d)), DAY_GAP)
    return found.select("device_id", "points", "started", "ended")


@query(
    "live_trips_without_devices",
    trips_sql(86400, """SELECT device_id, count(*) AS points, min(timestamp) AS started, max(timestamp) AS ended
      FROM trips WHERE device_id % 5 <> 0 GROUP BY device_id, trip_id"""),
)
def live_trips_without_devices(spark, d):
    known = F.when(F.col("device_id") % 5 != 0, F.col("device_id"))
    rows = telemetry(spark, d).withColumn("device_id", known)
    found = live.live_trips(live.with_event_time(rows), DAY_GAP)
    return found.select("device_id", "points", "started", "ended")


@query(
    "publish_slices_with_extras",
    duck(f"""SELECT record_seqnum, "ain.12" FROM
      (SELECT record_seqnum, {REGION_CASE} AS region, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day,
        CASE WHEN {REGION_CASE} = 'wales' THEN NULL ELSE position_speed END AS "ain.12"
       FROM telemetry) WHERE region IS NOT NULL AND day = DATE '2024-01-15'"""),
)
def publish_slices_with_extras(spark, d):
    path = new_path(spark, "enriched")
    rows = regions.region_rows(with_day(telemetry(spark, d)))
    rows = rows.withColumn("ain.12", F.col("position_speed"))
    rows = rows.withColumns({"snapped_lat": F.col("position_latitude"), "snapped_lon": F.col("position_longitude")})
    # One region's files lack the channel; they sort last, so their schema must not decide.
    sinks.write_slices(rows.filter("region <> 'wales'"), path)
    plain = rows.filter("region = 'wales'").drop("ain.12")
    sinks.write_slices(plain, path)
    out = new_path(spark, "published")
    daily.write_trips(spark, path, date(2024, 1, 15), out)
    return daily.read_trips(spark, out, date(2024, 1, 15)).select("record_seqnum", "`ain.12`")


@query(
    "pending_slices",
    duck(f"""SELECT DISTINCT region, strftime(day, '%Y-%m-%d') AS date FROM
      (SELECT {REGION_CASE} AS region, CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day FROM telemetry)
      WHERE region IS NOT NULL AND NOT (region = 'wales' AND day < DATE '2024-01-20')"""),
)
def pending_slices(spark, d):
    split, out = new_path(spark, "split"), new_path(spark, "done")
    rows = regions.region_rows(with_day(telemetry(spark, d)))
    sinks.write_slices(rows, split)
    sinks.write_slices(rows.filter("region = 'wales' and date < date'2024-01-20'").select("record_seqnum", "region", "date"), out)
    return _text_days(daily.pending_slices(spark, split, out).select("region", "date"))


@query(
    "rejected_messages",
    duck("""SELECT count(*) AS files, count(*) FILTER (n % 3 = 0) AS failed, count(*) FILTER (n % 3 <> 0) AS timestamped,
      count(*) FILTER (n % 3 = 0) AS stored, sum("ain.12") FILTER (n % 3 <> 0) AS channel FROM
      (SELECT CAST(make_timestamp(timestamp * 1000000) AS DATE) AS day, count(*) AS n, max(record_seqnum) AS "ain.12"
       FROM telemetry GROUP BY ALL)"""),
)
def rejected_messages(spark, d):
    # One message file for each day of the table; a third of them are cut off.
    day = F.date_format("date", "yyyy/MM/dd")
    by_day = with_day(telemetry(spark, d)).groupBy(day.alias("folder")).agg(
        F.count("*").alias("n"), F.max("record_seqnum").alias("seq"), F.max("timestamp").alias("at")
    )
    whole = F.to_json(F.struct(F.col("seq").alias("ain.12"), F.col("at").alias("timestamp")))
    text = F.when(F.col("n") % 3 == 0, F.substring(whole, F.lit(1), F.length(whole) - 3)).otherwise(whole)
    inbox, out, rejects = (new_path(spark, p) for p in ("inbox", "converted", "rejects"))
    parts = F.split("folder", "/")
    named = by_day.select(text.alias("value"), *[parts[i].alias(n) for i, n in enumerate(("y", "m", "d"))])
    named.repartition("y", "m", "d").write.partitionBy("y", "m", "d").option("compression", "none").text(inbox)
    found = messages.decoded(
        spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(inbox),
        ["ain.12"],
    )
    found = found.withColumn("source_file", F.regexp_replace("source_file", "/(y|m|d)=", "/"))
    totals = daily.store_messages(found, out, rejects, ["ain.12"])
    stored = spark.read.parquet(rejects).agg(F.count("*").alias("stored"))
    channel = tables.read_csv(spark, out).agg(F.sum("`ain.12`").cast("long").alias("channel"))
    rows = totals.unionByName(stored, allowMissingColumns=True).unionByName(channel, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in ("files", "failed", "timestamped", "stored", "channel")])
