"""Enrichment with roads and routes, road lines, and ellipsoidal routes, with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.checks.event_queries import haversine_sql
from velotrace.checks.telemetry_queries import (
    DAY_GAP,
    ORDER,
    PROGRESS,
    SNAPPED,
    SPREAD,
    _places,
    duck_with,
    snapped,
    trips_sql,
)
from velotrace.checks.views import duck, road_points, table, telemetry
from velotrace.operators import roads, segments
from velotrace.operators.ordered import ordered
from velotrace.plans import daily
from velotrace.schemas import TIME_ORDER
from velotrace.settings import Settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


# ---- routes ---------------------------------------------------------------------------------

KEY = "CAST(CAST(round({0}.lat * 1000000) AS BIGINT) AS STRING) || ':' || CAST(CAST(round({0}.lon * 1000000) AS BIGINT) AS STRING)"

# A route for most gaps of the telemetry, of 2 to 10 vertices that lie beside the straight line.
# The same text runs in both engines, but for how whole numbers are listed.
GAP_ROUTES = """
SELECT from_key, to_key, i AS seq, flat + (tlat - flat) * i / (n - 1) + i * (n - 1 - i) * (10 + i) * 0.00001 AS lat,
  flon + (tlon - flon) * i / (n - 1) AS lon
FROM (SELECT *, {numbers} AS i FROM (
  SELECT DISTINCT from_key, to_key, flat, flon, tlat, tlon, 2 + h % 9 AS n FROM (
    SELECT {from_key} AS from_key, {to_key} AS to_key, f.lat AS flat, f.lon AS flon, t.lat AS tlat, t.lon AS tlon,
      CAST(round(f.lat * 10000) + round(t.lon * 10000) AS BIGINT) AS h FROM {gaps}) x
  WHERE h % 5 <> 0) y) z
"""


def gap_routes_table(spark: SparkSession, d: str) -> DataFrame:
    """Vertices of the routes between the known points around the gaps of the telemetry."""
    rows = roads.gap_bounds(ordered(snapped(spark, d), ["device_id"], TIME_ORDER)).done()
    gaps = rows.filter(roads.in_gap()).select(F.col("_from").alias("f"), F.col("_to").alias("t"))
    text = GAP_ROUTES.format(
        numbers="explode(sequence(0L, n - 1))", from_key=KEY.format("f"), to_key=KEY.format("t"), gaps="{gaps}"
    )
    return roads.build_routes(spark.sql(text, gaps=gaps))


ROUTED = ", rt AS (" + GAP_ROUTES.format(
    numbers="unnest(range(n))", from_key=KEY.format("f"), to_key=KEY.format("t"),
    gaps="(SELECT f, t FROM gp WHERE slat IS NULL AND f IS NOT NULL AND t IS NOT NULL)",
) + """), lg AS (SELECT *, coalesce(CAST(round(1000000000 * """ + haversine_sql(
    "lag(lat) OVER w", "lag(lon) OVER w", "lat", "lon"
) + """) AS BIGINT), 0) AS leg FROM rt WINDOW w AS (PARTITION BY from_key, to_key ORDER BY seq)),
  vx AS (SELECT *, sum(leg) OVER (PARTITION BY from_key, to_key ORDER BY seq) / 1000000000 AS cum FROM lg),
  rs_ AS (SELECT from_key, to_key, count(*) AS n, max(cum) AS total FROM vx GROUP BY ALL)"""  # fmt: skip

# The vertex whose distance along the route is nearest to a row's progress.
ALONG = PROGRESS + ROUTED + f""", ak AS (SELECT record_seqnum, {KEY.format("f")} AS from_key,
    {KEY.format("t")} AS to_key, share, moved FROM pr WHERE gap),
  pg AS (SELECT *, least(total, total * share + moved) AS progress FROM ak JOIN rs_ USING (from_key, to_key)
    WHERE n >= 2 AND total > 0),
  nv AS (SELECT record_seqnum, min({{'gap': round(abs(cum - progress), 6), 'seq': seq, 'lat': lat, 'lon': lon}}) AS v
    FROM pg JOIN vx USING (from_key, to_key) GROUP BY record_seqnum),
  placed AS (SELECT sn.*, coalesce(v.lat, slat) AS flat, coalesce(v.lon, slon) AS flon, v IS NOT NULL AS new
    FROM sn LEFT JOIN nv USING (record_seqnum))"""


@query(
    "gap_routes",
    duck_with(ALONG, """SELECT record_seqnum, round(flat, 8) AS snapped_lat, round(flon, 8) AS snapped_lon,
      new AS was_snapped FROM placed"""),
)
def gap_routes(spark, d):
    """Gaps filled by progress along their routes; some routes are missing."""
    return _places(roads.interpolate_gaps(snapped(spark, d), routes=gap_routes_table(spark, d)))


SPREAD_OVER = SNAPPED + ROUTED + f""", k AS (SELECT *, rn - f.rn - 1 AS k, t.rn - f.rn - 1 AS m,
    {KEY.format("f")} AS from_key, {KEY.format("t")} AS to_key FROM gp
    WHERE slat IS NULL AND f IS NOT NULL AND t IS NOT NULL),
  i AS (SELECT record_seqnum, from_key, to_key, CAST({SPREAD} AS BIGINT) AS seq FROM k JOIN rs_ USING (from_key, to_key)),
  v AS (SELECT record_seqnum, lat, lon FROM i JOIN vx USING (from_key, to_key, seq))"""


@query(
    "fill_routes",
    duck_with(SPREAD_OVER, """SELECT record_seqnum, round(coalesce(v.lat, slat), 8) AS snapped_lat,
      round(coalesce(v.lon, slon), 8) AS snapped_lon, v.lat IS NOT NULL AS was_snapped
      FROM sn LEFT JOIN v USING (record_seqnum)"""),
)
def fill_routes(spark, d):
    """Gaps filled by spreading the vertices of their routes; some have fewer vertices than rows."""
    return _places(roads.fill_missing(snapped(spark, d), routes=gap_routes_table(spark, d)))


MEASURED = """SELECT record_seqnum, round(lat, 8) AS snapped_lat, round(lon, 8) AS snapped_lon, was_snapped,
  round(distance_m, 4) AS distance_m, time_s, trip_break, round(position_speed, 4) AS position_speed FROM trips"""


def _measured(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("record_seqnum").cast("long").alias("record_seqnum"),
        F.round("snapped_lat", 8).alias("snapped_lat"),
        F.round("snapped_lon", 8).alias("snapped_lon"),
        "was_snapped",
        F.round("distance_m", 4).alias("distance_m"),
        "time_s",
        "trip_break",
        F.round("position_speed", 4).alias("position_speed"),
    )


@query(
    "enriched_routes",
    trips_sql(
        86400, MEASURED, source="(SELECT *, flat AS lat, flon AS lon, new AS was_snapped FROM placed)", before=ALONG + ","
    ),
)
def enriched_routes(spark, d):
    """The whole enrichment with routes; gaps without one stay unknown."""
    return _measured(daily.enrich(telemetry(spark, d), DAY_GAP, routes=gap_routes_table(spark, d)))


# ---- roads ----------------------------------------------------------------------------------

NEAR_ROADS = """(SELECT * FROM (SELECT p.lat, p.lon, min({{'m': """ + haversine_sql("p.lat", "p.lon", "r.lat", "r.lon").replace(
    "{", "{{"
).replace("}", "}}") + """, 'lat': r.lat, 'lon': r.lon}}) AS best FROM {places} p JOIN road r
    ON r.lat BETWEEN p.lat - 0.001 AND p.lat + 0.001 AND r.lon BETWEEN p.lon - 0.0016 AND p.lon + 0.0016
  GROUP BY p.lat, p.lon) WHERE best.m <= 100)"""

# Positions go to roads, gaps along straight lines to roads, and what is left onto the lines.
ON_ROADS = (
    SNAPPED.replace(" AS p FROM sn)", " AS p FROM so)")
    .replace("""CASE WHEN position_latitude <> 0 AND position_longitude <> 0 THEN position_latitude END AS slat,
    CASE WHEN position_latitude <> 0 AND position_longitude <> 0 THEN position_longitude END AS slon,""", "")
    .replace(
        "pt AS (",
        f"""nr AS {NEAR_ROADS.format(places="(SELECT DISTINCT position_latitude AS lat, position_longitude AS lon FROM blank WHERE position_latitude <> 0 AND position_longitude <> 0)")},
  so AS (SELECT sn.*, CASE WHEN position_latitude <> 0 AND position_longitude <> 0 THEN coalesce(best.lat, position_latitude) END AS slat,
    CASE WHEN position_latitude <> 0 AND position_longitude <> 0 THEN coalesce(best.lon, position_longitude) END AS slon,
    best IS NOT NULL AS hit FROM sn LEFT JOIN nr ON position_latitude = nr.lat AND position_longitude = nr.lon),
  pt AS (""",
    )
)
LINES_ON_ROADS = PROGRESS.replace(SNAPPED, ON_ROADS) + ", ln AS (SELECT *, CASE WHEN gap THEN " + haversine_sql(
    "f.lat", "f.lon", "t.lat", "t.lon"
) + f""" END AS metres FROM pr),
  ix AS (SELECT *, CASE WHEN gap AND metres > 0 THEN ceil(least(1.0, share + moved / metres) * 10 - 0.5) END AS i FROM ln),
  vt AS (SELECT *, f.lat + (t.lat - f.lat) * i / 10 AS vlat, f.lon + (t.lon - f.lon) * i / 10 AS vlon FROM ix),
  nx AS {NEAR_ROADS.format(places="(SELECT DISTINCT vlat AS lat, vlon AS lon FROM vt WHERE vlat IS NOT NULL)")},
  one AS (SELECT vt.* EXCLUDE (f, t, gap, i, slat, slon, hit, p), coalesce(slat, best.lat) AS slat, coalesce(slon, best.lon) AS slon,
    hit OR (gap AND best IS NOT NULL) AS hit FROM vt LEFT JOIN nx ON vlat = nx.lat AND vlon = nx.lon),
  po AS (SELECT *, CASE WHEN slat IS NOT NULL THEN {{'rn': rn, 'lat': slat, 'lon': slon}} END AS p FROM one),
  g2 AS (SELECT *, last_value(p IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY {ORDER}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f,
    first_value(p IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY {ORDER}
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t FROM po),
  k AS (SELECT *, slat IS NULL AND f IS NOT NULL AND t IS NOT NULL AS gap,
    rn - f.rn - 1 AS k, t.rn - f.rn - 1 AS m, 11 AS n FROM g2),
  i AS (SELECT *, {SPREAD} AS i FROM k),
  two AS (SELECT * EXCLUDE (n, f, t, k, m, i, p, gap), CASE WHEN gap THEN f.lat + (t.lat - f.lat) * i / 10 ELSE slat END AS lat,
    CASE WHEN gap THEN f.lon + (t.lon - f.lon) * i / 10 ELSE slon END AS lon, hit OR gap AS was_snapped FROM i)"""


@query("enriched_roads", trips_sql(86400, MEASURED, source="two", before=LINES_ON_ROADS + ","))
def enriched_roads(spark, d):
    """The whole enrichment with roads near enough: positions, gaps, and what gaps leave over."""
    near = Settings(trip_gap_s=DAY_GAP.trip_gap_s, snap_radius_m=100.0)
    return _measured(daily.enrich(telemetry(spark, d), near, road_points(spark, d)))


# ---- road lines -----------------------------------------------------------------------------

# One road through the orders of each customer, and a place for each customer.
LINE_SQL = """
SELECT o_custkey AS road_id, o_orderkey AS seq,
  CAST(51 AS DOUBLE) + ((o_custkey * 31) % 997) / CAST(10000 AS DOUBLE) + ((o_orderkey * 7) % 41) / CAST(20000 AS DOUBLE) AS lat,
  CAST(-0.5 AS DOUBLE) + ((o_custkey * 57) % 991) / CAST(10000 AS DOUBLE) + ((o_orderkey * 13) % 37) / CAST(9000 AS DOUBLE) AS lon
FROM orders
"""
PLACE_SQL = """
SELECT c_custkey, CAST(51 AS DOUBLE) + ((c_custkey * 7919) % 10007) / CAST(100000 AS DOUBLE) AS lat,
  CAST(-0.5 AS DOUBLE) + ((c_custkey * 6841) % 10009) / CAST(100000 AS DOUBLE) AS lon
FROM customer
"""

FOOT = """sg AS (SELECT road_id, seq, lag(lat) OVER w AS a, lag(lon) OVER w AS b, lat AS c, lon AS d FROM lines
    WINDOW w AS (PARTITION BY road_id ORDER BY seq)),
  sx AS (SELECT * FROM sg WHERE a IS NOT NULL UNION ALL BY NAME SELECT road_id, min(seq) AS seq, min(lat) AS a, min(lon) AS b,
    min(lat) AS c, min(lon) AS d FROM lines GROUP BY road_id HAVING count(*) = 1),
  pj AS (SELECT c_custkey, lat, lon, a, b, d - b AS dy, c - a AS dx, cos(radians(lat)) AS s FROM places, sx),
  sh AS (SELECT *, CASE WHEN dy * s * dy * s + dx * dx > 0 THEN
    greatest(0.0, least(1.0, -((b - lon) * s * dy * s + (a - lat) * dx) / (dy * s * dy * s + dx * dx))) ELSE 0.0 END AS t FROM pj),
  ft AS (SELECT c_custkey, lat, lon, a + dx * t AS near_lat, b + dy * t AS near_lon FROM sh),
  be AS (SELECT c_custkey, min({'m': """ + haversine_sql("lat", "lon", "near_lat", "near_lon") + """,
    'lat': near_lat, 'lon': near_lon}) AS best FROM ft GROUP BY c_custkey)"""


@query(
    "nearest_on_roads",
    "WITH lines AS (" + LINE_SQL + "), places AS (" + PLACE_SQL + "), " + FOOT + """
      SELECT c_custkey, round(best.m, 3) AS near_m, round(best.lat, 7) AS near_lat, round(best.lon, 7) AS near_lon FROM be""",
)
def nearest_on_roads(spark, d):
    """The nearest place on any road line; lines are longer than the cells of the index."""
    lines = spark.sql(LINE_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, d, "orders"))
    places = spark.sql(PLACE_SQL.replace("FROM customer", "FROM {customer}"), customer=table(spark, d, "customer"))
    found = segments.nearest_on_roads(places, segments.segment_index(lines))
    return places.join(found, ["lat", "lon"]).select(
        "c_custkey", F.round("near_m", 3).alias("near_m"), F.round("near_lat", 7).alias("near_lat"),
        F.round("near_lon", 7).alias("near_lon"),
    )
