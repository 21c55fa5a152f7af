"""Road matching: snapping positions, and filling gaps along routes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.functions.geo import EARTH_RADIUS_M, geodesic, haversine, kmh_to_ms, point_key
from velotrace.operators.clean import LAT, LON, can_snap
from velotrace.operators.joins import lookup
from velotrace.operators.ordered import (
    Series,
    first_after,
    last_before,
    numbered,
    ordered,
    previous,
    row_count,
    running_sum,
    scan,
)
from velotrace.operators.segments import SegmentIndex, nearest_on_roads
from velotrace.operators.spatial import PlaceIndex, index_places, nearest
from velotrace.schemas import DEVICE, TIME_ORDER
from velotrace.session import written
from velotrace.settings import Settings

ROUTE = ["from_key", "to_key"]


FIRST_RADIUS_M = 100.0


@dataclass(frozen=True)
class Roads:
    """Road points with an index for the first search, which wider searches widen."""

    index: PlaceIndex
    limit_m: float | None
    settings: Settings


def road_index(road_points: DataFrame, settings: Settings = Settings()) -> Roads:
    radius = FIRST_RADIUS_M if settings.snap_radius_m is None else settings.snap_radius_m
    index = index_places(road_points.select("lat", "lon"), radius, (), settings)
    return Roads(index, settings.snap_radius_m, settings)


def nearest_roads(places: DataFrame, roads: Roads | SegmentIndex) -> DataFrame:
    """The nearest road point of each place, as ``nearest`` gives it, or place on a road line.

    Without a limit, places that find none are searched again in a circle eight times as wide,
    until all have one or the circle is the globe.
    """
    if isinstance(roads, SegmentIndex):
        return nearest_on_roads(places, roads)
    found = written(nearest(places, roads.index), "snapped")
    if roads.limit_m is not None or roads.index.places.isEmpty():
        return found
    parts, radius = [found], roads.index.grid.radius_m
    places = places.filter("lat is not null and lon is not null")
    while True:
        places = written(places.join(found, ["lat", "lon"], "left_anti"), "unsnapped")
        if places.isEmpty() or radius > pi * EARTH_RADIUS_M:
            return reduce(DataFrame.unionByName, parts)
        radius = radius * 8
        found = written(nearest(places, roads.index.wider(radius)), "snapped")
        parts.append(found)


def snap(
    df: DataFrame, roads: Roads | SegmentIndex | None, settings: Settings = Settings()
) -> DataFrame:
    """Fill ``snapped_lat``, ``snapped_lon`` and ``was_snapped`` on rows with valid coordinates.

    A row takes the nearest road point, or with a ``segment_index`` the nearest place on a road,
    within the radius if there is one, or else keeps its own coordinates. Each distinct pair of coordinates is matched once.
    """
    valid = can_snap()
    df = df.drop("snapped_lat", "snapped_lon", "was_snapped")
    if roads is None:
        return df.withColumns(
            {
                "snapped_lat": F.when(valid, F.col(LAT)),
                "snapped_lon": F.when(valid, F.col(LON)),
                "was_snapped": F.lit(False),
            }
        )
    places = df.filter(valid).select(F.col(LAT).alias("lat"), F.col(LON).alias("lon")).distinct()
    found = nearest_roads(places, roads).select(
        F.col("lat").alias(LAT), F.col("lon").alias(LON), "near_lat", "near_lon"
    )
    hit = F.col("near_lat").isNotNull()
    return (
        lookup(df, found, [LAT, LON], settings)
        .withColumns(
            {
                "snapped_lat": F.when(valid, F.coalesce("near_lat", LAT)),
                "snapped_lon": F.when(valid, F.coalesce("near_lon", LON)),
                "was_snapped": valid & hit,
            }
        )
        .drop("near_lat", "near_lon")
    )


def build_routes(vertices: DataFrame, settings: Settings = Settings(), ellipsoid: bool = False) -> DataFrame:
    """Route vertices numbered from 0, with the distance along the route up to each.

    ``vertices(from_key, to_key, seq, lat, lon)``; distances are great-circle, which differs
    from the ellipsoid by less than 0.6 percent, or with ``ellipsoid`` those of the ellipsoid.
    Legs are summed as whole nanometres, so a length does not depend on how a route is split.
    Vertices and routes are written once, since both are read several times.
    """
    vertices = written(vertices, "route-vertices")
    series = scan(
        ordered(vertices, ROUTE, ["seq"], settings),
        _prev=previous(F.struct("lat", "lon")),
        _nth=row_count(),
    )
    measure = geodesic if ellipsoid else haversine
    leg = measure(F.col("_prev.lat"), F.col("_prev.lon"), F.col("lat"), F.col("lon"))
    leg_nm = F.coalesce(F.round(leg * 1e9).cast("long"), F.lit(0).cast("long"))
    series = series.map(lambda d: d.withColumn("_leg", leg_nm))
    routes = (
        scan(series, _nm=running_sum(F.col("_leg")))
        .done()
        .withColumns({"seq": (F.col("_nth") - 1).cast("int"), "cum_m": F.col("_nm") / 1e9})
        .select(*ROUTE, "seq", "lat", "lon", "cum_m")
    )
    return written(routes, "routes")


def route_summary(routes: DataFrame) -> DataFrame:
    """Vertices and length of each route."""
    return routes.groupBy(*ROUTE).agg(
        F.count("*").alias("vertices"), F.max("cum_m").alias("total_m")
    )


def nearest_vertex(
    rows: DataFrame, routes: DataFrame, progress: str, settings: Settings = Settings()
) -> DataFrame:
    """The vertex of each row's route whose distance along it is closest to ``progress``.

    Rows carry ``from_key`` and ``to_key``; ``vertex_seq``, ``vertex_lat`` and ``vertex_lon`` are
    added. Of two vertices equally close the earlier one is taken. Rows and vertices are merged
    in one ordered series per route, so routes may be of any length.
    """
    distinct = routes.groupBy(*ROUTE, "cum_m").agg(
        F.min(F.struct("seq", "lat", "lon")).alias("_v")
    )
    marks = distinct.select(
        *ROUTE,
        F.col("cum_m").alias("_m"),
        F.lit(0).alias("_kind"),
        F.struct("cum_m", "_v.seq", "_v.lat", "_v.lon").alias("_vertex"),
    )
    asked = rows.select(
        *ROUTE, F.col(progress).alias("_m"), F.lit(1).alias("_kind"), F.struct("*").alias("_asked")
    )
    series = scan(
        ordered(
            marks.unionByName(asked, allowMissingColumns=True), ROUTE, ["_m", "_kind"], settings
        ),
        _under=last_before(F.col("_vertex")),
        _over=first_after(F.col("_vertex")),
    )
    m = F.col("_m")
    take_under = F.col("_over").isNull() | (
        m - F.col("_under.cum_m") <= F.col("_over.cum_m") - m
    )
    chosen = F.when(F.col("_under").isNotNull() & take_under, F.col("_under")).otherwise(
        F.col("_over")
    )
    return (
        series.done()
        .filter((F.col("_kind") == 1) & m.isNotNull())
        .withColumn("_chosen", chosen)
        .select(
            "_asked.*",
            F.col("_chosen.seq").alias("vertex_seq"),
            F.col("_chosen.lat").alias("vertex_lat"),
            F.col("_chosen.lon").alias("vertex_lon"),
        )
    )


def gap_bounds(series: Series) -> Series:
    """Add ``_at``, the row's position, and ``_from`` and ``_to``, the known points around it."""
    known = F.col("snapped_lat").isNotNull() & F.col("snapped_lon").isNotNull()
    if series.order != ("_at",):
        series = numbered(series, "_at")
    point = F.when(
        known,
        F.struct("_at", F.col("snapped_lat").alias("lat"), F.col("snapped_lon").alias("lon")),
    )
    series = scan(series, _to=first_after(point))
    return scan(series, _from=last_before(point))


def in_gap() -> Column:
    """An unknown row with known points on both sides."""
    unknown = F.col("snapped_lat").isNull() | F.col("snapped_lon").isNull()
    return (
        unknown
        & F.col("_from").isNotNull()
        & F.col("_to").isNotNull()
        & F.col(DEVICE).isNotNull()
    )


def gap_progress(series: Series) -> Series:
    """How far along its gap's route each unknown row is.

    A row with a speed and a positive ``time_diff`` moves on from the row before by that
    distance; any other row is put at its share of the gap's rows. Adds ``_share`` of the route
    and ``_moved_m`` beyond it. Steps are summed as whole micrometres, which is exact in any
    grouping; negative speeds count as 0.
    """
    share = (F.col("_at") - F.col("_from._at")) / (F.col("_to._at") - F.col("_from._at"))
    moves = F.coalesce(
        F.col("position_speed").isNotNull() & (F.col("time_diff") > 0), F.lit(False)
    )
    step = F.greatest(kmh_to_ms(F.col("position_speed")), F.lit(0.0)) * F.col("time_diff")
    step_um = F.when(in_gap() & moves, F.round(step * 1_000_000).cast("long")).otherwise(
        F.lit(0).cast("long")
    )
    series = scan(series, _path=running_sum(step_um))
    # Progress counts from the last known row or the last row that was put at its share.
    start = F.when(
        ~in_gap() | ~moves,
        F.struct("_path", F.when(in_gap(), share).otherwise(0.0).alias("share")),
    )
    series = scan(series, _start=last_before(start))

    def progress(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "_share": F.when(
                    in_gap(), F.when(moves, F.col("_start.share")).otherwise(share)
                ),
                "_moved_m": F.when(
                    in_gap(),
                    F.when(moves, (F.col("_path") - F.col("_start._path")) / 1_000_000).otherwise(
                        0.0
                    ),
                ),
            }
        )

    return series.map(progress)


def _line_vertex(index: Column, last: int) -> tuple[Column, Column]:
    """A vertex of the straight line between the known points around a row."""
    return tuple(
        F.col(f"_from.{c}") + (F.col(f"_to.{c}") - F.col(f"_from.{c}")) * index / last
        for c in ("lat", "lon")
    )


def _line_length() -> Column:
    return haversine(F.col("_from.lat"), F.col("_from.lon"), F.col("_to.lat"), F.col("_to.lon"))


def _with_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "from_key": point_key(F.col("_from.lat"), F.col("_from.lon")),
            "to_key": point_key(F.col("_to.lat"), F.col("_to.lon")),
        }
    )



def interpolate_gaps(
    df: DataFrame,
    settings: Settings = Settings(),
    routes: DataFrame | None = None,
    roads: Roads | SegmentIndex | None = None,
    within: Sequence[str] = (),
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Place unknown rows on the route between the known points around them, by progress.

    A row takes a vertex of the route, never a point between two. The vertex is then snapped; if
    no road is near, the row stays unknown. ``routes`` holds vertices from ``build_routes``; a
    gap without a route, or with one of fewer than two vertices or no length, is left alone.
    Without any ``routes`` a straight line of ``line_points`` vertices is used, evenly spaced by
    distance, and without ``roads`` vertices are taken as they are. Gaps do not span devices.
    """
    series = ordered(df, [*within, DEVICE], TIME_ORDER, settings, sizes)
    if routes is None:
        return interpolate_lines(series, settings, roads).done().select(*df.columns)

    # The rows in gaps and the others part here, and joins count before they join.
    rows = written(gap_progress(gap_bounds(series)).done(), "gap-progress")
    gap = in_gap()
    asked = lookup(
        _with_keys(rows.filter(gap)), written(route_summary(routes), "route-sizes"), ROUTE, settings
    )
    usable = F.coalesce((F.col("vertices") >= 2) & (F.col("total_m") > 0), F.lit(False))
    asked = written(
        asked.withColumn(
            "_progress",
            F.least(F.col("total_m"), F.col("total_m") * F.col("_share") + F.col("_moved_m")),
        ),
        "gap-rows",
    )
    rows = (
        nearest_vertex(asked.filter(usable), routes, "_progress", settings)
        .unionByName(asked.filter(~usable), allowMissingColumns=True)
        .unionByName(rows.filter(~gap), allowMissingColumns=True)
    )
    place = _snapped_vertices(rows, roads, settings)
    return place(rows).select(*df.columns)


def interpolate_lines(
    series: Series, settings: Settings = Settings(), roads: Roads | SegmentIndex | None = None
) -> Series:
    """``interpolate_gaps`` along straight lines, on the rows of each device."""
    last = settings.line_points - 1
    length = _line_length()
    spot = F.least(F.lit(1.0), F.col("_share") + F.col("_moved_m") / length)
    lat, lon = _line_vertex(F.ceil(spot * last - 0.5), last)
    usable = in_gap() & (length > 0)
    series = gap_progress(gap_bounds(series)).map(
        lambda d: d.withColumns(
            {"vertex_lat": F.when(usable, lat), "vertex_lon": F.when(usable, lon)}
        )
    )
    place = _snapped_vertices(series.rows, roads, settings)
    return series.map(lambda d: place(d).drop(*_GAP_HELPERS))


_GAP_HELPERS = [
    "_from", "_to", "_path", "_start", "_share", "_moved_m",
    "vertex_lat", "vertex_lon", "near_lat", "near_lon",
]


def _snapped_vertices(
    rows: DataFrame, roads: Roads | SegmentIndex | None, settings: Settings
) -> Callable[[DataFrame], DataFrame]:
    """How to put rows on their vertices: as they are, or on the nearest road."""
    if roads is None:
        return lambda d: _placed(d, F.col("vertex_lat"), F.col("vertex_lon"))
    vertices = rows.filter(F.col("vertex_lat").isNotNull()).select(
        F.col("vertex_lat").alias("lat"), F.col("vertex_lon").alias("lon")
    )
    found = written(nearest_roads(vertices.distinct(), roads), "snapped-vertices").select(
        F.col("lat").alias("vertex_lat"),
        F.col("lon").alias("vertex_lon"),
        "near_lat",
        "near_lon",
    )
    return lambda d: _placed(
        lookup(d, found, ["vertex_lat", "vertex_lon"], settings), F.col("near_lat"), F.col("near_lon")
    )


def _placed(rows: DataFrame, lat: Column, lon: Column) -> DataFrame:
    new = in_gap() & lat.isNotNull()
    return rows.withColumns(
        {
            "snapped_lat": F.when(new, lat).otherwise(F.col("snapped_lat")),
            "snapped_lon": F.when(new, lon).otherwise(F.col("snapped_lon")),
            "was_snapped": new | F.col("was_snapped"),
        }
    )


def spread_index(k: Column, missing: Column, vertices: Column) -> Column:
    """The vertex for the k-th (from 0) of ``missing`` rows on a route.

    Inner vertices are spread evenly if there are enough of them; otherwise each is used once
    and the one before the last is repeated.
    """
    step = (vertices - 3) / F.greatest(missing - 1, F.lit(1))
    even = F.when((k == missing - 1) & (missing > 1), vertices - 2).otherwise(
        F.floor(k * step + 1)
    )
    return F.when(missing <= vertices - 2, even).otherwise(F.least(k + 1, vertices - 2)).cast("int")


def fill_missing(
    df: DataFrame,
    settings: Settings = Settings(),
    routes: DataFrame | None = None,
    within: Sequence[str] = (),
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Spread the vertices of the route over rows that are still unknown between known ones.

    Rows before a device's first known row or after its last stay unknown, as do rows of a gap
    without a route.
    """
    series = ordered(df, [*within, DEVICE], TIME_ORDER, settings, sizes)
    if routes is None:
        return fill_lines(series, settings).done().select(*df.columns)

    rows = written(gap_bounds(series).done(), "gap-bounds")
    k, missing = _run()
    gap = in_gap()
    asked = lookup(
        _with_keys(rows.filter(gap)), written(route_summary(routes), "route-sizes"), ROUTE, settings
    )
    asked = written(
        asked.withColumn(
            "vertex_seq",
            F.when(F.col("vertices") >= 2, spread_index(k, missing, F.col("vertices"))),
        ),
        "missing-rows",
    )
    table = routes.select(
        *ROUTE,
        F.col("seq").alias("vertex_seq"),
        F.col("lat").alias("vertex_lat"),
        F.col("lon").alias("vertex_lon"),
    )
    found = lookup(asked, table, [*ROUTE, "vertex_seq"], settings)
    filled = _placed(found, F.col("vertex_lat"), F.col("vertex_lon"))
    return filled.select(*df.columns).unionByName(rows.filter(~gap).select(*df.columns))


def _run() -> tuple[Column, Column]:
    """A row's place, from 0, among the unknown rows of its gap, and their number."""
    before = F.col("_from._at")
    return F.col("_at") - before - 1, F.col("_to._at") - before - 1


def fill_lines(series: Series, settings: Settings = Settings()) -> Series:
    """``fill_missing`` along straight lines, on the rows of each device."""
    k, missing = _run()
    index = spread_index(k, missing, F.lit(settings.line_points))
    lat, lon = _line_vertex(index, settings.line_points - 1)
    return gap_bounds(series).map(lambda d: _placed(d, lat, lon).drop(*_GAP_HELPERS))
