"""The nearest place on a road, where roads are lines and not points.

A segment is cut at the rows of a latitude grid, and each piece is listed under the cells of its
row that it crosses, so a long segment is found from every cell it passes through. The cells are so
small that none holds more than ``cell_points`` pieces, unless segments would be cut into too many
pieces for that: where many long segments cross, smaller cells add more pieces than they spare looks.

Pieces are never stored nor shuffled, as they may be many times the segments. Segments and positions
are dealt to tiles of 64 by 64 cells, or 8 by 8 where segments are fewer, and cut within them by the
tasks that join them. Tiles with many segments or positions are parted.

A position looks for pieces within the width of one cell: first among a few segments, which bound
the distance, then within the bound among more, and at last among all. What it finds within that
distance is nearest of all, since any nearer place would be in the same cells. Eight by eight cells
make a cell of the next level, which knows one of the segments that cross it, up to cells of which
a few cover the globe. Positions that find nothing look at wider and wider cells, whose segments
bound the distance; then they go down again, level by level, into the cells that can hold something
nearer than the bound, and at last to their pieces.

The nearest place on a segment is found in the plane with longitudes shortened by the cosine of the
position's latitude, and its distance is great-circle. Of equally near segments the one with the
lowest road and number is taken. Segments may cross the 180th meridian.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from math import ceil, degrees, floor, log, pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrace.functions.geo import EARTH_RADIUS_M, haversine
from velotrace.operators.joins import small_side
from velotrace.operators.ordered import ordered, previous, scan, series_size
from velotrace.session import written, written_alone
from velotrace.settings import Settings

FIRST_CELL_M = 100.0
LEAST_CELL_M = 1.0
WIDER = 8
# One of so many segments gives bounds, time after time, where that leaves segments enough.
ONE_OF = (64, 8)
ENOUGH = 1_000
# About so many segments tell how wide cells should be.
TELLING = 1_000_000
# Tiles are cells of this level, if there is one, or of the lower one where fewer segments make few tiles.
TILE = 2
MANY = 1_000_000
# Tiles are dealt to no more partitions than one job can handle.
MOST_PARTS = 20_000
# Joins whose sides are dealt by one of their keys are not shuffled again by all of them.
DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
# As far as this, and not near the poles, the plane is near enough to the globe to leave segments out.
FLAT_M = 1000.0
ENDS = ["lat1", "lon1", "lat2", "lon2"]
SEGMENT = ["road_id", "seq", *ENDS]


@dataclass(frozen=True)
class Grid:
    """Rows of latitude, each cut into whole cells about as wide as the row is high, at levels whose
    cells nest eight by eight, up to a few that cover the globe."""

    cell_m: float

    @property
    def top(self) -> int:
        return max(1, floor(log(pi * EARTH_RADIUS_M / self.cell_m, WIDER)))

    def width_m(self, level: int) -> float:
        return self.cell_m * WIDER**level

    def high(self, level: int) -> float:
        return degrees(self.width_m(level) / EARTH_RADIUS_M)

    def row(self, lat: Column, level: int = 0) -> Column:
        # Of the lowest level first, so that rounding cannot part a row from the one it is in.
        return F.floor(F.floor((lat + 90) / self.high(0)) / WIDER**level)

    def columns(self, row: Column, level: int = 0) -> Column:
        """Cells of a row: as many at the top as fit where the row is longest, and eight times as
        many with each level below."""
        high, outer = self.high(self.top), F.floor(row / WIDER ** (self.top - level))
        edge = F.greatest(outer * high - 90, 90 - (outer + 1) * high, F.lit(0.0))
        fit = F.floor(360 * F.cos(F.radians(F.least(edge, F.lit(90.0)))) / high)
        return F.greatest(F.lit(1), fit).cast("long") * WIDER ** (self.top - level)

    def spans(self, rows: DataFrame, low: Column, high: Column, n: Column, level: int = 0) -> DataFrame:
        """Rows with the ``_first`` and ``_last`` cell of their ``row`` of ``_n`` between two longitudes,
        which may pass 180 degrees."""
        # Column by column, as repeated expressions make code that is too long to be compiled.
        rows = rows.withColumns({"_n": n, "_low": low, "_high": high})
        low, high = (F.floor((F.col(c) + 180) * (F.col("_n") * WIDER**level) / 360) for c in ("_low", "_high"))
        rows = rows.withColumns({"_first": F.floor(low / WIDER**level), "_last": F.floor(high / WIDER**level)})
        return rows.withColumn("_last", F.least("_last", F.col("_first") + F.col("_n") - 1)).drop("_low", "_high")

    def with_cells(self, rows: DataFrame, low: Column, high: Column, level: int = 0) -> DataFrame:
        """Rows with each ``cell`` of their ``row`` between two longitudes."""
        rows = self.spans(rows, low, high, self.columns(F.col("row"), level), level)
        rows = rows.withColumn("cell", F.explode(F.sequence("_first", "_last")))
        return rows.withColumn("cell", F.pmod("cell", "_n")).drop("_n", "_first", "_last")

    def least_m(self, level: int) -> Column:
        """No more than the distance from a position (lat, lon) to the cell (row, cell)."""
        high, n = self.high(level), self.columns(F.col("row"), level)
        south = F.col("row") * high - 90
        north_away = F.greatest(south - F.col("lat"), F.col("lat") - south - high, F.lit(0.0))
        west, wide = F.col("cell") * 360 / n - 180, 360 / n
        past = F.pmod(F.col("lon") - west, F.lit(360.0))
        east_away = F.when(past <= wide, 0.0).otherwise(F.least(past - wide, 360 - past, F.lit(90.0)))
        across = F.degrees(F.asin(F.sin(F.radians(east_away)) * F.cos(F.radians("lat"))))
        return F.greatest(north_away, across) * (pi / 180 * EARTH_RADIUS_M * (1 - 1e-9))


class SegmentIndex:
    """All segments with the grid that suits them, and the cells of wider levels, made when first needed."""

    def __init__(self, grid: Grid, segments: DataFrame, settings: Settings):
        self.grid, self.segments, self.settings = grid, segments, settings
        self.limit_m = settings.snap_radius_m
        self._levels: list[DataFrame] = []

    @cached_property
    def of(self) -> int:
        return self.segments.count()

    @property
    def tile(self) -> int:
        """The level whose cells are tiles."""
        return min(TILE if self.of >= MANY else TILE - 1, self.grid.top)

    @property
    def pieces(self) -> DataFrame:
        """(row, cell) of every cell that a segment passes through, with the segment; not stored."""
        return pieces(self.segments, self.grid)

    def level(self, k: int) -> DataFrame:
        """(row, cell) of the cells of a level above the lowest, with the ends of one of their segments each."""
        while len(self._levels) < k:
            if self._levels:
                up = {c: F.floor(F.col(c) / WIDER) for c in ("row", "cell")}
                below = self._levels[-1].withColumns(up)
            else:
                below = pieces(self.segments, self.grid, 1)
            # All of the same row, and of a kind that needs no sorting.
            one = [F.first(c).alias(c) for c in ENDS]
            self._levels.append(written(below.groupBy("row", "cell").agg(*one), "segment-cells"))
        return self._levels[k - 1]


def turn(degrees_: Column) -> Column:
    """An angle difference between -180 and 180."""
    return F.pmod(degrees_ + 180, F.lit(360.0)) - 180


def road_segments(vertices: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vertices(road_id, seq, lat, lon)`` as segments between neighbours of a road, numbered by
    the vertex they end at. A road of one vertex is a segment without length."""
    known = vertices.filter("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)")
    rows = ordered(known.select("road_id", "seq", "lat", "lon"), ["road_id"], ["seq"], settings)
    rows = scan(rows, before=previous(F.struct("lat", "lon")), n=series_size()).done()
    return rows.filter("before is not null or n = 1").select(
        "road_id", "seq", F.coalesce("before.lat", "lat").alias("lat1"), F.coalesce("before.lon", "lon").alias("lon1"),
        F.col("lat").alias("lat2"), F.col("lon").alias("lon2"),
    )


def _crossing(cut: DataFrame, grid: Grid, level: int) -> tuple[DataFrame, Column, Column]:
    """The segments with the longitudes between which they cross their ``row`` of a level."""
    step, high = F.col("lat2") - F.col("lat1"), grid.high(level)

    def at(lat: Column, end: float) -> Column:
        """The longitude where the segment meets a latitude, or of an end if it keeps its own."""
        share = (lat - F.col("lat1")) / step
        share = F.when(step != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))).otherwise(end)
        return F.col("lon1") + F.col("_turn") * share

    cut = cut.withColumns({"_south": at(F.col("row") * high - 90, 0.0), "_north": at((F.col("row") + 1) * high - 90, 1.0)})
    # Rounding must not part a piece from the cells it only touches.
    slack = high * 1e-6
    return cut, F.least("_south", "_north") - slack, F.greatest("_south", "_north") + slack


def pieces(segments: DataFrame, grid: Grid, level: int = 0) -> DataFrame:
    """(row, cell) of every cell of a level that a segment passes through, with the segment."""
    rows = F.sequence(grid.row(F.least("lat1", "lat2"), level), grid.row(F.greatest("lat1", "lat2"), level))
    cut = segments.withColumn("_turn", turn(F.col("lon2") - F.col("lon1"))).withColumn("row", F.explode(rows))
    return grid.with_cells(*_crossing(cut, grid, level), level).select("row", "cell", *SEGMENT)


def _pieces_within(tiled: DataFrame, grid: Grid, level: int) -> DataFrame:
    """(row, cell) of every cell of the tile (_row, _cell), a cell of a level, that a segment passes through."""
    wide = WIDER**level
    tiled = tiled.withColumns({
        "_turn": turn(F.col("lon2") - F.col("lon1")),
        "_all": grid.columns(F.col("_row") * wide),
        "_south": F.greatest(grid.row(F.least("lat1", "lat2")), F.col("_row") * wide),
        "_north": F.least(grid.row(F.greatest("lat1", "lat2")), F.col("_row") * wide + wide - 1),
    })
    cut = tiled.withColumn("row", F.explode(F.sequence("_south", "_north")))
    cut = grid.spans(*_crossing(cut, grid, 0), F.col("_all"))
    # How far east of the tile's west side they begin and end; those that go on round the globe begin at it.
    cut = cut.withColumn("_from", F.pmod(F.col("_first") - F.col("_cell") * wide, F.col("_n")))
    cut = cut.withColumn("_to", F.col("_from") + F.col("_last") - F.col("_first"))
    round_ = F.col("_to") >= F.col("_n")
    to = F.when(round_ & (F.col("_from") >= wide), F.col("_to") - F.col("_n")).otherwise(F.col("_to"))
    cut = cut.withColumns({"_from": F.when(round_, F.lit(0).cast("long")).otherwise(F.col("_from")), "_to": F.least(to, F.lit(wide - 1))})
    # No filter, which would be moved before all of this, and repeat it.
    cells = cut.withColumn("cell", F.explode(F.when(F.col("_from") <= F.col("_to"), F.sequence("_from", "_to"))))
    return cells.withColumn("cell", F.col("_cell") * wide + F.col("cell"))


def finest(segments: DataFrame, settings: Settings) -> Grid:
    """The widest grid whose fullest cell is not too full, or in whose cells a piece meets no more
    others than its segment's pieces are worth, or the narrowest allowed. It only decides how much
    work is to be done, so where segments are many, a share of them tells."""
    # Looking at a piece takes much less than making it.
    cell_m, of, worth = FIRST_CELL_M, segments.count(), settings.cell_points / 2
    share = max(1, of // TELLING)
    some = segments.filter(_one_of(share))
    while cell_m > LEAST_CELL_M:
        n = F.col("count").cast("double")
        cells = pieces(some, Grid(cell_m)).groupBy("row", "cell").count()
        fullest, in_all, squares = (share**i * (x or 0) for i, x in zip((1, 1, 2), cells.agg(F.max(n), F.sum(n), F.sum(n * n)).first()))
        met = squares - (share - 1) * in_all
        if fullest <= settings.cell_points or met / in_all <= worth * in_all / of:
            break
        cell_m /= 2
    return Grid(cell_m)


def _one_of(share: int) -> Column:
    """True for about one of so many segments."""
    return F.pmod(F.xxhash64("road_id", "seq"), F.lit(share)) == 0 if share > 1 else F.lit(True)


def segment_index(
    vertices: DataFrame, settings: Settings = Settings(), cell_m: float | None = None
) -> SegmentIndex:
    """An index of the roads through the vertices; see ``road_segments``."""
    segments = written(road_segments(vertices, settings), "segments")
    grid = finest(segments, settings) if cell_m is None else Grid(cell_m)
    return SegmentIndex(grid, segments, settings)


def foot(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The place on a segment that is nearest to a position, in the position's plane."""
    shrink = F.cos(F.radians(lat))
    x1, y1 = turn(F.col("lon1") - lon) * shrink, F.col("lat1") - lat
    dx, dy = turn(F.col("lon2") - F.col("lon1")) * shrink, F.col("lat2") - F.col("lat1")
    square = dx * dx + dy * dy
    share = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(x1 * dx + y1 * dy) / square)))
    share = F.coalesce(share, F.lit(0.0))
    near_lon = F.col("lon1") + turn(F.col("lon2") - F.col("lon1")) * share
    return F.col("lat1") + dy * share, turn(near_lon)


def _looked(places: DataFrame, grid: Grid, level: int, within_m: Column | None = None) -> DataFrame:
    """The places with every (row, cell) of a level that is within the width of a cell, or at the
    top with all, or with those within a column's metres."""
    most = degrees(grid.width_m(level) / EARTH_RADIUS_M) if level < grid.top else 180.0
    reach = F.lit(most) if within_m is None else F.degrees(within_m / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-12
    away = F.col("_away")
    south, north = F.greatest(F.col("lat") - away, F.lit(-90.0)), F.least(F.col("lat") + away, F.lit(90.0))
    # How far east and west a circle reaches; around a pole, all the way.
    spread = F.sin(F.radians(F.least(away, F.lit(90.0)))) / F.cos(F.radians("lat"))
    east = F.when((F.col("_spread") < 1) & (F.abs("lat") + away < 90), F.degrees(F.asin("_spread"))).otherwise(180.0)
    looked = places.withColumn("_away", reach).withColumn("_spread", spread).withColumns({
        "_east": east, "_south": grid.row(south, level), "_north": grid.row(north, level),
    })
    looked = looked.withColumn("row", F.explode(F.sequence("_south", "_north")))
    looked = grid.with_cells(looked, F.col("lon") - F.col("_east"), F.col("lon") + F.col("_east"), level)
    return looked.drop("_away", "_spread", "_east", "_south", "_north")


def _may_be_within() -> Column:
    """False only where the whole line through a segment is farther from the position than ``within_m``.
    It costs much less than the nearest place; ``_limit`` is the square of the distance in degrees."""
    x, y = F.col("lon1") - F.col("lon"), F.col("lat1") - F.col("lat")
    x = (x - F.rint(x / 360) * 360) * F.col("_shrink")
    dx, dy = F.col("_turn") * F.col("_shrink"), F.col("lat2") - F.col("lat1")
    across = x * dy - y * dx
    return across * across <= F.col("_limit") * (dx * dx + dy * dy)


def _met(looked: DataFrame, index: SegmentIndex, one_of: int = 1, level: int = 0) -> DataFrame:
    """Places (lat, lon, within_m) with (row, cell) of a level, and the segments in these cells that may
    be within so many metres. Some are met several times."""
    grid, settings, spark = index.grid, index.settings, looked.sparkSession
    wide, inner, most = WIDER ** (index.tile - level), WIDER**level, max(1, settings.group_rows // 8)
    tile = ["_row", "_cell"]
    looked = looked.withColumns({"_row": F.floor(F.col("row") / wide), "_cell": F.floor(F.col("cell") / wide)})
    tiled = pieces(index.segments.filter(_one_of(one_of)), grid, index.tile)
    tiled = tiled.withColumnsRenamed({"row": "_row", "cell": "_cell"})
    # Tiles that have both, and into how many parts each of the two goes there.
    both = looked.groupBy(*tile).agg((F.count("*") * inner**2).alias("_looks")).join(
        tiled.groupBy(*tile).agg(F.count("*").alias("_cuts")), tile
    )
    parts = {"_a": F.ceil(F.col("_looks") / most), "_b": F.ceil(F.col("_cuts") / most)}
    both = written(both.withColumns(parts), "road-tiles")
    looks, cuts = both.agg(F.sum(F.col("_looks") * F.col("_b")), F.sum(F.col("_cuts") * F.col("_a"))).first()
    n = max(spark.sparkContext.defaultParallelism, min(MOST_PARTS, ceil(max(looks or 0, cuts or 0) / most)))
    both = small_side(both.select(*tile, "_a", "_b"), settings)

    def dealt(rows: DataFrame, key: list[str], own: str, other: str) -> DataFrame:
        """Rows with their tile's part, or for each part of the others."""
        rows = rows.join(both, tile)
        rows = rows.withColumn(own, F.pmod(F.xxhash64(F.lit(own), *key), F.col(own)))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        # Parts that share a hash meet for nothing, but do no harm.
        return rows.withColumn("_part", F.xxhash64(*tile, "_a", "_b")).drop("_a", "_b").repartition(n, "_part")

    cut = _pieces_within(dealt(tiled, ["road_id", "seq"], "_b", "_a"), grid, index.tile)
    cut = cut.select("_part", "row", "cell", "_turn", *SEGMENT)
    looked = dealt(looked, ["lat", "lon"], "_a", "_b")
    if level:
        for c in ("row", "cell"):
            looked = looked.withColumn(c, F.explode(F.sequence(F.col(c) * inner, F.col(c) * inner + inner - 1)))
        looked = looked.filter(grid.least_m(0) <= F.col("within_m"))
    limit = F.col("within_m") * (degrees(1 / EARTH_RADIUS_M) * 1.01) + 1e-11
    curved = (F.col("within_m") > FLAT_M) | (F.abs("lat") > 89)
    looked = looked.select(
        "_part", "row", "cell", "lat", "lon", "within_m", F.cos(F.radians("lat")).alias("_shrink"),
        F.when(curved, 1e300).otherwise(limit * limit).alias("_limit"),
    )
    met = cut.join(looked.hint("shuffle_hash"), ["_part", "row", "cell"]).filter(_may_be_within())
    # Written, as measuring in the join itself makes code that is too long to be compiled.
    return written(met.select("lat", "lon", "within_m", *SEGMENT), "pieces-met", DEALT)


def _nearer(places: DataFrame, index: SegmentIndex, one_of: int) -> DataFrame:
    """The places (lat, lon, bound_m) with a lower bound if one of the segments gives one."""
    measured = _measured(_met(_looked_within(places, index.grid, index.grid.cell_m / 4), index, one_of))
    # Rounding must not part a place from the segment that gave its bound.
    bounds = measured.groupBy("lat", "lon").agg((F.min("near_m") * (1 + 1e-9) + 1e-6).alias("_bound_m"))
    bound = F.least("bound_m", "_bound_m").alias("bound_m")
    return places.join(bounds, ["lat", "lon"], "left").select("lat", "lon", bound)


def _looked_within(places: DataFrame, grid: Grid, else_m: float) -> DataFrame:
    """The places with the cells within their bound, or without one within ``else_m``, and never more
    than the width of a cell."""
    within = F.least(F.coalesce("bound_m", F.lit(else_m)), F.lit(grid.cell_m))
    return _looked(places.withColumn("within_m", within), grid, 0, F.col("within_m")).drop("bound_m")


def _close(places: DataFrame, index: SegmentIndex) -> DataFrame:
    """The nearest of each place that has a road within the width of a cell."""
    reach, bounded = index.grid.cell_m, places.withColumn("bound_m", F.lit(None).cast("double"))
    for one_of in (x for x in ONE_OF if index.of >= x * ENOUGH):
        bounded = written_alone(lambda: _nearer(bounded, index, one_of), "bounded-places")
    return _best(_measured(_met(_looked_within(bounded, index.grid, reach), index))).filter(F.col("near_m") <= reach)


def _measured(met: DataFrame) -> DataFrame:
    """Places that met a segment, with the nearest place on it."""
    near_lat, near_lon = foot(F.col("lat"), F.col("lon"))
    met = met.withColumns({"near_lat": near_lat, "near_lon": near_lon})
    return met.withColumn("near_m", haversine(F.col("lat"), F.col("lon"), F.col("near_lat"), F.col("near_lon")))


def _best(measured: DataFrame) -> DataFrame:
    """The nearest of each place, found where the rows are, before any shuffle."""
    names = ["near_m", "road_id", "seq", "near_lat", "near_lon"]
    best = measured.groupBy("lat", "lon").agg(F.min(F.struct(*names)).alias("best"))
    return best.select("lat", "lon", "best.near_lat", "best.near_lon", "best.near_m", "best.road_id", "best.seq")


def _bounded(measured: DataFrame) -> DataFrame:
    """The cells of each place, with the least distance to any of their segments as its bound."""
    known = F.least(F.col("bound_m"), F.min("near_m").over(Window.partitionBy("lat", "lon")))
    return measured.withColumn("bound_m", known).select("lat", "lon", "row", "cell", "bound_m")


def _go_down(cells: DataFrame, index: SegmentIndex, level: int) -> DataFrame:
    """The nearest of each place, by the cells of a level that are within its bound."""
    for k in range(level - 1, 0, -1):
        up = {"_row": F.floor(F.col("row") / WIDER), "_cell": F.floor(F.col("cell") / WIDER)}
        inner = index.level(k).withColumns(up)
        outer = cells.withColumnsRenamed({"row": "_row", "cell": "_cell"})
        met = outer.join(inner, ["_row", "_cell"]).drop("_row", "_cell")
        met = _measured(met.filter(index.grid.least_m(k) <= F.col("bound_m")))
        cells = _bounded(met)
        # A cell whose own segment set the bound of another may now be beyond it.
        cells = written(cells.filter(index.grid.least_m(k) <= F.col("bound_m")), "cells-within")
    # Rounding must not part a place from the segment that gave its bound.
    within = F.col("bound_m") * (1 + 1e-9) + 1e-6
    return _best(_measured(_met(cells.withColumn("within_m", within).drop("bound_m"), index, level=1)))


def nearest_on_roads(places: DataFrame, index: SegmentIndex) -> DataFrame:
    """The nearest place on a road of each distinct (lat, lon) that has one: ``near_lat``,
    ``near_lon``, ``near_m``, ``road_id`` and ``seq`` of the segment.

    Positions without coordinates have none; with a limit, those farther from all roads neither.
    """
    grid = index.grid
    left = places.select("lat", "lon").filter("lat between -90 and 90 and lon between -180 and 180").distinct()
    left = written(left, "places")
    found = [written_alone(lambda: _close(left, index), "on-roads")]
    level, limit = 0, pi * EARTH_RADIUS_M if index.limit_m is None else index.limit_m
    while not index.segments.isEmpty() and grid.width_m(level) < limit * (1 + 1e-6) and level < grid.top:
        left = written(left.join(found[-1], ["lat", "lon"], "left_anti"), "off-roads")
        if left.isEmpty():
            break
        level += 1
        met = _measured(_looked(left, grid, level).join(index.level(level), ["row", "cell"]))
        cells = _bounded(met.withColumn("bound_m", F.lit(float("inf"))))
        # Beyond the width of a cell, other cells could hold a nearer segment.
        sure = F.lit(True) if level == grid.top else F.col("bound_m") <= grid.width_m(level)
        cells = written(cells.filter(sure), "cells-within")
        found.append(written_alone(lambda: _go_down(cells, index, level), "on-roads"))
    nearest = reduce(DataFrame.unionByName, found)
    return nearest if index.limit_m is None else nearest.filter(F.col("near_m") <= index.limit_m)
