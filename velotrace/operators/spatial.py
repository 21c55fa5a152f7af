"""Nearest-point and within-radius queries on a grid that refines itself where points are dense.

Places are kept in grid cells one search radius wide. A cell of at most ``cell_points`` places
holds them in its row; a fuller cell holds only its occupied sub-cells, with their bounds and
totals, and those are cells of the next level. A query joins the few cells around it, one row per
cell, and looks inside the row. Of a full cell it follows only the sub-cells that can still change
its result. So no cell row grows with the data.

Most nearest places are found without that. Places are also dealt to flat cells, so small that few
share one, and a query looks for places within half a cell's width, in the four cells around it.
What it finds there is nearest of all. Cells that hold too many places are not looked into, and
queries that find nothing, or that are near such a cell, go the way through the refined cells, of
which only those are made that such queries can reach.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from math import degrees, pi, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.functions.geo import EARTH_RADIUS_M, arc, chord
from velotrace.operators.joins import lookup, small_side
from velotrace.session import written
from velotrace.settings import Settings

# Sub-cells per side, and levels until a cell is about as fine as a double can tell.
SPLIT_BITS = 3
LEVELS = 12
# Bounds are widened by this share, so that rounding never hides a place.
SLACK = 1e-9
# Flat cells: most halvings of a width, least places to share one on average, cells of how many
# times ``cell_points`` places are not looked into, and looks at twice the width of the one before.
MOST_HALVINGS = 30
LEAST_SHARED = 4
CROWDED = 8
LOOKS = 3
# Of so many places or more, only some cells are counted to find out how many places share one.
COUNTED = 200_000
# Nearer to a pole, and wider, a circle meets more than a few cells.
FLAT_LAT = 85.0
FLAT_REACH_M = 1_000_000.0


@dataclass(frozen=True)
class Grid:
    """Rows one radius high, cut into columns at least one radius wide at the row's latitude.

    Columns wrap at the antimeridian.
    """

    radius_m: float

    @property
    def height_deg(self) -> float:
        return degrees(self.radius_m / EARTH_RADIUS_M) * (1 + SLACK)

    def columns(self, row: Column) -> Column:
        """Columns of a top-level row: fewer towards the poles."""
        edge = F.greatest(F.abs(row * self.height_deg - 90), F.abs((row + 1) * self.height_deg - 90))
        narrowest = F.cos(F.radians(F.least(edge, F.lit(90.0))))
        return F.greatest(F.lit(1), F.floor(360 * narrowest / self.height_deg)).cast("long")

    def leaf(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Indexes at the finest level; coarser ones are right shifts of them."""
        bits = SPLIT_BITS * (LEVELS - 1)
        fine = 1 << bits
        row = F.floor((lat + 90) / (self.height_deg / fine)).cast("long")
        count = self.columns(F.shiftright(row, bits))
        column = F.floor((lon + 180) / 360 * (count * fine)).cast("long")
        return row, F.least(column, count * fine - 1)

    def spread(self, lat: Column) -> Column:
        """Degrees of longitude that the radius can span."""
        reach = F.lit(sin(self.radius_m / EARTH_RADIUS_M)) / F.cos(F.radians(lat))
        return F.when(
            reach < 1, F.degrees(F.asin(F.least(reach, F.lit(1.0)))) * (1 + SLACK) + SLACK
        ).otherwise(180.0)


@dataclass(frozen=True)
class PlaceIndex:
    """Merged places, and their cell tables by level, made when first needed."""

    grid: Grid
    places: DataFrame
    sums: tuple[str, ...]
    settings: Settings

    @cached_property
    def levels(self) -> tuple[DataFrame, ...]:
        return self._tree[0]

    @cached_property
    def entries(self) -> tuple[int, ...]:
        """How many places and sub-cells each table lists in all."""
        return self._tree[1]

    @cached_property
    def _tree(self) -> tuple[tuple[DataFrame, ...], tuple[int, ...]]:
        return _cell_tables(self.celled(), self.sums, self.settings)

    def celled(self) -> DataFrame:
        """The places with their finest cells."""
        row, column = self.grid.leaf(F.col("lat"), F.col("lon"))
        return self.places.withColumns({"_row": row, "_column": column})

    def wider(self, radius_m: float) -> "PlaceIndex":
        """The same places for another radius."""
        return replace(self, grid=Grid(radius_m))

    @cached_property
    def halvings(self) -> int:
        """How often a width of twice the radius is halved until few places share a flat cell."""
        few, one_of = max(LEAST_SHARED, self.settings.cell_points // 10), max(1, self.places.count() // COUNTED)
        sides = Grid(2 * self.grid.radius_m).leaf(F.col("lat"), F.col("lon"))
        placed = self.places.select(sides[0].alias("_row"), sides[1].alias("_column"))
        placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(MOST_HALVINGS))).alias("times"))
        shift = SPLIT_BITS * (LEVELS - 1)
        key = F.expr(f"xxhash64(times, shiftright(_row, {shift} - times), shiftright(_column, {shift} - times))")
        # The cells that are counted are counted with all their places.
        counted = placed.select("times", key.alias("key")).filter(F.pmod("key", F.lit(one_of)) == 0)
        counted = counted.groupBy("times", "key").count()
        found = counted.groupBy("times").agg(F.avg("count").alias("shared")).filter(F.col("shared") <= few)
        return found.agg(F.min("times")).first()[0] or 0


def index_places(
    places: DataFrame,
    radius_m: float,
    totals: Sequence[str] = (),
    settings: Settings = Settings(),
) -> PlaceIndex:
    """Index rows ``(lat, lon, *totals)``; rows at one place are merged and their totals added."""
    located = places.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    merged = located.groupBy("lat", "lon").agg(
        F.count("*").alias("rows"), *[F.sum(t).alias(t) for t in totals]
    )
    merged = merged.withColumn("cos", F.cos(F.radians("lat")))
    return PlaceIndex(Grid(radius_m), written(merged, "places"), ("rows", *totals), settings)


def _cell_tables(
    current: DataFrame, sums: Sequence[str], settings: Settings
) -> tuple[tuple[DataFrame, ...], tuple[int, ...]]:
    """The cells of each level, and how many places and sub-cells each level lists."""
    levels, entries = [], []
    for level in range(LEVELS):
        last = level == LEVELS - 1
        here = _cell(level)
        sizes = current.groupBy(*here).agg(F.count("*").alias("_places"))
        full = sizes.filter(F.col("_places") > settings.cell_points).select("row", "column")
        # Doubles cannot tell many places apart within a cell of the last level.
        some_full = not last and not full.isEmpty()
        if some_full:
            full = written(full, "full-cells")
            dense = lookup(
                current.select("*", *here), full.withColumn("_full", F.lit(True)), ["row", "column"], settings
            )
            sparse = dense.filter(F.col("_full").isNull())
            dense = dense.filter(F.col("_full"))
        else:
            sparse, dense = current.select("*", *here), None
        place = F.struct("lat", "lon", "cos", *sums)
        cells = sparse.groupBy("row", "column").agg(F.collect_list(place).alias("places"))
        if dense is not None:
            children = dense.groupBy("row", "column", *_cell(level + 1, "sub_")).agg(
                F.min("lat").alias("south"),
                F.max("lat").alias("north"),
                F.min("lon").alias("west"),
                F.max("lon").alias("east"),
                *[F.sum(s).alias(s) for s in sums],
            )
            child = F.struct("sub_row", "sub_column", "south", "north", "west", "east", *sums)
            branches = children.groupBy("row", "column").agg(F.collect_list(child).alias("children"))
            cells = cells.withColumn(
                "children", F.lit(None).cast(branches.schema["children"].dataType)
            ).unionByName(
                branches.withColumn("places", F.lit(None).cast(cells.schema["places"].dataType)),
            )
        cells = written(cells, "cells")
        levels.append(cells)
        listed = [F.coalesce(F.size(c), F.lit(0)) for c in ("places", "children") if c in cells.columns]
        total = cells.agg(F.sum(reduce(lambda a, b: a + F.greatest(b, F.lit(0)), listed, F.lit(0))))
        entries.append(total.first()[0] or 0)
        if dense is None:
            break
        current = written(dense.drop("row", "column", "_full"), "places")
    return tuple(levels), tuple(entries)


def _cell(level: int, prefix: str = "") -> list[Column]:
    shift = SPLIT_BITS * (LEVELS - 1 - level)
    return [
        F.shiftright(f"_{side}", shift).alias(f"{prefix}{side}") for side in ("row", "column")
    ]


def _bounds(lat: Column, lon: Column, box: Column) -> tuple[Column, Column]:
    """Distances in metres that no place in the box is closer than, or farther than."""
    south, north, west, east = (box[x] for x in ("south", "north", "west", "east"))
    cos_query = F.cos(F.radians(lat))
    cos_edges = F.cos(F.radians(south)), F.cos(F.radians(north))
    zero = F.lit(0.0)
    dlat_min = F.greatest(zero, south - lat, lat - north)
    dlat_max = F.greatest(F.abs(lat - south), F.abs(lat - north))
    dlon_max = F.greatest(F.abs(lon - west), F.abs(lon - east))
    # Beyond half a turn the other way round is shorter.
    dlon_min = F.least(
        F.greatest(zero, west - lon, lon - east), F.greatest(zero, F.lit(360.0) - dlon_max)
    )
    cos_high = F.when((south <= 0) & (north >= 0), F.lit(1.0)).otherwise(F.greatest(*cos_edges))
    near = arc(chord(dlat_min, dlon_min, cos_query, F.least(*cos_edges)), known=True)
    far = F.when(
        dlon_max <= 180, arc(chord(dlat_max, dlon_max, cos_query, cos_high), known=True)
    ).otherwise(F.lit(pi * EARTH_RADIUS_M))
    return near * (1 - SLACK) - SLACK, far * (1 + SLACK) + SLACK


def _start(queries: DataFrame, grid: Grid) -> DataFrame:
    """Queries with each top-level cell that can hold places within the radius.

    ``_lon`` is the query's longitude, turned once around where the cell lies beyond the
    antimeridian. The box of ``_south`` to ``_east`` contains the circle.

    Each query turns into many distance computations, so queries are spread over all cores even
    where they are few bytes; results are grouped by query later, on the same partitioning. They
    are written first, as the spreading would otherwise be merged with the shuffle before it.
    """
    spark = queries.sparkSession
    queries = written(queries.select("lat", "lon"), "queries")
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    lat, lon = F.col("lat"), F.col("lon")
    count, turns = F.col("_count"), F.floor(F.col("_c") / F.col("_count"))
    # Near a pole a cell can be met from both sides; it is visited once, with all its places.
    all_round = F.col("_last") - F.col("_first") >= count
    return (
        queries.repartition(tasks, "lat", "lon").select("lat", "lon", F.cos(F.radians(lat)).alias("_cos"), grid.spread(lat).alias("_wide"))
        .withColumn("_top", F.shiftright(grid.leaf(lat, lon)[0], SPLIT_BITS * (LEVELS - 1)))
        .withColumn("row", F.explode(F.sequence(F.col("_top") - 1, F.col("_top") + 1)))
        .withColumn("_count", grid.columns(F.col("row")))
        .withColumn("_first", F.floor((lon - F.col("_wide") + 180) / 360 * count))
        .withColumn("_last", F.floor((lon + F.col("_wide") + 180) / 360 * count))
        .withColumn(
            "_c",
            F.explode(
                F.sequence("_first", F.least(F.col("_last"), F.col("_first") + count - 1))
            ),
        )
        .select(
            "lat",
            "lon",
            "row",
            F.pmod("_c", count).alias("column"),
            (lon - turns * 360.0).alias("_lon"),
            "_cos",
            (lat - grid.height_deg).alias("_south"),
            (lat + grid.height_deg).alias("_north"),
            F.when(all_round, -540.0).otherwise(lon - turns * 360.0 - F.col("_wide")).alias("_west"),
            F.when(all_round, 540.0).otherwise(lon - turns * 360.0 + F.col("_wide")).alias("_east"),
        )
    )


_QUERY = ["lat", "lon", "_lon", "_cos", "_south", "_north", "_west", "_east"]


def _meet(frontier: DataFrame, index: PlaceIndex, level: int) -> DataFrame:
    """Query rows with the cell they look into."""
    settings = index.settings
    return lookup(
        frontier,
        index.levels[level],
        ["row", "column"],
        settings,
        "inner",
        small=index.entries[level] <= settings.broadcast_rows,
    )


def _boxed() -> Column:
    """The cell's places in the query's box; a box of half a turn or more takes all."""
    return F.filter(
        "places",
        lambda p: (p["lat"] >= F.col("_south"))
        & (p["lat"] <= F.col("_north"))
        & (
            ((p["lon"] >= F.col("_west")) & (p["lon"] <= F.col("_east")))
            | (F.col("_east") - F.col("_west") >= 180)
        ),
    )


def _metres(p: Column) -> Column:
    """Distance from the query to a place, whose cosines are at hand."""
    term = chord(p["lat"] - F.col("lat"), p["lon"] - F.col("_lon"), F.col("_cos"), p["cos"])
    return arc(term, known=True)


def nearest(queries: DataFrame, index: PlaceIndex) -> DataFrame:
    """The nearest place within the radius of each distinct ``(lat, lon)``.

    Returns ``(lat, lon, near_lat, near_lon, near_m)``; queries without one are left out. Of
    places at the same distance the one with the smaller latitude, then longitude, is taken.
    """
    found, left = [], written(queries.select("lat", "lon").distinct(), "queries")
    for halvings in range(index.halvings, max(index.halvings - LOOKS, -1), -1):
        if index.grid.radius_m / 2**halvings > FLAT_REACH_M or left.isEmpty():
            break
        near, left = _look(left, index, halvings, again=bool(found))
        found.append(near)
    if found and left.isEmpty():
        return _nearest_rows(found)
    # Only places in cells around the rest can be near to it.
    around = _start(left, index.grid).select("row", "column").distinct()
    reached = index.celled().select("*", *_cell(0)).join(around, ["row", "column"], "left_semi")
    reached = written(reached.select(*index.places.columns), "places-around")
    return _nearest_rows([*found, _refined(left, replace(index, places=reached))])


def _nearest_rows(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).select(
        "lat",
        "lon",
        F.col("_best.lat").alias("near_lat"),
        F.col("_best.lon").alias("near_lon"),
        F.col("_best.m").alias("near_m"),
    )


def _look(
    queries: DataFrame, index: PlaceIndex, halvings: int, again: bool
) -> tuple[DataFrame, DataFrame]:
    """The nearest place of each query that has one within half the width of a flat cell, and the
    queries for which that does not tell. Those of a look ``again`` are few, and so are their cells."""
    wide, circle = Grid(2 * index.grid.radius_m), Grid(index.grid.radius_m / 2**halvings)
    high, away = wide.height_deg / 2**halvings, circle.height_deg
    lat, lon, count = F.col("lat"), F.col("lon"), F.col("_count")
    rows = F.sequence(F.floor((lat - away + 90) / high), F.floor((lat + away + 90) / high))
    first = F.floor((lon - F.col("_wide") + 180) / 360 * count)
    last = F.floor((lon + F.col("_wide") + 180) / 360 * count)
    looked = (
        queries.filter(F.abs(lat) <= FLAT_LAT)
        .select("lat", "lon", F.cos(F.radians(lat)).alias("_cos"), circle.spread(lat).alias("_wide"), F.explode(rows).alias("row"))
        .withColumn("_count", wide.columns(F.shiftright("row", halvings)) * (1 << halvings))
        .withColumn("_c", F.explode(F.sequence(first, F.least(last, first + count - 1))))
        .select("lat", "lon", "_cos", (lon - F.floor(F.col("_c") / count) * 360.0).alias("_lon"), "row", F.pmod("_c", count).alias("column"))
    )
    sides = [F.shiftright(x, SPLIT_BITS * (LEVELS - 1) - halvings) for x in wide.leaf(lat, lon)]
    placed = index.places.select(
        sides[0].alias("row"), sides[1].alias("column"), lat.alias("_plat"), lon.alias("_plon"), F.col("cos").alias("_pcos")
    )
    if again:
        looked = written(looked, "looked")
        placed = written(placed.join(looked.select("row", "column").distinct(), ["row", "column"], "left_semi"), "places-looked")
    crowded = placed.groupBy("row", "column").count().filter(F.col("count") > CROWDED * index.settings.cell_points)
    crowded = written(crowded.select("row", "column"), "crowded-cells")
    unsure = None
    if not crowded.isEmpty():
        few = small_side(crowded, index.settings)
        placed = placed.join(few, ["row", "column"], "left_anti")
        unsure = written(looked.join(few, ["row", "column"], "left_semi").select("lat", "lon").distinct(), "unsure")
        looked = looked.join(unsure, ["lat", "lon"], "left_anti")
    term = chord(F.col("_plat") - lat, F.col("_plon") - F.col("_lon"), F.col("_cos"), F.col("_pcos"))
    near = looked.join(placed, ["row", "column"]).withColumn("m", arc(term, known=True))
    near = near.filter(F.col("m") <= circle.radius_m)
    best = F.min(F.struct("m", F.col("_plat").alias("lat"), F.col("_plon").alias("lon"))).alias("_best")
    near = written(near.groupBy("lat", "lon").agg(best), "nearest-found")
    left = queries.join(near, ["lat", "lon"], "left_anti")
    if not halvings:
        # The circle was the whole one.
        not_looked = left.filter(F.abs(lat) > FLAT_LAT)
        left = not_looked if unsure is None else not_looked.unionByName(unsure)
    return near, written(left, "unsettled")


def _refined(queries: DataFrame, index: PlaceIndex) -> DataFrame:
    """The nearest place within the radius of each query, by the refined cells."""
    radius = F.lit(index.grid.radius_m)
    point = F.col("lat"), F.col("_lon")

    def candidate(p: Column) -> Column:
        return F.struct(
            _metres(p).alias("m"),
            p["lat"].alias("lat"),
            p["lon"].alias("lon"),
        )

    def reachable(child: Column) -> Column:
        near, far = _bounds(*point, child)
        return F.struct(
            near.alias("near"),
            far.alias("far"),
            child["sub_row"].alias("row"),
            child["sub_column"].alias("column"),
            *[F.col(c).alias(c) for c in _QUERY[2:]],
        )

    frontier = _start(queries, index.grid)
    results = []
    for level, cells in enumerate(index.levels):
        met = _meet(frontier, index, level)
        best = F.array_min(F.transform(_boxed(), candidate))
        deeper = "children" in cells.columns
        found = [F.min("_best").alias("_best")]
        if level:
            best = F.least(F.col("_so_far"), best)
        met = met.withColumn("_best", best)
        if deeper:
            met = met.withColumn(
                "_next", F.filter(F.transform("children", reachable), lambda c: c["near"] <= radius)
            ).withColumn(
                "_limit",
                F.least(
                    F.col("_best.m"), F.array_min(F.transform("_next", lambda c: c["far"])), radius
                ),
            )
            met = met.withColumn(
                "_next", F.filter("_next", lambda c: c["near"] <= F.col("_limit"))
            )
            found += [
                F.min("_limit").alias("_limit"),
                F.flatten(F.collect_list("_next")).alias("_next"),
            ]
        state = met.groupBy("lat", "lon").agg(*found)
        if not deeper:
            results.append(state.select("lat", "lon", "_best"))
            break
        state = written(
            state.withColumn("_next", F.filter("_next", lambda c: c["near"] <= F.col("_limit"))),
            "nearest-state",
        )
        results.append(state.filter(F.size("_next") == 0).select("lat", "lon", "_best"))
        frontier = (
            state.filter(F.size("_next") > 0)
            .select("lat", "lon", F.col("_best").alias("_so_far"), F.explode("_next").alias("_c"))
            .select("lat", "lon", "_so_far", "_c.row", "_c.column", *[f"_c.{c}" for c in _QUERY[2:]])
        )
    return reduce(DataFrame.unionByName, results).filter(F.col("_best.m") <= radius)


def totals_within(queries: DataFrame, index: PlaceIndex, totals: Sequence[str]) -> DataFrame:
    """``rows`` and the totals of all places within the radius of each distinct ``(lat, lon)``.

    Sub-cells that lie wholly inside the circle add their totals without being opened.
    """
    radius = index.grid.radius_m
    sums = ["rows", *totals]
    point = F.col("lat"), F.col("_lon")
    frontier = _start(queries, index.grid)
    parts = []
    for level, cells in enumerate(index.levels):
        met = _meet(frontier, index, level)
        inside = F.filter(_boxed(), lambda p: _metres(p) <= radius)
        takes = [inside]
        deeper = "children" in cells.columns
        if deeper:
            met = met.withColumn(
                "_seen",
                F.transform(
                    "children",
                    lambda c: F.struct(
                        c.alias("c"),
                        _bounds(*point, c)[0].alias("near"),
                        _bounds(*point, c)[1].alias("far"),
                    ),
                ),
            )
            takes.append(
                F.transform(F.filter("_seen", lambda s: s["far"] <= radius), lambda s: s["c"])
            )
        met = met.withColumns({f"_take{i}": t for i, t in enumerate(takes)})

        def total(name: str) -> Column:
            return reduce(
                lambda a, b: a + b,
                [
                    F.coalesce(
                        F.aggregate(
                            F.transform(F.col(f"_take{i}"), lambda p: p[name].cast("double")),
                            F.lit(0.0),
                            lambda acc, x: acc + x,
                        ),
                        F.lit(0.0),
                    )
                    for i in range(len(takes))
                ],
            )

        parts.append(met.select("lat", "lon", *[total(s).alias(s) for s in sums]))
        if not deeper:
            break
        frontier = written(
            met.withColumn(
                "_open",
                F.explode(
                    F.filter("_seen", lambda s: (s["near"] <= radius) & (s["far"] > radius))
                ),
            ).select(
                *_QUERY,
                F.col("_open.c.sub_row").alias("row"),
                F.col("_open.c.sub_column").alias("column"),
            ),
            "within-frontier",
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("lat", "lon")
        .agg(F.sum("rows").cast("long").alias("rows"), *[F.sum(t).alias(t) for t in totals])
    )
