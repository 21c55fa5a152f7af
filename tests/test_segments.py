"""The nearest place on road lines against all segments, and the ellipsoid against published distances."""

import math
import random

import pytest
from pyspark.sql import functions as F

from velotrace import session
from velotrace.functions.geo import geodesic, haversine
from velotrace.operators import roads, segments
from velotrace.settings import Settings

VERTICES = "road_id long, seq int, lat double, lon double"
PLACES = "lat double, lon double"


def turn(x):
    return (x + 180) % 360 - 180


def metres(lat, lon, lat2, lon2):
    t = math.sin(math.radians(lat2 - lat) / 2) ** 2
    t += math.cos(math.radians(lat)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(min(1.0, t)))


def brute(lat, lon, rows):
    best = math.inf
    for a, b, c, d in rows:
        shrink = math.cos(math.radians(lat))
        x, y = turn(b - lon) * shrink, a - lat
        dx, dy = turn(d - b) * shrink, c - a
        t = max(0.0, min(1.0, -(x * dx + y * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        best = min(best, metres(lat, lon, a + dy * t, turn(b + turn(d - b) * t)))
    return best


def test_against_all_segments(frame):
    rng, vertices = random.Random(4), []
    corners = [(51, 0), (-33, 179.99), (70, -180), (0, 10)]
    for road in range(40):
        lat, lon = (x + rng.random() * 0.03 for x in rng.choice(corners))
        for seq in range(rng.randrange(1, 5)):
            vertices.append((road, seq, lat, turn(lon)))
            lat, lon = lat + rng.choice([0, rng.gauss(0, 0.01)]), lon + rng.choice([0, rng.gauss(0, 0.01)])
    # Far longer than a cell, and a vertex without coordinates between two others.
    vertices += [(90, 0, 51.0, -3.0), (90, 1, None, 1.0), (90, 2, 53.0, 2.0), (91, 0, None, None)]
    places = [tuple(x + rng.random() * 0.04 for x in rng.choice(corners)) for _ in range(60)]
    places = [(lat, turn(lon)) for lat, lon in places] + [(90.0, 3.0), (-89.0, -170.0), (52.0, -0.5), (52.0, -0.5)]
    odd = [(None, 1.0), (float("nan"), 1.0), (95.0, 0.0)]
    lines = frame(VERTICES, *vertices)
    rows = [r[2:] for r in segments.road_segments(lines).collect()]
    for cell_m in (200.0, 50_000.0):
        found = segments.nearest_on_roads(frame(PLACES, *places, *odd), segments.segment_index(lines, cell_m=cell_m))
        got = {(r.lat, r.lon): r.near_m for r in found.collect()}
        assert len(got) == len(set(places))
        for place, near_m in got.items():
            assert near_m == pytest.approx(brute(*place, rows), rel=1e-9, abs=1e-6)


def test_crowded_cells_are_made_smaller(frame):
    lines = frame(VERTICES, *[(r, s, 51 + r * 1e-5, s * 0.001) for r in range(40) for s in (0, 1)])
    index = segments.segment_index(lines, Settings(cell_points=4))
    assert index.grid.cell_m < segments.FIRST_CELL_M


def test_long_crossing_segments_are_not_cut_without_end(frame):
    rng = random.Random(5)
    spot = lambda: (51 + rng.random() * 0.002, rng.random() * 0.003)
    lines = frame(VERTICES, *[(r, s, *spot()) for r in range(1500) for s in (0, 1)])
    index = segments.segment_index(lines, Settings(cell_points=32))
    assert index.pieces.count() < 80 * 1500
    places = [spot() for _ in range(40)]
    rows = [r[2:] for r in segments.road_segments(lines).collect()]
    got = {(r.lat, r.lon): r.near_m for r in segments.nearest_on_roads(frame(PLACES, *places), index).collect()}
    assert len(got) == 40
    for place, near_m in got.items():
        assert near_m == pytest.approx(brute(*place, rows), rel=1e-9, abs=1e-6)


def test_pieces_are_neither_stored_nor_shuffled(frame, monkeypatch):
    rng, sizes, plans = random.Random(6), [], []
    spot = lambda: (51 + rng.random() * 0.02, -180.01 + rng.random() * 0.03)
    lines = frame(VERTICES, *[(r, s, *spot()) for r in range(300) for s in (0, 1)])

    def watched(df, label, conf=None):
        extra = {} if conf is None else {"conf": conf}
        for name, value in (conf or {}).items():
            df.sparkSession.conf.set(name, value)
        if label == "pieces-met":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        for name in conf or {}:
            df.sparkSession.conf.unset(name)
        table = session.written(df, label, **extra)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(segments, "written", watched)
    monkeypatch.setattr(segments, "MANY", 300)
    index = segments.segment_index(lines, cell_m=5.0)
    cut = index.pieces.count()
    assert cut > 200 * 300
    sizes.clear()
    places = [spot() for _ in range(30)]
    rows = [r[2:] for r in segments.road_segments(lines).collect()]
    got = {(r.lat, r.lon): r.near_m for r in segments.nearest_on_roads(frame(PLACES, *[(a, turn(b)) for a, b in places]), index).collect()}
    assert len(got) == 30 and max(sizes) < cut / 20
    for place, near_m in got.items():
        assert near_m == pytest.approx(brute(*place, rows), rel=1e-9, abs=1e-6)
    by_cell = [line for p in plans for line in p.splitlines() if "Exchange hashpartitioning" in line and " cell#" in line]
    assert plans and not by_cell


def test_crowded_tiles_are_parted(frame, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(segments, "ENOUGH", 2)
    monkeypatch.setattr(segments, "MANY", 300)
    spot = lambda: (-33 + rng.random() * 0.004, 179.998 + rng.random() * 0.004)
    lines = frame(VERTICES, *[(r, s, a, turn(b)) for r in range(150) for s in range(3) for a, b in [spot()]])
    index = segments.segment_index(lines, Settings(group_rows=400), cell_m=20.0)
    # Some are near roads, and two a few cells away.
    places = [spot() for _ in range(60)] + [(-33.006, -179.999), (-32.999, 179.99)]
    places = [(a, turn(b)) for a, b in places]
    rows = [r[2:] for r in segments.road_segments(lines).collect()]
    got = {(r.lat, r.lon): r.near_m for r in segments.nearest_on_roads(frame(PLACES, *places), index).collect()}
    assert len(got) == len(places)
    for place, near_m in got.items():
        assert near_m == pytest.approx(brute(*place, rows), rel=1e-9, abs=1e-6)


def test_a_limit_and_no_roads(frame):
    lines = frame(VERTICES, (1, 0, 51.0, 0.0), (1, 1, 51.0, 0.1))
    near = Settings(snap_radius_m=150.0)
    index = segments.segment_index(lines, near)
    found = segments.nearest_on_roads(frame(PLACES, (51.001, 0.05), (51.01, 0.05)), index).collect()
    assert [(r.lat, round(r.near_lon, 6), r.road_id, r.seq) for r in found] == [(51.001, 0.05, 1, 1)]
    empty = segments.segment_index(frame(VERTICES))
    assert segments.nearest_on_roads(frame(PLACES, (51.0, 0.0)), empty).count() == 0


def test_positions_are_snapped_onto_lines(frame):
    lines = frame(VERTICES, (1, 0, 51.0, 0.0), (1, 1, 51.0, 0.1))
    rows = frame("i int, position_latitude double, position_longitude double", (1, 51.0001, 0.03), (2, None, None), (3, 0.0, 0.0))
    got = roads.snap(rows, segments.segment_index(lines)).orderBy("i").collect()
    assert [(r.snapped_lat, r.snapped_lon and round(r.snapped_lon, 9), r.was_snapped) for r in got] == [
        (51.0, 0.03, True), (None, None, False), (None, None, False),
    ]


# Published distances on the WGS 84 ellipsoid, in metres.
KNOWN = [
    ((-37.951033416666666, 144.42486788888888, -37.65282113888889, 143.92649552777777), 54972.271),
    ((0.0, 0.0, 0.0, 1.0), 111319.4908),
    ((0.0, 0.0, 1.0, 0.0), 110574.3886),
    ((0.0, 7.0, 90.0, -50.0), 10001965.7293),
    ((90.0, 0.0, -90.0, 0.0), 20003931.4586),
    ((0.0, 0.0, 0.0, 180.0), 20003931.4586),
]


def test_published_distances(frame):
    schema = "i int, a double, b double, c double, d double"
    rows = frame(schema, *[(i, *p) for i, (p, _) in enumerate(KNOWN)], (90, 51.0, 179.9, 51.0, -179.9), (91, 5.0, 5.0, 5.0, 5.0), (92, None, 0.0, 0.0, 0.0), (93, 0.0, 0.0, 0.5, 179.7))
    got = {r.i: r.m for r in rows.select("i", geodesic(*[F.col(c) for c in "abcd"]).alias("m")).collect()}
    for i, (_, want) in enumerate(KNOWN):
        assert got[i] == pytest.approx(want, abs=1e-3)
    assert got[90] == pytest.approx(14039.531, abs=1e-3) and got[91] == 0.0 and got[92] is None
    # Nearly opposite: not longer than the way over a pole, and not much longer than the shortest.
    assert 19944127.0 < got[93] < 19944127.0 * 1.004


def test_ellipsoid_routes_are_close_to_the_sphere(frame):
    vertices = frame("from_key string, to_key string, seq long, lat double, lon double", *[("a", "b", i, 51 + i / 10, i / 7) for i in range(20)])
    sphere, exact = (roads.build_routes(vertices, ellipsoid=e).agg(F.max("cum_m")).first()[0] for e in (False, True))
    assert 0 < abs(exact / sphere - 1) < 0.006
    one = frame("a double, b double, c double, d double", (51.0, 0.0, 51.1, 1 / 7))
    leg = one.select(haversine(*[F.col(c) for c in "abcd"]).alias("m")).first().m
    assert roads.build_routes(vertices).filter("seq = 1").first().cum_m == pytest.approx(leg, abs=1e-8)
