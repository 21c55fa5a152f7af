"""The spatial index against brute force, in dense places, across the antimeridian and at a pole."""

import random

import numpy as np
import pytest

from velotrace.operators import spatial
from velotrace.settings import Settings


def places():
    r = random.Random(1)
    return (
        [(51 + r.gauss(0, 1e-4), r.gauss(0, 1e-4)) for _ in range(300)]
        + [(r.uniform(-0.01, 0.01), 180 - r.random() * 0.003) for _ in range(60)]
        + [(r.uniform(-0.01, 0.01), -180 + r.random() * 0.003) for _ in range(60)]
        + [(89.9995 + r.random() * 0.0005, r.uniform(-180, 180)) for _ in range(40)]
        + [(75 + r.random() * 0.005, r.random() * 0.02) for _ in range(100)]
    )


@pytest.mark.parametrize("cell_points", [128, 3])
def test_against_brute_force(spark, cell_points):
    r = random.Random(2)
    points = places()
    queries = [
        (min(90.0, a + r.gauss(0, 3e-4)), max(-180.0, min(179.99999, o + r.gauss(0, 3e-4))))
        for a, o in points
    ]
    index = spatial.index_places(
        spark.createDataFrame(points, "lat double, lon double"),
        100.0,
        settings=Settings(cell_points=cell_points, broadcast_rows=50 if cell_points == 3 else 10**6),
    )
    assert (len(index.levels) > 2) == (cell_points == 3)
    asked = spark.createDataFrame(queries, "lat double, lon double").distinct()
    near = {(x.lat, x.lon): x for x in spatial.nearest(asked, index).collect()}
    within = {(x.lat, x.lon): x.rows for x in spatial.totals_within(asked, index, []).collect()}
    p = np.radians(np.array(points))
    for lat, lon in queries:
        la, lo = np.radians([lat, lon])
        a = np.sin((p[:, 0] - la) / 2) ** 2 + np.cos(la) * np.cos(p[:, 0]) * np.sin((p[:, 1] - lo) / 2) ** 2
        m = 2 * 6371000 * np.arcsin(np.sqrt(np.minimum(1, a)))
        assert within.get((lat, lon), 0) == (m <= 100).sum()
        if m.min() <= 100:
            assert near[(lat, lon)].near_m == pytest.approx(m.min(), abs=1e-6)
        else:
            assert (lat, lon) not in near


def test_all_copies_count(spark):
    points = spark.createDataFrame([(51.0, 0.0, 2.0)] * 500, "lat double, lon double, w double")
    index = spatial.index_places(points, 50.0, ["w"], Settings(cell_points=4))
    row = spatial.totals_within(points.select("lat", "lon").distinct(), index, ["w"]).first()
    assert (row.rows, row.w) == (500, 1000.0)


def test_most_places_are_found_without_refined_cells(spark, monkeypatch):
    r = random.Random(3)
    spread = [(51 + r.random() * 0.02, r.random() * 0.02) for _ in range(4000)]
    # One flat cell is crowded; it must still be searched.
    crowd = [(51.01 + r.random() * 1e-7, 0.01 + r.random() * 1e-7) for _ in range(1500)]
    points = spark.createDataFrame(spread + crowd, "lat double, lon double")
    queries = [(51 + r.random() * 0.02, r.random() * 0.02) for _ in range(300)] + [(51.01, 0.01), (51.5, 0.0)]
    refined, asked = spatial._refined, []
    monkeypatch.setattr(spatial, "_refined", lambda q, i: asked.append((q.count(), i.places.count())) or refined(q, i))
    index = spatial.index_places(points, 100.0)
    found = spatial.nearest(spark.createDataFrame(queries, "lat double, lon double"), index).collect()
    assert len(asked) == 1 and asked[0][0] < 30 and asked[0][1] < len(spread) + len(crowd)
    p = np.radians(np.array(spread + crowd))
    near = {(x.lat, x.lon): x.near_m for x in found}
    assert set(near) == set(queries[:-1])
    for lat, lon in near:
        la, lo = np.radians([lat, lon])
        a = np.sin((p[:, 0] - la) / 2) ** 2 + np.cos(la) * np.cos(p[:, 0]) * np.sin((p[:, 1] - lo) / 2) ** 2
        assert near[(lat, lon)] == pytest.approx((2 * 6371000 * np.arcsin(np.sqrt(a))).min(), abs=1e-6)
