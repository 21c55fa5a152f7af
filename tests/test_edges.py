"""Hand-made rows with literal expected results."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from velotrace.functions import dates
from velotrace.functions.geo import haversine, point_key
from velotrace.operators import clean, events, manifest, regions, reports, roads, trips
from velotrace.settings import Settings


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]


# ---- regions and dates


def test_device_names(frame):
    names = [" as001", "xx1", "ZZ9", None, "", "hel 7", "HL1", "bAe2"]
    df = frame("i int, device_name string", *enumerate(names))
    assert column(regions.add_region(df), "region", "i") == [
        "england", "ireland", None, None, None, "finland", "england", "england",
    ]


def test_first_listed_prefix_wins(frame):
    df = frame("device_name string", ("ABC1",))
    prefixes = {"one": ["AB"], "two": ["ABC"]}
    assert regions.add_region(df, prefixes=prefixes).first().region == "one"


def test_region_tables(spark):
    assert regions.prefix_table(spark).orderBy("ord").first().prefix == "AS"
    names = regions.all_regions(spark, exact={"wales": ["A"], "malta": ["B"]})
    assert names.count() == 6


def test_device_name_is_required(frame):
    with pytest.raises(ValueError):
        regions.add_region(frame("a int", (1,)))


@pytest.mark.parametrize(
    "text, day",
    [
        ("2025/08/13", "2025-08-13"), ("2025-08-13", "2025-08-13"), ("20250813", "2025-08-13"),
        ("2025/0813", "2025-08-13"), ("2025/13/01", None), ("2025-02-30", None), ("x", None),
        ("", None), ("202508133", None),
    ],
)
def test_day_spellings(frame, text, day):
    row = frame("t string", (text,)).select(dates.dash_day(dates.parse_day(F.col("t"))).alias("d"), dates.is_day(F.col("t")).alias("ok")).first()
    assert (row.d, row.ok) == (day, day is not None)
    if day:
        assert dates.as_day(text).isoformat() == day
    else:
        with pytest.raises(ValueError):
            dates.as_day(text)


def test_yesterday():
    assert dates.yesterday(datetime(2025, 3, 1, 1)) == date(2025, 2, 28)


def test_expiry_counts_the_time_of_day(frame):
    df = frame("date date", (date(2025, 8, 8),), (date(2025, 8, 9),))
    at_night = manifest.expired_slices(df, datetime(2025, 8, 13), 5)
    in_the_morning = manifest.expired_slices(df, datetime(2025, 8, 13, 3, 30), 5)
    assert at_night.count() == 0
    assert [r.date for r in in_the_morning.collect()] == [date(2025, 8, 8)]


def test_file_days(frame):
    df = frame(
        "name string", ("20250813",), ("combined_20250813",), ("combined_trips_20250813",),
        ("20250813_abnormal_events",), ("20250899",), ("other_20250813",),
    )
    found = [r[0] for r in df.select(dates.compact_day(manifest.file_day())).collect()]
    assert found == ["20250813"] * 4 + [None] * 2


# ---- cleaning


def test_zero_coordinates(frame):
    df = frame(
        "i int, position_latitude double, position_longitude double",
        (0, 0.0, 51.5), (1, 0.0, 0.0), (2, None, 1.0), (3, 51.0, 1.0),
    )
    assert column(df.withColumn("x", clean.can_snap()), "x", "i") == [False, False, False, True]
    assert column(df.withColumn("x", events.has_position()), "x", "i") == [True, False, False, True]


def test_sorting_puts_nulls_last(frame):
    df = frame("device_id long, timestamp double", (2, 1.0), (None, 0.0), (1, None), (1, 5.0))
    rows = clean.sort_rows(df).collect()
    assert [tuple(r) for r in rows] == [(1, 5.0), (1, None), (2, 1.0), (None, 0.0)]


def test_serials_and_text(frame):
    df = frame("device_serial_number string, timestamp string", ("S", "1"), (None, "x"), (None, "NaN"), (None, "2"))
    rows = clean.coerce_numeric(clean.without_serial(df)).collect()
    assert sorted([r.timestamp for r in rows], key=str) == [2.0, None, None]
    assert clean.without_serial(df.drop("device_serial_number")).count() == 4


def test_equal_coordinates_of_two_devices(frame):
    df = frame(
        "device_id long, timestamp double, position_latitude double, position_longitude double",
        (2, 1.0, 51.0, 0.5), (1, 9.0, 51.0, 0.5), (1, 10.0, 51.0, 0.6),
    )
    kept = clean.blank_repeats(df).orderBy("device_id", "timestamp").collect()
    assert [r.position_latitude for r in kept] == [51.0, 51.0, None]


# ---- trips

ROWS = "device_id long, timestamp double, snapped_lat double, snapped_lon double, position_speed double"


def test_break_is_a_gap_above_the_limit(frame):
    df = frame(ROWS, *[(1, t, 51 + i / 1000, 0.0, 5.0) for i, t in enumerate([0.0, 1800.0, 3601.0, 3700.0, 3800.0])])
    rows = trips.trip_metrics(df).orderBy("timestamp").collect()
    assert [r.time_s for r in rows] == [0.0, 1800.0, -1.0, 99.0, 100.0]
    assert [r.trip_break for r in rows] == [False, False, True, False, False]
    assert [r.trip_id for r in rows] == ["1-0", "1-0", "1-1", "1-1", "1-1"]
    # The first located row after the opening row of a trip has distance 0.
    assert [round(r.distance_m) for r in rows] == [0, 0, 0, 0, 111]
    strict = trips.trip_metrics(df, first_fix_rule="strict").orderBy("timestamp").collect()
    assert [round(r.distance_m) for r in strict] == [0, 111, 0, 111, 111]


def test_one_row_and_no_device(frame):
    df = frame(ROWS, (1, 1.0, 51.0, 0.0, 5.0), (None, 1.0, 51.0, 0.0, 5.0), (None, 2.0, 51.0, 0.0, 5.0))
    for r in trips.trip_metrics(df).collect():
        assert (r.distance_m, r.time_s, r.trip_break) == (None, None, False)


def test_speed_cap_and_missing_time(frame):
    df = frame(
        ROWS, (1, 0.0, 51.0, 0.0, 5.0), (1, 10.0, 51.0, 0.0, 5.0), (1, 11.0, 51.01, 0.0, 5.0),
        (1, 111.0, 51.011, 0.0, 5.0), (1, 211.0, None, None, 7.0), (1, None, 51.0, 0.0, 9.0),
    )
    rows = trips.trip_metrics(df).orderBy(F.col("timestamp").asc_nulls_last()).collect()
    assert [r.position_speed for r in rows][:3] == [5.0, 0.0, 0.0]
    assert rows[3].position_speed == pytest.approx(rows[3].distance_m / 100 * 3.6)
    assert rows[4].position_speed == 7.0 and rows[4].distance_m == 0.0
    assert rows[5].time_s is None and rows[5].position_speed == 9.0


def test_road_distance_replaces_the_straight_line(frame):
    df = frame(ROWS, *[(1, t * 1.0, 51 + t / 1000, 0.0, 5.0) for t in range(3)])
    lat = F.lit(51.001), F.lit(0.0), F.lit(51.002), F.lit(0.0)
    table = frame("total_m double", (500.0,)).select(
        point_key(*lat[:2]).alias("from_key"), point_key(*lat[2:]).alias("to_key"), "total_m"
    )
    assert column(trips.trip_metrics(df, road_distances=table), "distance_m", "timestamp") == [0.0, 0.0, 500.0]


# ---- gaps

GAP_ROWS = (
    "device_id long, timestamp double, snapped_lat double, snapped_lon double, was_snapped boolean, "
    "position_speed double, time_diff double"
)


def known(t, lat, lon=0.0, device=1):
    return (device, float(t), lat, lon, False, None, 1.0)


def unknown(t, speed=None, device=1):
    return (device, float(t), None, None, False, speed, 1.0)


def route(frame, *lats, p=(51.0, 51.1)):
    ends = [point_key(F.lit(x), F.lit(0.0)) for x in p]
    rows = frame("seq int, lat double", *enumerate(lats))
    return roads.build_routes(
        rows.select(ends[0].alias("from_key"), ends[1].alias("to_key"), "seq", "lat", F.lit(0.0).alias("lon"))
    )


def test_leading_and_trailing_rows_stay_unknown(frame):
    df = frame(GAP_ROWS, unknown(0), known(1, 51.0), unknown(2), known(3, 51.1), unknown(4), unknown(5, device=2))
    for fill in (roads.interpolate_gaps, roads.fill_missing):
        assert [x is None for x in column(fill(df), "snapped_lat", "timestamp")] == [
            True, False, False, False, True, True,
        ]


@pytest.mark.parametrize(
    "missing, vertices",
    [(1, 3), (1, 11), (2, 11), (5, 11), (9, 11), (10, 11), (12, 11), (3, 2), (1, 2), (4, 3), (7, 40)],
)
def test_spread_of_vertices(frame, missing, vertices):
    if missing <= vertices - 2:
        expected = list(np.linspace(1, vertices - 2, missing, dtype=int))
    else:
        expected = list(range(1, vertices - 1))
        expected += [vertices - 2] * (missing - len(expected))
    df = frame("k int", *[(k,) for k in range(missing)])
    found = df.select("k", roads.spread_index(F.col("k"), F.lit(missing), F.lit(vertices)).alias("i"))
    assert column(found, "i", "k") == expected


def test_fill_takes_vertices_of_the_route(frame):
    lats = [51.0, 51.02, 51.05, 51.09, 51.1]
    df = frame(GAP_ROWS, known(0, 51.0), unknown(1), unknown(2), known(3, 51.1))
    filled = roads.fill_missing(df, routes=route(frame, *lats))
    assert column(filled, "snapped_lat", "timestamp") == [51.0, 51.02, 51.09, 51.1]
    other = roads.fill_missing(df, routes=route(frame, *lats, p=(1.0, 2.0)))
    assert column(other, "snapped_lat", "timestamp") == [51.0, None, None, 51.1]


def test_progress_by_speed_and_by_share(frame):
    lats = [51 + i / 100 for i in range(11)]
    metre = 1 / 111194.93
    speed = 0.012 / metre * 3.6
    df = frame(
        GAP_ROWS, known(0, 51.0), unknown(1, speed), unknown(2, speed), unknown(3), unknown(4, speed), known(5, 51.1)
    )
    filled = roads.interpolate_gaps(df, routes=route(frame, *lats))
    # 0.012 and 0.024 degrees by speed, then three fifths of the way, then 0.012 further.
    assert [round(x, 6) for x in column(filled, "snapped_lat", "timestamp")] == [51.0, 51.01, 51.02, 51.06, 51.07, 51.1]


def sequential(rows, lats):
    """The gap rule, row by row, for one gap between rows[0] and rows[-1]."""
    dists = [0.0]
    for a, b in zip(lats, lats[1:]):
        dists.append(dists[-1] + 6371000 * np.radians(abs(b - a)))
    progress, out = 0.0, []
    for i, (_, _, _, _, _, speed, dt) in enumerate(rows[1:-1], 1):
        if speed is not None and dt > 0:
            progress += speed / 3.6 * dt
        else:
            progress = dists[-1] * i / (len(rows) - 1)
        progress = max(0, min(progress, dists[-1]))
        out.append(lats[int(np.argmin(np.abs(np.array(dists) - progress)))])
    return out


@pytest.mark.parametrize("group_rows", [10**6, 5])
def test_gaps_against_the_sequential_rule(frame, group_rows):
    r = np.random.default_rng(5)
    lats = sorted({51.0, 51.1, *[round(51 + float(x), 5) for x in r.uniform(0, 0.1, 9)]})
    rows = [known(0, 51.0)]
    for t in range(1, 40):
        speed = None if r.random() < 0.2 else float(r.uniform(0, 4000))
        rows.append((1, float(t), None, None, False, speed, float(r.integers(0, 3))))
    rows.append(known(40, 51.1))
    filled = roads.interpolate_gaps(
        frame(GAP_ROWS, *rows), Settings(group_rows=group_rows), routes=route(frame, *lats)
    )
    assert column(filled, "snapped_lat", "timestamp")[1:-1] == sequential(rows, lats)


def test_vertices_off_the_road_wait_for_the_fill_pass(frame):
    lats = [51.0, 51.03, 51.06, 51.1]
    df = frame(GAP_ROWS, known(0, 51.0), unknown(1), unknown(2), known(3, 51.1))
    points, table = frame("lat double, lon double", (51.0301, 0.0)), route(frame, *lats)
    limited = Settings(snap_radius_m=100.0)
    passed = roads.interpolate_gaps(df, limited, table, roads.road_index(points, limited))
    assert column(passed, "snapped_lat", "timestamp") == [51.0, 51.0301, None, 51.1]
    # Without a limit every vertex has a nearest road.
    passed = roads.interpolate_gaps(df, routes=table, roads=roads.road_index(points))
    assert column(passed, "snapped_lat", "timestamp") == [51.0, 51.0301, 51.0301, 51.1]


def test_nearest_vertex_prefers_the_earlier(frame):
    table = frame(
        "from_key string, to_key string, seq int, lat double, lon double, cum_m double",
        ("a", "b", 0, 1.0, 0.0, 0.0), ("a", "b", 1, 2.0, 0.0, 10.0), ("a", "b", 2, 3.0, 0.0, 10.0), ("a", "b", 3, 4.0, 0.0, 30.0),
    )
    asked = frame("from_key string, to_key string, m double", *[("a", "b", m) for m in (0.0, 5.0, 5.1, 10.0, 20.0, 99.0)])
    assert column(roads.nearest_vertex(asked, table, "m"), "vertex_seq", "m") == [0, 0, 1, 1, 1, 3]


# ---- events


def accel_rows(frame, peaks, **columns):
    rows = [(1, float(i), 51.0, 0.5, *p) for i, p in enumerate(peaks)]
    df = frame(
        "device_id long, timestamp double, position_latitude double, position_longitude double, "
        "peak_x double, peak_y double, peak_z double",
        *rows,
    )
    return df.withColumns({f"avg_{a}": F.lit(0.0) for a in "xyz"})


def spread_peaks(n):
    return [((i + 1) ** 3 / 1e4, 0.1 * (i % 3) / 1e3, 0.2 / 1e4) for i in range(n)]


def test_ten_active_rows_are_needed(frame):
    for n, found in ((9, 0), (10, 1)):
        peaks = [(1.0 + i / 10, 0.1, 0.1) for i in range(n - 1)] + [(50.0, 0.1, 0.1)]
        assert events.abnormal_events(accel_rows(frame, peaks)).count() == found


def test_largest_peak_has_severity_ten(frame):
    found = events.abnormal_events(accel_rows(frame, spread_peaks(100))).collect()
    assert max(r.severity for r in found) == 10
    assert {r.event_type for r in found} == {"hard_brake"}
    assert {r.original_index for r in found} == {95, 96, 97, 98, 99}


def test_constant_axis_and_the_percentile_itself(frame):
    constant = [(5.0, 0.1, 0.1)] * 20
    assert events.abnormal_events(accel_rows(frame, constant)).count() == 0
    at_most = [(float(i % 10), 0.1, 0.1) for i in range(200)]
    assert events.abnormal_events(accel_rows(frame, at_most), Settings(quantile=100.0)).count() == 0


def test_missing_channels_and_missing_peaks(frame):
    df = accel_rows(frame, spread_peaks(40)).drop("avg_x")
    empty = events.abnormal_events(df)
    assert empty.columns[:2] == ["event_type", "severity"] and empty.count() == 0
    holes = accel_rows(frame, spread_peaks(40) + [(None, 1e-4, 1e-5)])
    assert events.abnormal_events(holes).count() > 0
    assert events.abnormal_events(holes, null_policy="reference").filter("event_type = 'hard_brake'").count() == 0


def test_dotted_channels(frame):
    df = accel_rows(frame, spread_peaks(60))
    dotted = df.withColumnsRenamed({v: k for k, v in events.ACCEL_CHANNELS.items()})
    assert events.abnormal_events(dotted).exceptAll(events.abnormal_events(df)).count() == 0


def test_low_dominance_gives_several_events_per_row(frame):
    peaks = [(1.0 + i / 100, 1.0 + i / 100, 0.5) for i in range(50)] + [(9.0, 9.0, 0.5)]
    found = events.abnormal_events(accel_rows(frame, peaks), Settings(dominance=0.9))
    assert sorted(r.event_type for r in found.filter("peak_value = 9").collect()) == ["hard_brake", "swerve"]


def test_severity_truncates(frame):
    df = frame("p double", (1.0,), (2.0,), (2.5,), (5.9,), (6.0,))
    score = events.severity(F.col("p"), F.lit(2.0), F.lit(6.0))
    assert column(df.withColumn("s", score), "s", "p") == [1, 1, 3, 9, 10]


def test_approximate_statistics_are_close(frame):
    rows = events.active_rows(accel_rows(frame, spread_peaks(400)))
    exact = events.axis_statistics(rows).first()
    near = events.axis_statistics(rows, accuracy=10_000).first()
    assert near.threshold_x == pytest.approx(exact.threshold_x, rel=0.02)
    assert near.n == exact.n == 400


# ---- reports


def test_detection_scores_without_detections(frame):
    schema = "event_type string, time double, severity int"
    truth, none = frame(schema, ("swerve", 1.0, 3)), frame(schema)
    row = reports.detection_metrics(reports.match_events(truth, none), none).first()
    assert (row.precision, row.recall, row.f1_score, row.false_negatives) == (0.0, 0.0, 0.0, 1)


def test_match_tolerance_is_inclusive(frame):
    schema = "event_type string, time double, severity int"
    truth = frame(schema, ("swerve", 10.0, 3), ("swerve", 20.0, 4))
    found = frame(schema, ("swerve", 5.0, 1), ("swerve", 15.0, 2), ("pothole", 20.0, 9))
    rows = reports.match_events(truth, found).orderBy("time").collect()
    assert [r.detected_time for r in rows] == [5.0, 15.0]


def test_risk_score_is_clamped_once(frame):
    s = [9] * 30 + [1] * 100
    df = frame("device_id long, timestamp double, severity int", *[(1, 1.7e9, x) for x in s])
    assert reports.risk_score(df).first().risk_score == 0.0


def test_quality_of_a_poor_table(frame):
    df = frame("device_id long, record_seqnum long, timestamp double, peak_x double", (1, 1, 5.0, 60.0), (1, 2, 4.0, 1.0))
    row = reports.quality_report(df).first()
    assert not row.passed and "snapped_lat" in row.errors
    assert (row.extreme_x, row.late_rows) == (1, 1)


def test_haversine_of_unknown_points_is_unknown(frame):
    df = frame("lat double", (None,))
    assert df.select(haversine(F.col("lat"), F.lit(0.0), F.lit(0.0), F.lit(0.0))).first()[0] is None


def test_haversine_of_opposite_points(frame):
    m = frame("a int", (1,)).select(haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()[0]
    assert m == pytest.approx(np.pi * 6371000)
