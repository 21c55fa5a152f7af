"""Sketches of slices, the event roll-up and the prefix table on literal rows."""

import pytest
from pyspark.sql import functions as F

from velotrace.operators import events, regions, sketches
from velotrace.settings import Settings

NAN = float("nan")


def asked(spark_rows, by=()):
    merged = sketches.united(spark_rows, by)
    return merged.select(
        *by,
        "rows",
        sketches.distinct_counts(spark_rows, ["d"])["d"].alias("d"),
        sketches.quantile("x", 0.5).alias("median"),
        sketches.quantile("x", 1.0).alias("most"),
        sketches.deviation("x", sketches.quantile("x", 0.5)).alias("away"),
    )


def test_nulls_nans_and_groups_without_values(frame):
    rows = frame(
        "g string, d long, x double",
        ("a", 1, 1.0), ("a", 1, 2.0), ("a", None, 3.0), ("b", None, None), ("b", None, NAN), (None, 7, 5.0),
    )
    stored = sketches.slice_sketches(rows, ["g"], ["d"], ["x"])
    found = {r.g: (r.rows, r.d, r.median, r.most) for r in asked(stored, ["g"]).collect()}
    assert found == {"a": (3, 1, 2.0, 3.0), "b": (2, 0, None, None), None: (1, 1, 5.0, 5.0)}


def test_an_empty_table(frame):
    stored = sketches.slice_sketches(frame("g string, d long, x double"), ["g"], ["d"], ["x"])
    assert asked(stored, ["g"]).collect() == []
    (total,) = asked(stored).collect()
    assert (total.rows, total.d, total.median, total.away) == (None, 0, None, None)


def test_united_slices_are_within_the_stated_errors(spark):
    n = 200_000
    value = F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double")
    rows = spark.range(n).select((F.col("id") % 30).alias("day"), (F.col("id") % 77_777).alias("d"), value.alias("x"))
    stored = sketches.slice_sketches(rows, ["day"], ["d"], ["x"])
    (r,) = asked(stored).collect()
    assert r.rows == n and abs(r.d / 77_777 - 1) < 4 * 0.0081
    below = rows.agg(
        F.count_if(F.col("x") <= r.median).alias("median"), F.count_if(F.abs(F.col("x") - r.median) <= r.away).alias("away")
    ).first()
    assert abs(below["median"] / n - 0.5) < sketches.RANK_ERROR
    assert abs(below["away"] / n - 0.5) < 2 * sketches.RANK_ERROR + 1 / sketches.STEPS


def test_merging_in_any_order_gives_equal_small_groups(frame):
    rows = [(i % 5, i, float(i)) for i in range(600)]
    stored = sketches.slice_sketches(frame("day long, d long, x double", *rows), ["day"], ["d"], ["x"])
    (r,) = asked(stored).collect()
    (one,) = asked(sketches.slice_sketches(frame("day long, d long, x double", *rows), [], ["d"], ["x"])).collect()
    assert r == one and (r.d, r.median, r.most) == (600, 299.0, 599.0)


def test_a_null_level_and_a_subtotal_differ(frame):
    rows = frame(
        "region string, event_type string, severity int, peak_value double",
        ("n", "swerve", 3, 1.0), ("n", "swerve", 3, 2.0), (None, "swerve", 3, 5.0), (None, "pothole", 4, 4.0),
    )
    found = {(r.region, r.event_type, r.severity, r.depth): (r.events, r.highest_peak) for r in events.event_rollup(rows).collect()}
    assert found[None, None, None, 0] == (4, 5.0)
    assert found[None, None, None, 1] == (2, 5.0)
    assert found["n", None, None, 1] == (2, 2.0)
    assert found["n", "swerve", 3, 3] == (2, 2.0)
    assert len(found) == 1 + 2 + 3 + 3


def test_no_events_give_no_subtotals(frame):
    empty = frame("region string, event_type string, severity int, peak_value double")
    assert [r.depth for r in events.event_rollup(empty).collect()] in ([], [0])


NAMES = [(1, " as12 "), (2, "AS"), (3, "a"), (4, None), (5, ""), (6, "AS12"), (7, "zz"), (8, "\tAs1x")]
PREFIX = "ord long, region string, prefix string"


@pytest.mark.parametrize("settings", [Settings(), Settings(group_rows=2, broadcast_rows=1)])
def test_the_lowest_order_wins(frame, settings):
    names = frame("id long, device_name string", *NAMES)
    table = frame(PREFIX, (5, "long", "AS1"), (3, "short", "as"), (4, "exact", "AS12"), (3, "early", "As"), (1, "none", None))
    found = {r.id: r.region for r in regions.region_by_table(names, table, settings).collect()}
    assert found == {1: "early", 2: "early", 3: None, 4: None, 5: None, 6: "early", 7: None, 8: "early"}
    longest = frame(PREFIX, (1, "long", "AS1"), (9, "any", ""))
    found = {r.id: r.region for r in regions.region_by_table(names, longest, settings).collect()}
    assert found == {1: "long", 2: "any", 3: "any", 4: None, 5: "any", 6: "long", 7: "any", 8: "long"}


def test_a_table_without_prefixes(frame):
    names = frame("id long, device_name string", *NAMES)
    assert {r.region for r in regions.region_by_table(names, frame(PREFIX)).collect()} == {None}
    assert regions.region_by_table(frame("id long, device_name string"), frame(PREFIX)).count() == 0


def test_deviation_finds_its_middle_once_per_row(spark):
    stored = sketches.slice_sketches(spark.range(50).withColumn("v", F.col("id").cast("double")), [], (), ["v"])
    answer = sketches.united(stored).select(sketches.deviation("v", sketches.quantile("v", 0.5)).alias("d"))
    assert 11.0 <= answer.first().d <= 14.0
    plan = answer._jdf.queryExecution().optimizedPlan().toString()
    inside = [part.split(", lambda ")[0] for part in plan.split("lambdafunction(")[1:]]
    assert inside and not [x for x in inside if "kll" in x]
