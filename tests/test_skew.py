"""Large groups take another way through the operators; the results must not differ."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from velotrace import session
from velotrace.checks import event_queries, road_queries
from velotrace.checks.views import telemetry
from velotrace.operators import clean, events, joins, ordered, reports, roads, trips
from velotrace.operators.quantiles import quantiles
from velotrace.plans import daily
from velotrace.settings import Settings
from tests.conftest import SMALL

TINY = Settings(group_rows=150)


def same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def hot_rows(spark, n=900):
    """One device holds two thirds of the rows; a third of all are exact copies of one row."""
    random.seed(7)
    rows = []
    for i in range(n):
        device = None if i % 29 == 0 else 1 if i % 3 else i % 11 + 2
        time = None if i % 41 == 0 else float(random.randint(0, 40_000))
        known = random.random() < 0.3
        lat = 51 + random.randint(0, 40) / 1000 if known else None
        rows.append((device, time, time, i, lat, -0.5 if known else None, float(i % 50)))
    rows += [(1, 500.0, 500.0, 5000, 51.5, -0.4, 10.0)] * (n // 2)
    schema = (
        "device_id long, timestamp double, position_timestamp double, record_seqnum long, "
        "position_latitude double, position_longitude double, position_speed double"
    )
    return spark.createDataFrame(rows, schema)


def test_chunks_are_used_and_bounded(spark):
    series = ordered.ordered(hot_rows(spark), ["device_id"], ["timestamp"], TINY)
    sizes = series.split.groupBy("device_id", ordered.CHUNK).count()
    assert sizes.count() > 5
    assert sizes.agg(F.max("count")).first()[0] < 4 * TINY.group_rows
    assert series.rows.count() == hot_rows(spark).count()


def test_window_functions(spark):
    df = hot_rows(spark).withColumn("v", F.col("position_latitude"))

    def run(settings):
        series = ordered.ordered(df, ["device_id"], ["timestamp", "record_seqnum"], settings)
        series = ordered.scan(
            ordered.numbered(series, "nth"),
            prev=ordered.previous(F.struct("timestamp", "v")),
            before=ordered.last_before(F.col("v")),
            after=ordered.first_after(F.col("v")),
            total=ordered.running_sum(F.col("record_seqnum")),
            top=ordered.running_max(F.col("v")),
            size=ordered.series_size(),
            all=ordered.series_total(F.col("record_seqnum")),
        )
        return series.done()

    same(run(Settings()), run(TINY))


def test_whole_table_series(spark):
    df = hot_rows(spark)

    def run(settings):
        return ordered.scan(ordered.ordered(df, [], ["timestamp"], settings), nth=ordered.row_count()).done()

    places = run(TINY)
    assert places.agg(F.max("nth"), F.count_distinct("nth")).first() == (df.count(), df.count())
    same(run(Settings()), places)


def test_trips_and_gaps(spark):
    df = hot_rows(spark)

    def run(settings):
        rows = clean.blank_repeats(clean.preprocess(df, settings), settings)
        rows = roads.interpolate_gaps(roads.snap(rows, None, settings), settings)
        rows = roads.fill_missing(rows, settings)
        return trips.trip_metrics(rows, settings).withColumns(
            {c: F.round(c, 6) for c in ("distance_m", "position_speed", "snapped_lat")}
        )

    same(run(Settings()), run(TINY))


def test_whole_enrichment(spark):
    df = hot_rows(spark).withColumn("date", F.lit("2025-08-13"))
    road = spark.range(400).select(
        (F.lit(51) + F.col("id") / 10000).alias("lat"), F.lit(-0.5).alias("lon")
    )
    for more in ({}, {"road_points": road}):

        def run(settings):
            return daily.enrich(df, settings, within=["date"], **more).withColumns(
                {c: F.round(c, 6) for c in ("distance_m", "position_speed", "snapped_lat")}
            )

        plain = run(Settings())
        assert plain.count() == df.count()
        same(plain, run(TINY))


def test_only_one_copy_keeps_its_coordinates(spark):
    kept = clean.blank_repeats(hot_rows(spark), TINY).filter("position_latitude = 51.5")
    assert kept.count() == 1


@pytest.mark.parametrize("by", [(), ("device_id",)])
def test_quantiles(spark, by):
    random.seed(3)
    values = [random.gauss(0, 1) ** 3 for _ in range(3000)] + [0.25] * 1500 + [None] * 50
    rows = [(None if i % 7 == 0 else i % 3, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "device_id long, v double")
    probs = {"low": 0.013, "mid": 0.5, "high": 0.95, "top": 1.0, "bottom": 0.0}
    a = quantiles(df, ["v"], probs, by, Settings())
    b = quantiles(df, ["v"], probs, by, Settings(group_rows=100))
    got = {tuple(r[c] for c in by): r for r in b.collect()}
    for r in a.collect():
        other = got[tuple(r[c] for c in by)]
        for label in probs:
            assert other[f"v_{label}"] == pytest.approx(r[f"v_{label}"], rel=1e-12, abs=1e-15)
    if not by:
        known = [v for v in values if v is not None]
        assert a.first()["v_high"] == pytest.approx(np.percentile(known, 95))


def test_events(spark):
    rows = event_queries.trips_with_accel(spark, SMALL)
    for by in ([], ["device_id"]):
        same(events.abnormal_events(rows, Settings(), by), events.abnormal_events(rows, Settings(group_rows=50), by))


def test_lookup_spreads_hot_keys(spark):
    rows = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.when(F.col("id") % 2 == 0, F.col("id"))).alias("k")
    )
    table = spark.range(500).select((F.col("id") * 4).cast("int").alias("k"), F.col("id").alias("v"))
    table = table.unionByName(spark.createDataFrame([(1, -1)], "k int, v long"))
    spread = joins.lookup(rows, table, ["k"], Settings(broadcast_rows=10, group_rows=100))
    same(rows.join(table, "k", "left").select("id", "k", "v"), spread.select("id", "k", "v"))


def test_matching_events(spark):
    truth = event_queries.truths(spark, SMALL)
    found = event_queries.detections(spark, SMALL)
    same(
        reports.match_events(truth, found),
        reports.match_events(truth, found, settings=Settings(group_rows=40)),
    )


def test_nearest_vertex_on_a_long_route(spark):
    rows = telemetry(spark, SMALL).select(
        F.lit("a").alias("from_key"), F.lit("b").alias("to_key"),
        F.col("record_seqnum").cast("int").alias("seq"),
        (F.lit(51) + F.col("record_seqnum") / 10000).alias("lat"), F.lit(0.0).alias("lon"),
    )
    built = roads.build_routes(rows, Settings(group_rows=100))
    plain = roads.build_routes(rows)
    same(
        built.withColumn("cum_m", F.round("cum_m", 4)), plain.withColumn("cum_m", F.round("cum_m", 4))
    )
    asked = rows.select("from_key", "to_key", (F.col("seq") * 7.77 + 0.1).alias("m"))
    same(
        roads.nearest_vertex(asked, plain, "m", Settings(group_rows=100)),
        roads.nearest_vertex(asked, plain, "m"),
    )


def test_a_key_that_is_hot_after_a_shuffle_by_it_is_spread(spark):
    from velotrace.operators.joins import lookup

    rows = spark.range(40_000).selectExpr("id", "0 AS key").repartition(8, "key")
    table = spark.createDataFrame([(0, "x")], "key int, name string")
    few = Settings(group_rows=1000, broadcast_rows=0)
    met = lookup(rows, table, ["key"], few)
    # Small partitions would be merged again, and the small table broadcast after all.
    options = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in options:
            spark.conf.unset(name)
    assert sum(sizes) == 40_000 and len(sizes) > 1 and max(sizes) < 30_000
    assert met.filter("name = 'x'").count() == 40_000


def test_a_table_that_repeats_a_key_is_refused(spark):
    from velotrace.operators.joins import one_per_key

    table = spark.createDataFrame([(1, "a"), (1, "b")], "key int, name string")
    with pytest.raises(ValueError):
        one_per_key(table, ["key"], "names")
    assert one_per_key(table.filter("name = 'a'"), ["key"], "names").count() == 1


def test_no_broadcast_above_the_limit(spark):
    from velotrace.operators.joins import small_side

    rows, table = spark.range(1000), spark.range(100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, found in ((99, False), (100, True)):
            plan = rows.join(small_side(table, Settings(broadcast_rows=limit)), "id")
            assert ("Broadcast" in plan._jdf.queryExecution().executedPlan().toString()) == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def from_source(df):
    """Whether a result still reads the events, and not only tables written on the way."""
    return [f for f in df.inputFiles() if f.endswith("/events.parquet")]


def test_enriched_routes_read_the_events_no_more(spark):
    assert not from_source(road_queries.enriched_routes(spark, SMALL))


def test_routes_are_built_once(spark):
    assert not from_source(road_queries.gap_routes_table(spark, SMALL))


def test_statistics_read_the_events_no_more(spark):
    rows = events.active_rows(event_queries.trips_with_accel(spark, SMALL))
    for limit in (100, 1_000_000):
        assert not from_source(events.axis_statistics(rows, Settings(group_rows=limit)))


def test_cross_validation_reads_the_events_no_more(spark):
    assert not from_source(event_queries.cross_validation(spark, SMALL))


def test_quantiles_of_several_columns_with_nulls_and_ties(spark):
    df = spark.range(6000).selectExpr(
        "id % 3 AS g",
        "CASE WHEN id % 3 <> 0 AND id % 4 <> 1 THEN pow(id * 7919 % 6007, 3) END AS x",
        "CASE WHEN id % 3 <> 0 THEN CAST(id % 5 AS DOUBLE) END AS y",
        "CAST(3 AS INT) AS z",
    )
    probs = {"low": 0.0, "q": 0.123, "mid": 0.5, "top": 1.0}
    extra = [F.count("*").alias("n"), F.max("x").alias("most")]
    for by in ([], ["g"]):
        plain, split = (
            {r[0] if by else None: r for r in quantiles(df, ["x", "y", "z"], probs, by, Settings(group_rows=n), extra).collect()}
            for n in (1_000_000, 7)
        )
        assert plain.keys() == split.keys()
        for k, row in plain.items():
            found = split[k].asDict()
            assert found == {c: v if v is None else pytest.approx(v, rel=1e-12) for c, v in row.asDict().items()}


def test_detection_searches_few_rounds(spark):
    rows = event_queries.trips_with_accel(spark, SMALL)
    with session.scratch(spark):
        folder = Path(session.shared_folder(spark))
        before = len(list(folder.glob("quantile-state-*")))
        found = events.abnormal_events(rows, Settings(group_rows=50))
        # Two searches, of a first round and one that counts off the rank.
        assert len(list(folder.glob("quantile-state-*"))) - before <= 4
        same(events.events_by_type(found), event_queries.events_by_type(spark, SMALL))
