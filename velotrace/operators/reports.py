"""Reports on events and data quality, and alternative detectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrace.functions.dates import epoch_day
from velotrace.operators.events import (
    AXES,
    attach,
    axis_hit,
    explode_hits,
    is_active,
    settle,
)
from velotrace.operators.joins import lookup, one_per_key
from velotrace.operators.ordered import (
    first_after,
    ordered,
    previous,
    row_count,
    running_sum,
    scan,
    series_size,
    series_total,
)
from velotrace.operators.quantiles import quantiles
from velotrace.operators.spatial import index_places, totals_within
from velotrace.schemas import ACCEL_CHANNELS, DEVICE
from velotrace.session import written
from velotrace.settings import Settings

PEAKS = [f"peak_{a}" for a in AXES]


def week_of(seconds: Column) -> Column:
    """The Monday of the UTC week of an instant."""
    return F.to_date(F.date_trunc("week", epoch_day(seconds).cast("timestamp_ntz")))


def month_of(seconds: Column) -> Column:
    return F.trunc(epoch_day(seconds), "month")


def driver_report(events: DataFrame) -> DataFrame:
    """Weekly totals per device, with its two most frequent event types.

    Of types equally frequent the one seen first in the week comes first.
    """
    # Counts per type come first, so the window below sees a few rows per device and week.
    by_type = (
        events.withColumn("week", week_of(F.col("timestamp")))
        .groupBy(DEVICE, "week", "event_type")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("severity") >= 7).alias("severe"),
            F.min(F.struct("timestamp", "original_index")).alias("seen"),
        )
    )
    rank = Window.partitionBy(DEVICE, "week").orderBy(F.col("n").desc(), "seen", "event_type")
    ranked = by_type.withColumn("place", F.row_number().over(rank))
    return ranked.groupBy(DEVICE, "week").agg(
        F.sum("n").alias("total_events"),
        F.sum("severe").alias("severe_events"),
        F.max(F.when(F.col("place") == 1, F.col("event_type"))).alias("top_type"),
        F.max(F.when(F.col("place") == 2, F.col("event_type"))).alias("second_type"),
        F.when(F.sum("severe") > 5, "HIGH").otherwise("NORMAL").alias("coaching_priority"),
    )


def risk_score(events: DataFrame) -> DataFrame:
    """Monthly score per device: 100, less for severe events, more for mild ones, within 0..100."""
    s = F.col("severity")
    change = F.when(s >= 8, -5.0).when(s >= 6, -2.0).when(s <= 3, 0.5).otherwise(0.0)
    total = F.lit(100.0) + F.sum(change)
    return (
        events.withColumn("month", month_of(F.col("timestamp")))
        .groupBy(DEVICE, "month")
        .agg(F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)).alias("risk_score"))
    )


def pothole_clusters(
    events: DataFrame,
    radius_m: float = 50.0,
    min_events: int = 3,
    settings: Settings = Settings(),
) -> DataFrame:
    """Each pothole with at least ``min_events`` potholes, itself included, within the radius.

    Overlapping clusters are all kept.
    """
    potholes = written(
        events.filter(F.col("event_type") == "pothole").withColumns(
            {"lat": F.col("latitude"), "lon": F.col("longitude")}
        ),
        "potholes",
    )
    places = potholes.select(
        "lat", "lon", "severity", F.col("lat").alias("lat_sum"), F.col("lon").alias("lon_sum")
    )
    sums = ["severity", "lat_sum", "lon_sum"]
    index = index_places(places, radius_m, sums, settings)
    around = written(
        totals_within(potholes.select("lat", "lon").distinct(), index, sums), "around-potholes"
    )
    mean = F.col("severity_sum") / F.col("frequency")
    clusters = around.filter(F.col("rows") >= min_events).select(
        "lat",
        "lon",
        F.col("rows").alias("frequency"),
        F.col("severity").alias("severity_sum"),
        "lat_sum",
        "lon_sum",
    )
    return (
        lookup(potholes, clusters, ["lat", "lon"], settings, how="inner")
        .withColumns(
            {
                "center_lat": F.col("lat_sum") / F.col("frequency"),
                "center_lon": F.col("lon_sum") / F.col("frequency"),
                "mean_severity": mean,
                "repair_priority": F.when(mean > 7, "HIGH").otherwise("NORMAL"),
            }
        )
        .drop("lat", "lon", "lat_sum", "lon_sum", "severity_sum")
    )


def match_events(
    truths: DataFrame,
    detected: DataFrame,
    tolerance_s: float = 5.0,
    by: Sequence[str] = (),
    settings: Settings = Settings(),
) -> DataFrame:
    """Each true event with the first detected one of its type within the tolerance, or null.

    Both have ``event_type``, ``time`` and ``severity``. The earliest detection in the window is
    taken, and one detection may match several truths. Truths are placed at the start of their
    window in one series with the detections, so no pairs are formed.
    """
    keys = [*by, "event_type"]
    marks = detected.select(
        *keys,
        F.col("time").alias("_t"),
        F.lit(1).alias("_kind"),
        F.struct(F.col("time"), F.col("severity")).alias("_hit"),
    )
    asked = truths.select(
        *keys,
        (F.col("time") - tolerance_s).alias("_t"),
        F.lit(0).alias("_kind"),
        F.struct("time", "severity").alias("_truth"),
    )
    rows = marks.unionByName(asked, allowMissingColumns=True)
    severity_order = rows.withColumn("_s", F.col("_hit.severity"))
    series = scan(
        ordered(severity_order, keys, ["_t", "_kind", "_s"], settings),
        _next=first_after(F.col("_hit")),
    )
    close = F.col("_next.time") <= F.col("_truth.time") + tolerance_s
    return (
        series.done()
        .filter(F.col("_kind") == 0)
        .select(
            *keys,
            F.col("_truth.time").alias("time"),
            F.col("_truth.severity").alias("severity"),
            F.when(close, F.col("_next.time")).alias("detected_time"),
            F.when(close, F.col("_next.severity")).alias("detected_severity"),
        )
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def detection_metrics(
    matches: DataFrame, detected: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall and F1 of matched truths, per group if given."""
    by = list(by)
    hits = matches.groupBy(*by).agg(
        F.count("*").alias("truths"), F.count("detected_time").alias("true_positives")
    )
    found = detected.groupBy(*by).agg(F.count("*").alias("detections"))
    # Grouping keeps null groups together, as a join on the group would not.
    counts = ("true_positives", "detections", "truths")
    both = (
        hits.unionByName(found, allowMissingColumns=True)
        .groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    tp, n, m = (F.coalesce(F.col(c), F.lit(0)) for c in counts)
    precision, recall = _ratio(tp, n), _ratio(tp, m)
    return both.select(
        *by,
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1_score"),
        tp.alias("true_positives"),
        (n - tp).alias("false_positives"),
        (m - tp).alias("false_negatives"),
    )


def severity_accuracy(matches: DataFrame) -> DataFrame:
    """How far the detected severity of matched events is from the true one."""
    off = F.abs(F.col("detected_severity") - F.col("severity"))
    return matches.filter(F.col("detected_time").isNotNull()).agg(
        F.avg(off).alias("mean_absolute_error"),
        F.sqrt(F.avg(off * off)).alias("root_mean_square_error"),
        F.max(off).alias("max_error"),
        F.corr("detected_severity", "severity").alias("severity_correlation"),
    )


def cross_validate(
    active: DataFrame,
    truths: DataFrame,
    grid: Sequence[tuple[float, float, float]],
    settings: Settings = Settings(),
    tolerance_s: float = 5.0,
) -> DataFrame:
    """Mean F1 over the folds of each (quantile, mad limit, dominance), best first.

    ``active`` and ``truths`` carry their ``fold``. Statistics are taken once per fold for all
    parameters, and rows that no parameter can accept are dropped before they are repeated.
    """
    by = ["fold"]
    # Both are read several times.
    active = written(active.select(*by, "timestamp", *PEAKS), "active-rows")
    truths = written(truths.select(*by, "event_type", "time", "severity"), "truths")
    values = active.select(*by, *PEAKS)
    levels = sorted({q for q, _, _ in grid})
    probs = {f"q{i}": q / 100 for i, q in enumerate(levels)} | {"median": 0.5}
    sizes = [F.count("*").alias("n")] + [F.max(p).alias(f"max_{p[-1]}") for p in PEAKS]
    middle = settle(quantiles(values, PEAKS, probs, by, settings, sizes), by)
    away = attach(values, middle, by, settings).select(
        *by, *[F.abs(F.col(p) - F.col(f"{p}_median")).alias(p) for p in PEAKS]
    )
    spread = settle(quantiles(away, PEAKS, {"mad": 0.5}, by, settings), by)
    rows = attach(attach(active, middle, by, settings), spread, by, settings)
    rows = rows.withColumns(
        {f"median_{a}": F.col(f"peak_{a}_median") for a in AXES}
        | {f"mad_{a}": F.col(f"peak_{a}_mad") for a in AXES}
    )
    loosest = rows.withColumns({f"threshold_{a}": F.col(f"peak_{a}_q0") for a in AXES})
    possible = reduce(
        lambda a, b: a | b,
        [
            axis_hit(a, min(d for _, _, d in grid), min(m for _, m, _ in grid), settings.min_active_rows)
            for a in AXES
        ],
    )
    params = F.array(
        *[
            F.struct(
                F.lit(float(q)).alias("quantile"),
                F.lit(float(m)).alias("mad_limit"),
                F.lit(float(d)).alias("dominance"),
                F.lit(levels.index(q)).alias("level"),
            )
            for q, m, d in grid
        ]
    )
    names = ["quantile", "mad_limit", "dominance"]
    tried = loosest.filter(possible).withColumn("_p", F.explode(params)).select("*", "_p.*")
    tried = tried.withColumns(
        {
            f"threshold_{a}": reduce(
                lambda rest, i, a=a: F.when(F.col("level") == i, F.col(f"peak_{a}_q{i}")).otherwise(rest),
                range(1, len(levels)),
                F.col(f"peak_{a}_q0"),
            )
            for a in AXES
        }
    )
    detected = written(
        explode_hits(tried, settings, F.col("dominance"), F.col("mad_limit")).select(
            *by, *names, "event_type", F.col("timestamp").alias("time"), "severity"
        ),
        "cross-detected",
    )
    wanted = truths.withColumn("_p", F.explode(params)).select(
        *by, "_p.quantile", "_p.mad_limit", "_p.dominance", "event_type", "time", "severity"
    )
    keys = [*by, *names]
    matches = match_events(wanted, detected, tolerance_s, keys, settings)
    scores = detection_metrics(matches, detected, keys)
    # A fold without truths and detections scores 0, like one where nothing matched.
    folds = active.select("fold").distinct().withColumn("_p", F.explode(params)).select(
        "fold", "_p.quantile", "_p.mad_limit", "_p.dominance"
    )
    return (
        folds.join(scores, keys, "left")
        .groupBy(*names)
        .agg(F.avg(F.coalesce("f1_score", F.lit(0.0))).alias("mean_f1"))
        .orderBy(F.col("mean_f1").desc(), *names)
    )


def fixed_threshold_events(rows: DataFrame, x=8.0, y=6.0, z=10.0) -> DataFrame:
    return rows.filter((F.col("peak_x") > x) | (F.col("peak_y") > y) | (F.col("peak_z") > z))


def zscore_events(rows: DataFrame, peak: str = "peak_x", limit: float = 2.5) -> DataFrame:
    """Rows whose peak is more than ``limit`` sample standard deviations above the mean."""
    stats = settle(
        rows.agg(F.avg(peak).alias("_mean"), F.stddev_samp(peak).alias("_sd")), ()
    )
    score = (F.col(peak) - F.col("_mean")) / F.col("_sd")
    return (
        attach(rows, stats, ())
        .withColumn("z_score", F.when(F.col("_sd") > 0, score))
        .filter(F.col("z_score") > limit)
        .drop("_mean", "_sd")
    )


def mahalanobis(rows: DataFrame) -> DataFrame:
    """Distance of each row's three peaks from their mean, in units of their covariance."""
    pairs = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
    stats = settle(
        rows.filter(reduce(lambda a, b: a & b, [F.col(p).isNotNull() for p in PEAKS])).agg(
            *[F.avg(p).alias(f"_m{p[-1]}") for p in PEAKS],
            *[F.covar_samp(f"peak_{a}", f"peak_{b}").alias(f"_{a}{b}") for a, b in pairs],
        ),
        (),
    )
    xx, xy, xz, yy, yz, zz = (F.col(f"_{a}{b}") for a, b in pairs)
    dx, dy, dz = (F.col(p) - F.col(f"_m{p[-1]}") for p in PEAKS)
    # Cofactors of the symmetric covariance matrix.
    cxx, cxy, cxz = yy * zz - yz * yz, xz * yz - xy * zz, xy * yz - xz * yy
    cyy, cyz, czz = xx * zz - xz * xz, xy * xz - xx * yz, xx * yy - xy * xy
    det = xx * cxx + xy * cxy + xz * cxz
    form = (
        dx * dx * cxx + dy * dy * cyy + dz * dz * czz
        + 2 * (dx * dy * cxy + dx * dz * cxz + dy * dz * cyz)
    )
    distance = F.sqrt(F.greatest(F.lit(0.0), form / F.when(det != 0, det)))
    # greatest() skips nulls, so an unknown peak must be kept apart.
    known = form.isNotNull() & (det != 0)
    helper = [f"_m{a}" for a in AXES] + [f"_{a}{b}" for a, b in pairs]
    return (
        attach(rows, stats, ()).withColumn("distance", F.when(known, distance)).drop(*helper)
    )


def recent_weighted_percentile(
    rows: DataFrame,
    value: str,
    q: float,
    order: Sequence[str],
    by: Sequence[str] = (),
    settings: Settings = Settings(),
) -> DataFrame:
    """The smallest value at which the weights reach the share ``q`` of their total.

    In the given order weights grow evenly in the exponent from exp(-1) to 1.
    """
    known = rows.filter(F.col(value).isNotNull())
    placed = scan(ordered(known, by, order, settings), _nth=row_count(), _size=series_size())
    weight = F.exp(
        F.when(F.col("_size") > 1, (F.col("_nth") - 1) / (F.col("_size") - 1) - 1).otherwise(-1.0)
    )
    weighted = written(
        placed.done().select(*by, F.col(value).alias("_v"), weight.alias("_w")), "weighted"
    )
    # Rows of one value share one step of the cumulative weight.
    steps = weighted.groupBy(*by, "_v").agg(F.sum("_w").alias("_w"))
    summed = scan(
        ordered(steps, by, ["_v"], settings),
        _cum=running_sum(F.col("_w")),
        _all=series_total(F.col("_w")),
    ).done()
    reached = F.col("_cum") >= q * F.col("_all") * (1 - 1e-12)
    return summed.groupBy(*by).agg(
        F.min(F.when(reached, F.col("_v"))).alias("weighted_percentile")
    )


def quality_report(
    df: DataFrame,
    lat: str = "snapped_lat",
    lon: str = "snapped_lon",
    order: Sequence[str] = ("record_seqnum",),
    by: Sequence[str] = (DEVICE,),
    settings: Settings = Settings(),
) -> DataFrame:
    """Missing columns as ``errors``, and counts of implausible rows.

    Time is checked along ``order`` within ``by``.
    """
    wanted = [raw for raw, name in list(ACCEL_CHANNELS.items())[:3] if raw not in df.columns and name not in df.columns]
    wanted += [c for c in (lat, lon) if c not in df.columns]
    x = next((c for c in ("ain.12", "peak_x") if c in df.columns), None)
    rows = df
    late = F.lit(0).cast("long")
    if "timestamp" in df.columns:
        rows = scan(
            ordered(df, list(by), list(order), settings),
            _prev=previous(F.struct("timestamp")),
        ).done()
        late = F.count_if(F.col("timestamp") < F.col("_prev.timestamp"))
    none = F.lit(0).cast("long")
    has_place = lat in df.columns and lon in df.columns
    return rows.agg(
        F.lit(not wanted).alias("passed"),
        F.lit(", ".join(wanted)).alias("errors"),
        (F.count_if(F.abs(F.col(f"`{x}`")) > 50) if x else none).alias("extreme_x"),
        (
            F.count_if((F.abs(F.col(lat)) > 90) | (F.abs(F.col(lon)) > 180)) if has_place else none
        ).alias("invalid_positions"),
        late.alias("late_rows"),
    )


def diagnostics(df: DataFrame, large_rows: int = 50_000) -> DataFrame:
    """Size, activity, nulls and repeated rows of a table, with advice."""
    columns = df.columns
    copies = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("_copies"))
    nulls = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in columns])
    n = F.sum("_copies")
    cells = n * len(columns)
    totals = copies.agg(
        F.coalesce(n, F.lit(0)).alias("dataset_size"),
        F.coalesce(F.sum(F.when(is_active(), F.col("_copies"))), F.lit(0)).alias("active_events"),
        (F.sum(nulls * F.col("_copies")) / cells * 100).alias("null_percentage"),
        F.coalesce(n - F.count("*"), F.lit(0)).alias("duplicate_rows"),
    )
    advice = F.array(
        F.when(F.col("dataset_size") > large_rows, "large dataset"),
        F.when(F.col("null_percentage") > 20, "many nulls: check data quality"),
        F.when(
            F.col("active_events") < 0.01 * F.col("dataset_size"), "few active rows: check sensors"
        ),
    )
    return totals.withColumn("advice", F.concat_ws("; ", advice))


def weather_parameters(
    rows: DataFrame, weather: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Detection parameters by the hour's weather in the row's region: more sensitive in rain.

    ``weather(region, hour, precipitation)`` with ``hour`` in Unix hours.
    """
    hour = F.floor(F.col("timestamp") / 3600).cast("long")
    found = lookup(
        rows.withColumn("hour", hour),
        one_per_key(
            weather.select("region", F.col("hour").cast("long").alias("hour"), "precipitation"),
            ["region", "hour"], "weather",
        ),
        ["region", "hour"],
        settings,
    )
    rain = F.coalesce(F.col("precipitation") > 0.1, F.lit(False))
    return found.withColumns(
        {
            "quantile": F.when(rain, 90.0).otherwise(settings.quantile),
            "mad_limit": F.when(rain, 2.5).otherwise(settings.mad_limit),
        }
    ).drop("hour")


def traffic_severity(
    events: DataFrame, traffic: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Hard braking counts two points less, but at least 1, in heavy traffic.

    ``traffic(region, hour, density)`` with ``hour`` in Unix hours.
    """
    hour = F.floor(F.col("timestamp") / 3600).cast("long")
    found = lookup(
        events.withColumn("hour", hour),
        one_per_key(
            traffic.select("region", F.col("hour").cast("long").alias("hour"), "density"),
            ["region", "hour"], "traffic",
        ),
        ["region", "hour"],
        settings,
    )
    eased = (F.col("density") > 0.8) & (F.col("event_type") == "hard_brake")
    return found.withColumn(
        "adjusted_severity",
        F.when(eased, F.greatest(F.lit(1), F.col("severity") - 2)).otherwise(F.col("severity")),
    ).drop("hour")
