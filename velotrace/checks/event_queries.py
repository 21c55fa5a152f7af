"""Event detection, statistics and reports over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.checks.views import accel, duck, table, telemetry
from velotrace.operators import events, reports
from velotrace.operators.quantiles import quantiles
from velotrace.settings import Settings
from velotrace.streaming import live

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Parameters tried by the cross-validation: quantile, mad limit, dominance.
GRID = [(90.0, 3.0, 2.0), (95.0, 3.0, 2.0), (95.0, 8.0, 1.5), (98.0, 2.5, 3.0)]


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


def trips_with_accel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trips table with all six channels, numbered like the events."""
    peaks = accel(spark, sf_dir).withColumnRenamed("event_id", "record_seqnum")
    return peaks.withColumns({f"avg_{a}": F.col(f"peak_{a}") / 2 for a in events.AXES})


ACTIVE = """
active AS (SELECT *, row_number() OVER (ORDER BY device_id, timestamp, event_id) - 1 AS original_index
  FROM accel WHERE position_latitude IS NOT NULL AND position_longitude IS NOT NULL
    AND (position_latitude <> 0 OR position_longitude <> 0)
    AND (peak_x > 0 OR peak_y > 0 OR peak_z > 0))"""


def stats_sql(q: float = 0.95, by: str = "") -> str:
    """Threshold, maximum, median and MAD of each axis."""
    cols = ", ".join(
        f"quantile_cont(peak_{a}, {q}) AS t{a}, max(peak_{a}) AS m{a}, "
        f"median(peak_{a}) AS d{a}, mad(peak_{a}) AS a{a}"
        for a in "xyz"
    )
    lead, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"stats AS (SELECT {lead}count(*) AS n, {cols} FROM active{tail})"


def events_sql(mad: float = 3, dom: float = 2, by: str = "") -> str:
    """The events, from ``active`` and ``stats``."""
    join = f"active JOIN stats USING ({by})" if by else "active, stats"
    kinds = {"x": ("hard_brake", "y", "z"), "y": ("swerve", "x", "z"), "z": ("pothole", "x", "y")}
    parts = [
        f"""SELECT '{kind}' AS event_type,
          CAST(CASE WHEN peak_{a} <= t{a} THEN 1 ELSE greatest(1, least(10, trunc(2 + 8 *
            (CASE WHEN m{a} > t{a} THEN (peak_{a} - t{a}) / (m{a} - t{a}) ELSE 0 END)))) END AS INT) AS severity,
          CAST(timestamp AS DOUBLE) AS timestamp, device_id, CAST(NULL AS VARCHAR) AS trip_id,
          position_latitude AS latitude, position_longitude AS longitude,
          peak_{a} AS peak_value, original_index
        FROM {join} WHERE n >= 10 AND peak_{a} > t{a} AND peak_{a} > {dom} * peak_{o1}
          AND peak_{a} > {dom} * peak_{o2} AND a{a} > 0 AND abs(peak_{a} - d{a}) / a{a} > {mad}"""
        for a, (kind, o1, o2) in kinds.items()
    ]
    return "ev AS (" + " UNION ALL ".join(parts) + ")"


def with_events(sql: str, q: float = 0.95, mad: float = 3, dom: float = 2, by: str = "") -> str:
    text = duck(sql)
    head, body = text[: -len(sql)].rstrip(), sql
    return f"{head}, {ACTIVE}, {stats_sql(q, by)}, {events_sql(mad, dom, by)} {body}"


EVENT_COLUMNS = (
    "event_type, severity, timestamp, device_id, trip_id, latitude, longitude, peak_value, original_index"
)
ALL_EVENTS = f"SELECT {EVENT_COLUMNS} FROM ev"


@query("abnormal_events", with_events(ALL_EVENTS))
def abnormal_events(spark, d):
    return events.abnormal_events(trips_with_accel(spark, d))


@query("abnormal_events_mad_8", with_events(ALL_EVENTS, mad=8))
def abnormal_events_mad_8(spark, d):
    return events.abnormal_events(trips_with_accel(spark, d), Settings(mad_limit=8.0))


@query("abnormal_events_urban", with_events(ALL_EVENTS, 0.92, 2.5, 1.8))
def abnormal_events_urban(spark, d):
    return events.abnormal_events(trips_with_accel(spark, d), Settings().preset("urban"))


@query("abnormal_events_highway", with_events(ALL_EVENTS, 0.97, 3.5, 2.5))
def abnormal_events_highway(spark, d):
    return events.abnormal_events(trips_with_accel(spark, d), Settings().preset("highway"))


@query("abnormal_events_per_device", with_events(ALL_EVENTS, by="device_id"))
def abnormal_events_per_device(spark, d):
    return events.abnormal_events(trips_with_accel(spark, d), by=["device_id"])


@query(
    "events_by_file",
    with_events(
        "SELECT f.source_file, CAST(count(ev.event_type) AS BIGINT) AS events_detected FROM "
        "(SELECT DISTINCT device_id, concat('device-', device_id) AS source_file FROM accel) f "
        "LEFT JOIN ev USING (device_id) GROUP BY f.source_file",
        by="device_id",
    ),
)
def events_by_file(spark, d):
    rows = trips_with_accel(spark, d)
    return events.events_by_file(
        rows.withColumn("source_file", F.concat(F.lit("device-"), F.col("device_id")))
    )


@query(
    "axis_thresholds",
    with_events("SELECT n, tx AS threshold_x, mx AS max_x, ty AS threshold_y, my AS max_y, "
                "tz AS threshold_z, mz AS max_z FROM stats"),
)
def axis_thresholds(spark, d):
    stats = events.axis_statistics(events.active_rows(trips_with_accel(spark, d)))
    return stats.select("n", *[f"{p}_{a}" for a in events.AXES for p in ("threshold", "max")])


@query(
    "axis_mad",
    with_events("SELECT dx AS median_x, ax AS mad_x, dy AS median_y, ay AS mad_y, "
                "dz AS median_z, az AS mad_z FROM stats"),
)
def axis_mad(spark, d):
    stats = events.axis_statistics(events.active_rows(trips_with_accel(spark, d)))
    return stats.select(*[f"{p}_{a}" for a in events.AXES for p in ("median", "mad")])


@query(
    "axis_thresholds_per_device",
    with_events("SELECT device_id, n, tx AS threshold_x, ty AS threshold_y, tz AS threshold_z, "
                "ax AS mad_x, ay AS mad_y, az AS mad_z FROM stats", by="device_id"),
)
def axis_thresholds_per_device(spark, d):
    rows = events.active_rows(trips_with_accel(spark, d))
    stats = events.axis_statistics(rows, by=["device_id"])
    return stats.select(
        "device_id", "n", *[f"{p}_{a}" for p in ("threshold", "mad") for a in events.AXES]
    )


@query(
    "exact_quantiles_narrowed",
    "SELECT quantile_cont(l_extendedprice, 0.95) AS l_extendedprice_q95, "
    "median(l_extendedprice) AS l_extendedprice_q50, "
    "quantile_cont(l_quantity, 0.95) AS l_quantity_q95, median(l_quantity) AS l_quantity_q50 "
    "FROM lineitem",
)
def exact_quantiles_narrowed(spark, d):
    return quantiles(
        table(spark, d, "lineitem"),
        ["l_extendedprice", "l_quantity"],
        {"q95": 0.95, "q50": 0.5},
        settings=Settings(group_rows=1000),
    )


@query("events_by_type", with_events("SELECT event_type, count(*) AS events FROM ev GROUP BY event_type"))
def events_by_type(spark, d):
    return events.events_by_type(abnormal_events(spark, d))


@query(
    "severity_distribution",
    with_events("SELECT concat('severity_', severity) AS severity_key, count(*) AS events "
                "FROM ev GROUP BY 1 ORDER BY 1"),
)
def severity_distribution(spark, d):
    return events.events_by_severity(abnormal_events(spark, d))


@query(
    "severity_labels",
    with_events("""SELECT event_type, severity, CASE
      WHEN event_type = 'hard_brake' THEN CASE WHEN severity <= 3 THEN 'Mild braking' WHEN severity <= 6
        THEN 'Moderate braking' WHEN severity <= 8 THEN 'Hard braking' ELSE 'Emergency braking' END
      WHEN event_type = 'swerve' THEN CASE WHEN severity <= 3 THEN 'Gentle lane change' WHEN severity <= 6
        THEN 'Sharp turn' WHEN severity <= 8 THEN 'Aggressive swerving' ELSE 'Emergency maneuver' END
      ELSE CASE WHEN severity <= 3 THEN 'Minor bump' WHEN severity <= 6
        THEN 'Road irregularity' WHEN severity <= 8 THEN 'Significant pothole' ELSE 'Major road defect' END
      END AS label, count(*) AS events FROM ev GROUP BY ALL"""),
)
def severity_labels(spark, d):
    label = events.severity_label(F.col("event_type"), F.col("severity"))
    return (
        abnormal_events(spark, d)
        .groupBy("event_type", "severity", label.alias("label"))
        .agg(F.count("*").alias("events"))
    )


@query(
    "axis_dominance",
    duck("""SELECT event_id AS record_seqnum, peak_x > 2*peak_y AND peak_x > 2*peak_z AS x_dominates,
      peak_y > 2*peak_x AND peak_y > 2*peak_z AS y_dominates,
      peak_z > 2*peak_x AND peak_z > 2*peak_y AS z_dominates FROM accel"""),
)
def axis_dominance(spark, d):
    return trips_with_accel(spark, d).select(
        "record_seqnum", *[events.dominates(a, 2.0).alias(f"{a}_dominates") for a in events.AXES]
    )


@query(
    "mad_outliers",
    with_events("""SELECT event_id AS record_seqnum,
      ax > 0 AND abs(peak_x - dx) / ax > 3 AS x_far, ay > 0 AND abs(peak_y - dy) / ay > 3 AS y_far,
      az > 0 AND abs(peak_z - dz) / az > 3 AS z_far FROM active, stats"""),
)
def mad_outliers(spark, d):
    rows = events.active_rows(trips_with_accel(spark, d))
    stats = events.settle(events.axis_statistics(rows), ())
    return events.attach(rows, stats, ()).select(
        "record_seqnum",
        *[
            events.is_far(F.col(f"peak_{a}"), F.col(f"median_{a}"), F.col(f"mad_{a}"), 3.0).alias(f"{a}_far")
            for a in events.AXES
        ],
    )


@query(
    "severity_score",
    with_events("""SELECT event_id AS record_seqnum,
      CAST(CASE WHEN peak_x <= tx THEN 1 ELSE greatest(1, least(10, trunc(2 + 8 *
        (CASE WHEN mx > tx THEN (peak_x - tx) / (mx - tx) ELSE 0 END)))) END AS INT) AS severity
      FROM active, stats"""),
)
def severity_score(spark, d):
    rows = events.active_rows(trips_with_accel(spark, d))
    stats = events.settle(events.axis_statistics(rows), ())
    score = events.severity(F.col("peak_x"), F.col("threshold_x"), F.col("max_x"))
    return events.attach(rows, stats, ()).select("record_seqnum", score.alias("severity"))


@query(
    "active_rows",
    with_events("SELECT event_id AS record_seqnum, peak_x, peak_y, peak_z FROM active"),
)
def active_rows(spark, d):
    return events.active_rows(trips_with_accel(spark, d)).select(
        "record_seqnum", "peak_x", "peak_y", "peak_z"
    )


@query(
    "zscore_events",
    duck("""SELECT event_id AS record_seqnum, round((peak_x - m) / s, 6) AS z_score FROM accel,
      (SELECT avg(peak_x) AS m, stddev_samp(peak_x) AS s FROM accel) WHERE (peak_x - m) / s > 2.5"""),
)
def zscore_events(spark, d):
    return reports.zscore_events(trips_with_accel(spark, d)).select(
        "record_seqnum", F.round("z_score", 6).alias("z_score")
    )


@query(
    "fixed_threshold_events",
    duck("SELECT event_id AS record_seqnum FROM accel WHERE peak_x > 8 OR peak_y > 6 OR peak_z > 10"),
)
def fixed_threshold_events(spark, d):
    return reports.fixed_threshold_events(trips_with_accel(spark, d)).select("record_seqnum")


@query(
    "mahalanobis",
    duck("""SELECT event_id AS record_seqnum, round(sqrt((dx*dx*(yy*zz-yz*yz) + dy*dy*(xx*zz-xz*xz)
        + dz*dz*(xx*yy-xy*xy) + 2*(dx*dy*(xz*yz-xy*zz) + dx*dz*(xy*yz-xz*yy) + dy*dz*(xy*xz-xx*yz)))
        / (xx*(yy*zz-yz*yz) + xy*(xz*yz-xy*zz) + xz*(xy*yz-xz*yy))), 4) AS distance
      FROM (SELECT event_id, peak_x - avg(peak_x) OVER () AS dx, peak_y - avg(peak_y) OVER () AS dy,
              peak_z - avg(peak_z) OVER () AS dz FROM accel),
           (SELECT covar_samp(peak_x, peak_x) AS xx, covar_samp(peak_x, peak_y) AS xy,
              covar_samp(peak_x, peak_z) AS xz, covar_samp(peak_y, peak_y) AS yy,
              covar_samp(peak_y, peak_z) AS yz, covar_samp(peak_z, peak_z) AS zz FROM accel)"""),
)
def mahalanobis(spark, d):
    return reports.mahalanobis(trips_with_accel(spark, d)).select(
        "record_seqnum", F.round("distance", 4).alias("distance")
    )


@query(
    "weighted_percentile",
    duck("""SELECT device_id, min(v) AS weighted_percentile FROM (
      SELECT device_id, v, sum(w) OVER (PARTITION BY device_id ORDER BY v) AS c,
        sum(w) OVER (PARTITION BY device_id) AS total FROM (
          SELECT device_id, v, sum(exp(CASE WHEN n > 1 THEN (i - 1) / (n - 1) - 1 ELSE -1 END)) AS w FROM (
            SELECT device_id, peak_x AS v, CAST(count(*) OVER (PARTITION BY device_id) AS DOUBLE) AS n,
              CAST(row_number() OVER (PARTITION BY device_id ORDER BY timestamp, event_id) AS DOUBLE) AS i
            FROM accel) GROUP BY device_id, v)) WHERE c >= 0.95 * total * (1 - 1e-12) GROUP BY device_id"""),
)
def weighted_percentile(spark, d):
    return reports.recent_weighted_percentile(
        trips_with_accel(spark, d), "peak_x", 0.95, ["timestamp", "record_seqnum"], ["device_id"]
    )


WEEKS = """, w AS (SELECT *, CAST(date_trunc('week', make_timestamp(CAST(timestamp * 1000000 AS BIGINT))) AS DATE) AS week FROM ev),
  c AS (SELECT device_id, week, event_type, count(*) AS n, sum(CASE WHEN severity >= 7 THEN 1 ELSE 0 END) AS severe,
          min(original_index) AS seen FROM w GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY device_id, week ORDER BY n DESC, seen, event_type) AS place FROM c)"""


@query(
    "driver_report",
    with_events("@").replace("@", WEEKS + """ SELECT device_id, strftime(week, '%Y-%m-%d') AS week,
      CAST(sum(n) AS BIGINT) AS total_events, CAST(sum(severe) AS BIGINT) AS severe_events,
      max(CASE WHEN place = 1 THEN event_type END) AS top_type,
      max(CASE WHEN place = 2 THEN event_type END) AS second_type,
      CASE WHEN sum(severe) > 5 THEN 'HIGH' ELSE 'NORMAL' END AS coaching_priority
      FROM r GROUP BY device_id, week"""),
)
def driver_report(spark, d):
    return reports.driver_report(abnormal_events(spark, d)).withColumn(
        "week", F.date_format("week", "yyyy-MM-dd")
    )


@query(
    "risk_score",
    with_events("""SELECT device_id, strftime(make_timestamp(CAST(timestamp * 1000000 AS BIGINT)), '%Y-%m-01') AS month,
      greatest(0.0, least(100.0, 100.0 + sum(CASE WHEN severity >= 8 THEN -5.0::DOUBLE WHEN severity >= 6 THEN -2.0
        WHEN severity <= 3 THEN 0.5 ELSE 0.0 END))) AS risk_score FROM ev GROUP BY ALL"""),
)
def risk_score(spark, d):
    return reports.risk_score(abnormal_events(spark, d)).withColumn(
        "month", F.date_format("month", "yyyy-MM-dd")
    )


HAVERSINE = (
    "2 * 6371000.0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
    " + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
)


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return HAVERSINE.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


@query(
    "pothole_clusters",
    with_events("""SELECT a.original_index, count(*) AS frequency, round(avg(b.latitude), 9) AS center_lat,
      round(avg(b.longitude), 9) AS center_lon, round(avg(b.severity), 9) AS mean_severity,
      CASE WHEN avg(b.severity) > 7 THEN 'HIGH' ELSE 'NORMAL' END AS repair_priority
      FROM ev a JOIN ev b ON a.event_type = 'pothole' AND b.event_type = 'pothole'
        AND abs(a.latitude - b.latitude) < 0.001 AND """
                + haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")
                + " <= 50 GROUP BY a.original_index HAVING count(*) >= 3"),
)
def pothole_clusters(spark, d):
    found = reports.pothole_clusters(abnormal_events(spark, d))
    return found.select(
        "original_index",
        "frequency",
        *[F.round(c, 9).alias(c) for c in ("center_lat", "center_lon", "mean_severity")],
        "repair_priority",
    )


def truths(spark: SparkSession, d: str) -> DataFrame:
    """True events for matching: every strong peak, some seconds later."""
    rows = reports.fixed_threshold_events(trips_with_accel(spark, d), 60, 60, 60)
    kind = F.when(F.col("peak_x") > 60, "hard_brake").when(F.col("peak_y") > 60, "swerve").otherwise("pothole")
    return rows.select(
        "device_id",
        kind.alias("event_type"),
        (F.col("timestamp") + F.col("record_seqnum") % 9).cast("double").alias("time"),
        (F.col("record_seqnum") % 10 + 1).cast("int").alias("severity"),
    )


def detections(spark: SparkSession, d: str) -> DataFrame:
    return abnormal_events(spark, d).select(
        "device_id", "event_type", F.col("timestamp").alias("time"), "severity"
    )


MATCHES = """, tr AS (SELECT event_id AS tid, device_id,
    CASE WHEN peak_x > 60 THEN 'hard_brake' WHEN peak_y > 60 THEN 'swerve' ELSE 'pothole' END AS event_type,
    CAST(timestamp + event_id % 9 AS DOUBLE) AS time, CAST(event_id % 10 + 1 AS INT) AS severity
    FROM accel WHERE peak_x > 60 OR peak_y > 60 OR peak_z > 60),
  de AS (SELECT device_id, event_type, timestamp AS time, severity FROM ev),
  hits AS (SELECT t.tid, min({'time': d.time, 'severity': d.severity}) AS hit FROM tr t JOIN de d
    ON t.device_id = d.device_id AND t.event_type = d.event_type AND abs(t.time - d.time) <= 5 GROUP BY t.tid),
  ma AS (SELECT tr.*, hit.time AS detected_time, hit.severity AS detected_severity
    FROM tr LEFT JOIN hits USING (tid)) """


@query(
    "match_events",
    with_events("@").replace("@", MATCHES + "SELECT device_id, event_type, time, severity, detected_time, detected_severity FROM ma"),
)
def match_events(spark, d):
    return reports.match_events(truths(spark, d), detections(spark, d), by=["device_id"])


@query(
    "detection_metrics",
    with_events("@").replace("@", MATCHES + """, c AS (SELECT (SELECT count(detected_time) FROM ma) AS tp,
        (SELECT count(*) FROM de) AS n, (SELECT count(*) FROM ma) AS m),
      p AS (SELECT *, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS pr, CASE WHEN m > 0 THEN tp / m ELSE 0 END AS re FROM c)
      SELECT round(pr, 6) AS precision, round(re, 6) AS recall,
        round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6) AS f1_score,
        tp AS true_positives, n - tp AS false_positives, m - tp AS false_negatives FROM p"""),
)
def detection_metrics(spark, d):
    found = detections(spark, d)
    matches = reports.match_events(truths(spark, d), found, by=["device_id"])
    scores = reports.detection_metrics(matches, found)
    return scores.withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1_score")}
    )


@query(
    "detection_metrics_per_device",
    with_events("@").replace("@", MATCHES + """, c AS (SELECT device_id, sum(tp) AS tp, sum(n) AS n, sum(m) AS m FROM (
        SELECT CASE WHEN device_id % 4 <> 0 THEN device_id END AS device_id, count(detected_time) AS tp, 0 AS n, count(*) AS m FROM ma GROUP BY 1
        UNION ALL SELECT CASE WHEN device_id % 4 <> 0 THEN device_id END, 0, count(*), 0 FROM de GROUP BY 1) GROUP BY device_id)
      SELECT device_id, CAST(tp AS BIGINT) AS true_positives, CAST(n - tp AS BIGINT) AS false_positives,
        CAST(m - tp AS BIGINT) AS false_negatives FROM c"""),
)
def detection_metrics_per_device(spark, d):
    # A quarter of the devices are one group without a device.
    known = F.when(F.col("device_id") % 4 != 0, F.col("device_id"))
    found = detections(spark, d)
    matches = reports.match_events(truths(spark, d), found, by=["device_id"])
    scores = reports.detection_metrics(
        matches.withColumn("device_id", known), found.withColumn("device_id", known), ["device_id"]
    )
    return scores.select("device_id", "true_positives", "false_positives", "false_negatives")


@query(
    "severity_accuracy",
    with_events("@").replace("@", MATCHES + """SELECT round(avg(abs(detected_severity - severity)), 6) AS mean_absolute_error,
      round(sqrt(avg(pow(detected_severity - severity, 2))), 6) AS root_mean_square_error,
      max(abs(detected_severity - severity)) AS max_error,
      round(corr(detected_severity, severity), 6) AS severity_correlation FROM ma WHERE detected_time IS NOT NULL"""),
)
def severity_accuracy(spark, d):
    matches = reports.match_events(truths(spark, d), detections(spark, d), by=["device_id"])
    result = reports.severity_accuracy(matches)
    rounded = ("mean_absolute_error", "root_mean_square_error", "severity_correlation")
    return result.withColumns({c: F.round(c, 6) for c in rounded})


def _cross_sql() -> str:
    levels = sorted({q for q, _, _ in GRID})
    qs = ", ".join(
        f"quantile_cont(peak_{a}, {q / 100}) AS t{a}{i}" for a in "xyz" for i, q in enumerate(levels)
    )
    rest = ", ".join(
        f"max(peak_{a}) AS m{a}, median(peak_{a}) AS d{a}, mad(peak_{a}) AS a{a}" for a in "xyz"
    )
    kinds = {"x": ("hard_brake", "y", "z"), "y": ("swerve", "x", "z"), "z": ("pothole", "x", "y")}
    found = " UNION ALL ".join(
        f"""SELECT fold, CAST({q} AS DOUBLE) AS quantile, CAST({m} AS DOUBLE) AS mad_limit,
          CAST({dom} AS DOUBLE) AS dominance, '{kind}' AS event_type, timestamp AS time
        FROM act JOIN fs USING (fold) WHERE n >= 10 AND peak_{a} > t{a}{levels.index(q)}
          AND peak_{a} > {dom} * peak_{o1} AND peak_{a} > {dom} * peak_{o2}
          AND a{a} > 0 AND abs(peak_{a} - d{a}) / a{a} > {m}"""
        for q, m, dom in GRID
        for a, (kind, o1, o2) in kinds.items()
    )
    params = ", ".join(f"({q}::DOUBLE, {m}::DOUBLE, {dom}::DOUBLE)" for q, m, dom in GRID)
    return f""", act AS (SELECT *, device_id % 5 AS fold FROM active),
      fs AS (SELECT fold, count(*) AS n, {qs}, {rest} FROM act GROUP BY fold),
      de AS ({found}),
      pa(quantile, mad_limit, dominance) AS (VALUES {params}),
      tr AS (SELECT event_id AS tid, device_id % 5 AS fold,
        CASE WHEN peak_x > 60 THEN 'hard_brake' WHEN peak_y > 60 THEN 'swerve' ELSE 'pothole' END AS event_type,
        timestamp + event_id % 9 AS time FROM accel WHERE peak_x > 60 OR peak_y > 60 OR peak_z > 60),
      folds AS (SELECT * FROM (SELECT DISTINCT fold FROM act), pa),
      tp AS (SELECT quantile, mad_limit, dominance, fold, count(DISTINCT tid) AS tp FROM tr JOIN de USING (fold, event_type)
        WHERE abs(tr.time - de.time) <= 5 GROUP BY ALL),
      nd AS (SELECT quantile, mad_limit, dominance, fold, count(*) AS n FROM de GROUP BY ALL),
      nt AS (SELECT fold, count(*) AS m FROM tr GROUP BY ALL),
      sc AS (SELECT folds.*, coalesce(tp, 0) AS tp, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM folds
        LEFT JOIN tp USING (quantile, mad_limit, dominance, fold) LEFT JOIN nd USING (quantile, mad_limit, dominance, fold)
        LEFT JOIN nt USING (fold)),
      f1 AS (SELECT *, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS p, CASE WHEN m > 0 THEN tp / m ELSE 0 END AS r FROM sc)
      SELECT quantile, mad_limit, dominance,
        round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS mean_f1 FROM f1 GROUP BY ALL"""


@query("cross_validation", with_events("@").replace("@", _cross_sql()))
def cross_validation(spark, d):
    fold = F.col("device_id") % 5
    rows = events.active_rows(trips_with_accel(spark, d)).withColumn("fold", fold)
    wanted = truths(spark, d).withColumn("fold", fold)
    scores = reports.cross_validate(rows, wanted, GRID)
    return scores.withColumn("mean_f1", F.round("mean_f1", 6))


@query(
    "quality_report",
    duck("""SELECT true AS passed, '' AS errors, CAST(sum(CASE WHEN abs(peak_x) > 50 THEN 1 ELSE 0 END) AS BIGINT) AS extreme_x,
      CAST(sum(CASE WHEN abs(position_latitude) > 90 OR abs(position_longitude) > 180 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_positions,
      CAST(sum(CASE WHEN timestamp < prev THEN 1 ELSE 0 END) AS BIGINT) AS late_rows
      FROM (SELECT *, lag(timestamp) OVER (PARTITION BY device_id ORDER BY peak_z, event_id) AS prev FROM accel)"""),
)
def quality_report(spark, d):
    return reports.quality_report(
        trips_with_accel(spark, d),
        "position_latitude",
        "position_longitude",
        order=["peak_z", "record_seqnum"],
    )


@query(
    "diagnostics",
    duck("""SELECT CAST(sum(c) AS BIGINT) AS dataset_size, CAST(sum(CASE WHEN peak_x > 0 OR peak_y > 0 OR peak_z > 0 THEN c ELSE 0 END) AS BIGINT) AS active_events,
      round(sum(c * (CASE WHEN device_name IS NULL THEN 1 ELSE 0 END)) / (sum(c) * 5) * 100, 6) AS null_percentage,
      CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows,
      CASE WHEN sum(c) > 50000 THEN 'large dataset' ELSE '' END AS advice
      FROM (SELECT a.device_id, t.device_name, CASE WHEN a.peak_x > 5 THEN 1.0 ELSE 0.0 END AS peak_x, a.peak_y, 1.0 AS peak_z, count(*) AS c
            FROM accel a JOIN telemetry t ON a.event_id = t.record_seqnum GROUP BY ALL)"""),
)
def diagnostics(spark, d):
    names = telemetry(spark, d).select("record_seqnum", "device_name")
    rows = trips_with_accel(spark, d).join(names, "record_seqnum")
    subset = rows.select(
        "device_id",
        "device_name",
        F.when(F.col("peak_x") > 5, 1.0).otherwise(0.0).alias("peak_x"),
        "peak_y",
        F.lit(1.0).alias("peak_z"),
    )
    return reports.diagnostics(subset).withColumn(
        "null_percentage", F.round("null_percentage", 6)
    )


def _hours(spark: SparkSession, d: str, value: str, name: str) -> DataFrame:
    """Hourly readings per region code, from the orders placed."""
    rows = table(spark, d, "orders")
    code = F.concat(F.lit("area-"), F.col("o_orderkey") % 7)
    return (
        rows.groupBy(code.alias("region"), (F.lit(473352) + F.col("o_orderkey") % 720).alias("hour"))
        .agg((F.sum(F.expr(value)) % 100 / 100).alias(name))
    )


HOURS = """(SELECT concat('area-', o_orderkey % 7) AS region, 473352 + o_orderkey % 720 AS hour,
      sum(o_custkey) % 100 / 100 AS reading FROM orders GROUP BY ALL)"""


@query(
    "weather_parameters",
    duck(f"""SELECT a.event_id AS record_seqnum, CASE WHEN reading > 0.1 THEN 90.0::DOUBLE ELSE 95.0 END AS quantile,
      CASE WHEN reading > 0.1 THEN 2.5::DOUBLE ELSE 3.0 END AS mad_limit FROM accel a LEFT JOIN {HOURS} h
      ON h.region = concat('area-', a.device_id % 7) AND h.hour = CAST(floor(a.timestamp / 3600) AS BIGINT)"""),
)
def weather_parameters(spark, d):
    rows = trips_with_accel(spark, d).withColumn(
        "region", F.concat(F.lit("area-"), F.col("device_id") % 7)
    )
    weather = _hours(spark, d, "o_custkey", "precipitation")
    return reports.weather_parameters(rows, weather).select(
        "record_seqnum", "quantile", "mad_limit"
    )


@query(
    "traffic_severity",
    with_events(f"""SELECT original_index, event_type, severity, CASE WHEN reading > 0.8 AND event_type = 'hard_brake'
      THEN greatest(1, severity - 2) ELSE severity END AS adjusted_severity FROM ev LEFT JOIN {HOURS} h
      ON h.region = concat('area-', device_id % 7) AND h.hour = CAST(floor(timestamp / 3600) AS BIGINT)"""),
)
def traffic_severity(spark, d):
    found = abnormal_events(spark, d).withColumn(
        "region", F.concat(F.lit("area-"), F.col("device_id") % 7)
    )
    traffic = _hours(spark, d, "o_custkey", "density")
    return reports.traffic_severity(found, traffic).select(
        "original_index", "event_type", "severity", "adjusted_severity"
    )


@query(
    "alerts",
    with_events("SELECT event_type, severity, timestamp, device_id, peak_value FROM ev WHERE severity >= 8"),
)
def alerts(spark, d):
    rows = trips_with_accel(spark, d)
    found = live.live_events(rows, live.thresholds_of(rows))
    return live.alerts(found).select(
        "event_type", "severity", F.col("timestamp").cast("double").alias("timestamp"), "device_id", "peak_value"
    )
