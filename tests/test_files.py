"""Sources, sinks, streams and the daily run, on files in a fresh folder."""

import json
from pathlib import Path
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from velotrace import session
from velotrace.checks import event_queries, source_queries
from velotrace.operators import manifest
from velotrace.plans import daily
from velotrace.schemas import EVENT_SCHEMA
from velotrace.sources import messages, sinks, tables
from velotrace.streaming import live
from tests.conftest import SMALL

DAY = date(2025, 8, 13)


def write(root, path, text):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


def message(i, **more):
    second = datetime(2025, 8, 13, 10, tzinfo=timezone.utc).timestamp() + i * 60
    return json.dumps(
        {
            "device.id": 5, "device.name": "AS5", "timestamp": second, "position.timestamp": second,
            "record.seqnum": i, "position.latitude": 51 + i / 1000, "position.longitude": 0.1,
            "position.speed": 20, **more,
        }
    )


@pytest.fixture
def inbox(tmp_path):
    root = tmp_path / "in"
    for i in range(4):
        write(root, f"2025/08/13/m{i}.json", message(i))
    write(root, "2025/08/13/bad.json", '{"device.id": ')
    write(root, "2025/08/13/extra.json", message(9, **{"other.key": 1, "battery.voltage": "n/a"}))
    write(root, "2025/08/14/next.json", message(20, **{"device.name": "TEBT1", "device.id": 6.0}))
    write(root, "loose.json", message(30))
    write(root, "2025/08/13/notes.txt", "no message")
    return str(root)


def test_messages(spark, inbox):
    found = messages.read_messages(spark, inbox)
    totals = messages.conversion_totals(found).first()
    assert (totals.files, totals.failed, totals.timestamped) == (8, 1, 7)
    assert messages.rejected(found).first().source_file.endswith("bad.json")
    rows = messages.to_telemetry(found)
    assert len(rows.columns) == 23 and rows.columns[0] == "battery_voltage"
    days = {r.date.isoformat(): r["count"] for r in rows.groupBy("date").count().collect()}
    assert days.pop("2025-08-13") == 5 and days.pop("2025-08-14") == 1 and list(days.values()) == [1]
    assert rows.filter("record_seqnum = 9").first().battery_voltage is None
    assert rows.filter("record_seqnum = 20").first().device_id == 6
    now = messages.to_telemetry(found, "now").select("date").distinct().collect()
    assert len(now) == 1


def test_messages_of_a_day_keep_loose_files(spark, inbox):
    names = messages.read_messages(spark, inbox, DAY).select("source_file", "ident").collect()
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in names) == [
        "bad.json", "extra.json", "loose.json", "m0.json", "m1.json", "m2.json", "m3.json",
    ]


def test_listing(spark, inbox):
    listing = tables.list_files(spark, inbox, "*.json")
    assert manifest.listing_totals(listing).first().files == 8
    assert tables.list_files(spark, inbox, max_files=2).count() == 2
    assert tables.list_files(spark, inbox + "/none").count() == 0
    assert [r.date.isoformat() for r in manifest.days_present(listing).collect()] == ["2025-08-13", "2025-08-14"]
    report = sinks.stored_report(listing).first()
    assert report.files == 8 and report.first_names == ["bad.json", "extra.json", "loose.json"]
    assert sinks.sample_lines(spark, inbox + "/loose.json").count() == 1


def test_csv_days(spark, tmp_path):
    write(tmp_path, "2025/08/13/a.csv", "device_id,device_name,ain.12\n1, AS1,2.5\n2.0,x,bad\n")
    write(tmp_path, "2025/08/13/sub/b.csv", "device_id,device_name,ain.12\n3,HEL,\n")
    rows = tables.read_csv_day(spark, str(tmp_path), DAY).orderBy("device_id").collect()
    assert [(r.device_id, r.device_name, r["ain.12"]) for r in rows] == [(1, " AS1", 2.5), (2, "x", None), (3, "HEL", None)]
    write(tmp_path, "other/c.csv", "device_name,device_id\nSW,4\n")
    both = tables.read_csv(spark, [str(tmp_path / "2025"), str(tmp_path / "other")])
    assert both.filter("device_id = 4").first()["ain.12"] is None


def test_slices_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = "v int, region string, date date"
    sinks.write_slices(spark.createDataFrame([(1, "a", DAY), (2, "b", DAY)], schema), out)
    sinks.write_slices(spark.createDataFrame([(3, "b", DAY)], schema), out)
    assert sorted(r.v for r in tables.read_slices(spark, out).collect()) == [1, 3]
    done = tables.read_slices(spark, out).select("region", "date")
    more = spark.createDataFrame([(8, "b", DAY), (9, "c", DAY)], schema)
    sinks.write_pending(more, out, done)
    assert sorted(r.v for r in tables.read_slices(spark, out).collect()) == [1, 3, 9]
    sinks.write_pending(more, out, done, force=True)
    assert sorted(r.v for r in tables.read_slices(spark, out).collect()) == [1, 8, 9]
    plan = tables.read_slices(spark, out, "a", DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan
    assert tables.read_slices(spark, out, "missing", DAY).count() == 0
    with pytest.raises(FileNotFoundError, match="region=missing"):
        tables.read_slices(spark, out, "missing", DAY, required=True)
    assert tables.read_slices(spark, out, "a", DAY, required=True).count() == 1


def test_empty_tables(spark, tmp_path):
    schema = spark.createDataFrame([], "v int, region string, date date").schema
    assert tables.read_slices(spark, str(tmp_path / "none"), schema=schema).count() == 0
    with pytest.raises(Exception):
        tables.read_slices(spark, str(tmp_path / "none"))


def test_hive_days(spark, tmp_path):
    out = tmp_path / "days"
    sinks.write_days(spark.createDataFrame([(1, date(2025, 8, 3))], "v int, date date"), str(out))
    assert (out / "year=2025" / "month=08" / "day=03").is_dir()


def test_daily_run(spark, inbox, tmp_path):
    converted, split, enriched = (str(tmp_path / n) for n in ("csv", "split", "enriched"))
    daily.convert_messages(spark, inbox, converted, DAY)
    rows = tables.read_csv(spark, converted + "/year=2025/month=08/day=13")
    assert rows.count() == 5
    daily.split_day(rows, DAY, split)
    daily.enrich_slices(spark, split, enriched)
    trips = daily.publish_day(spark, enriched, DAY)
    assert trips.columns[:3] == ["battery_voltage", "device_id", "device_name"]
    assert [r.time_s for r in trips.orderBy("timestamp").collect()] == [0.0, 60.0, 60.0, 60.0, 360.0]
    daily.enrich_slices(spark, split, enriched)
    assert daily.publish_day(spark, enriched, DAY).count() == 5
    daily.detect_day(trips, DAY, str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    assert stored.columns[:9] == EVENT_SCHEMA.names and stored.count() == 0


def test_stream_of_messages(spark, inbox, tmp_path):
    seen = []
    stream = live.message_stream(spark, inbox, files_per_batch=3)
    query = live.run_batches(
        stream, str(tmp_path / "cp"), lambda df, i: seen.extend(r.record_seqnum for r in df.collect())
    )
    query.awaitTermination()
    assert sorted(seen) == [0, 1, 2, 3, 9, 20, 30]


def test_stream_aggregates(spark, inbox, tmp_path):
    stream = live.message_stream(spark, inbox)
    for name, rows in (("counts", live.daily_region_counts(stream)), ("sessions", live.live_trips(stream))):
        query = (
            rows.writeStream.format("memory").queryName(name).outputMode("complete" if name == "counts" else "append")
            .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert {(r.region, r.rows) for r in spark.table("counts").collect()} == {("england", 6), ("sydney", 1)}


def test_stream_of_events(spark, tmp_path):
    rows = event_queries.trips_with_accel(spark, SMALL)
    rows.write.parquet(str(tmp_path / "rows"))
    found = live.live_events(
        spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows")), live.thresholds_of(rows)
    )
    query = (
        live.alerts(found).writeStream.format("memory").queryName("alerts")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("alerts").count() == event_queries.alerts(spark, SMALL).count() > 0


def test_event_counts_per_day(spark):
    found = event_queries.abnormal_events(spark, SMALL)
    timed = live.with_event_time(found)
    total = live.daily_event_counts(timed).agg(F.sum("events")).first()[0]
    assert total == found.count()


class Unset:
    """A session whose configuration names no checkpoint folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"

    def getCheckpointDir(self):
        return None


def test_shared_folder(spark):
    assert session.shared_folder(Unset("local[2]")).startswith("/tmp/run-")
    with pytest.raises(RuntimeError):
        session.shared_folder(Unset("yarn"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or session.shared_folder(spark) == named.rstrip("/")


def test_a_published_day_is_read_back_and_not_written_twice(spark, inbox, tmp_path):
    from velotrace import session

    converted, split, enriched, out = (str(tmp_path / n) for n in ("csv", "split", "enriched", "trips"))
    totals = daily.convert_messages(spark, inbox, converted, DAY, str(tmp_path / "bad"), ["ain.12"]).first()
    assert totals.failed == spark.read.parquet(str(tmp_path / "bad")).count() > 0
    rows = daily.converted_day(spark, converted, DAY)
    assert "ain.12" in rows.columns and rows.count() == 5
    daily.split_day(rows, DAY, split)
    before = len(session._written.get(spark.sparkContext.applicationId, []))
    daily.enrich_slices(spark, split, enriched)
    assert daily.write_trips(spark, enriched, DAY, out)
    assert not daily.write_trips(spark, enriched, DAY, out)
    assert daily.write_trips(spark, enriched, DAY, out, force=True)
    trips = daily.read_trips(spark, out, DAY)
    daily.detect_day(trips, DAY, str(tmp_path / "events"))
    # What the plans wrote on the way is gone, but for the listing of slices.
    assert len(session._written.get(spark.sparkContext.applicationId, [])) <= before + 2
    assert trips.count() == rows.count() and "ain.12" in trips.columns
    with pytest.raises(FileNotFoundError, match=str(DAY)):
        daily.read_trips(spark, out, date(2031, 1, 1))
    assert daily.pending_slices(spark, split, enriched).count() == 0


def test_device_files_are_opened_once(spark):
    found = source_queries.events_of_device_files(spark, SMALL)
    # The result comes from a table of their rows, and not from the files again.
    assert not [f for f in found.inputFiles() if "/of=" in f]


def test_device_files_lie_in_few_folders(spark):
    with session.scratch(spark):
        source_queries.events_of_device_files(spark, SMALL)
        newest = max(Path(session.shared_folder(spark)).glob("device-files-*"), key=lambda p: p.stat().st_mtime)
        devices = spark.read.parquet(f"{SMALL}/events.parquet").select("user_id").distinct().count()
        files = list(newest.rglob("*.parquet"))
        assert len(files) == devices and len({f.parent for f in files}) == devices
        assert len([p for p in newest.iterdir() if p.is_dir()]) <= source_queries.DEVICE_FOLDERS
        assert {p.name.split("=")[0] for p in newest.iterdir() if p.is_dir()} == {"folder"}
