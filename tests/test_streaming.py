"""Rolling detection and the slice sink on streams: restarts, expiry, late rows and repeated batches."""

from datetime import date

import pytest

from velotrace.session import new_path
from velotrace.settings import Settings
from velotrace.streaming import live, rolling
from velotrace.streaming.slices import SliceSink

READING = (
    "device_id long, timestamp double, record_seqnum long, peak_x double, peak_y double, peak_z double, "
    "position_latitude double, position_longitude double"
)
#: Low peaks of uneven height; the twelfth reading of a device stands out.
LOW = [0.5, 0.7, 0.4, 0.6, 0.9, 0.3, 0.8, 0.55, 0.65, 0.75, 0.45]


def readings(device, start, peaks, first=0):
    return [(device, start + 10.0 * i, first + i, x, 0.1, 0.1, 51.0, -0.1) for i, x in enumerate(peaks)]


def events_of(spark, frame, batches, **options):
    """The events of batches that come in one file each; the stream is started anew for every one."""
    inbox, out, state = (new_path(spark, x) for x in ("inbox", "events", "state"))
    schema = frame(READING).schema
    for rows in batches:
        frame(READING, *rows).coalesce(1).write.mode("append").parquet(inbox)
        found = rolling.rolling_events(spark.readStream.schema(schema).parquet(inbox), **options)
        writer = found.writeStream.format("parquet").option("checkpointLocation", state)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(rolling.OUT_SCHEMA).parquet(out).orderBy("timestamp", "device_id").collect()


def test_windows_survive_a_restart(spark, frame):
    rows = readings(1, 1000.0, [*LOW, 9.0, 0.5, 12.0])
    whole = events_of(spark, frame, [rows])
    parts = events_of(spark, frame, [rows[:7], rows[7:12], rows[12:]])
    assert [(r.event_type, r.peak_value, r.window_rows) for r in whole] == [("hard_brake", 9.0, 12), ("hard_brake", 12.0, 14)]
    assert parts == whole
    assert [r.recent_events for r in whole] == [1, 2]


def test_a_window_holds_the_last_readings_alone(spark, frame):
    rows = readings(1, 1000.0, [50.0, *LOW, 9.0])
    assert [r.window_rows for r in events_of(spark, frame, [rows], window=12)] == [12]
    # With the first reading in the window, 9 is below the percentile's place.
    assert events_of(spark, frame, [rows], settings=Settings(mad_limit=1000.0)) == []


def test_devices_do_not_meet(spark, frame):
    rows = [*readings(1, 1000.0, LOW), *readings(2, 1000.0, [9.0])]
    assert events_of(spark, frame, [rows]) == []


def test_late_readings_are_counted_and_not_judged(spark, frame):
    late = readings(1, 1005.0, [9.0], 100)
    after = readings(1, 2000.0, [9.0], 200)
    found = events_of(spark, frame, [readings(1, 1000.0, LOW), late, after])
    assert [(r.timestamp, r.late, r.window_rows) for r in found] == [(2000.0, 1, 12)]


def test_silent_devices_are_forgotten(spark, frame):
    far = 1_000_000.0
    batches = [readings(1, 1000.0, LOW), readings(2, far, LOW), readings(2, far + 500, [0.5]), readings(1, far + 900, [9.0])]
    assert events_of(spark, frame, batches, silence=3600, delay="1 hour") == []
    kept = events_of(spark, frame, batches, silence=10**8, delay="1 hour")
    assert [(r.device_id, r.window_rows) for r in kept] == [(1, 12)]


def test_readings_without_a_device_a_time_or_a_place(spark, frame):
    odd = [
        (None, 1.0, 0, 9.0, 0.1, 0.1, 51.0, -0.1),
        (1, None, 0, 9.0, 0.1, 0.1, 51.0, -0.1),
        (1, float("nan"), 0, 9.0, 0.1, 0.1, 51.0, -0.1),
        (1, 2000.0, 0, 9.0, 0.1, 0.1, None, None),
        (1, 2001.0, None, None, 0.1, 0.1, 51.0, -0.1),
    ]
    assert events_of(spark, frame, [odd]) == []
    assert events_of(spark, frame, [[]]) == []


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_positions_and_distances(share):
    import numpy as np

    for n in (1, 2, 7, 50):
        values = sorted(np.random.default_rng(n).normal(size=n).tolist())
        assert rolling.position(values, share) == pytest.approx(np.quantile(values, share))
        middle = float(np.median(values))
        assert rolling.median_distance(values, middle) == pytest.approx(np.median(np.abs(np.array(values) - middle)))


# ---- slices ---------------------------------------------------------------------------------

ROW = "device_name string, timestamp double, record_seqnum long"
DAY = 86_400.0


def inbox(spark, frame, *files):
    path = new_path(spark, "rows")
    for rows in files:
        frame(ROW, *rows).coalesce(1).write.mode("append").parquet(path)
    schema = frame(ROW).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def numbers(sink, spark, **of):
    return sorted(r.record_seqnum for r in sink.read(spark, **of).collect())


FILES = (
    [("AS1", 10 * DAY, 1), ("TEBT1", 10 * DAY + 5, 2), ("nobody", 10 * DAY, 3), ("AS1", None, 4)],
    [("AS2", 11 * DAY, 5), ("AS2", 3 * DAY, 6), ("AS2", 9.5 * DAY, 7)],
)


def test_a_batch_that_failed_half_way_is_run_again(spark, frame, monkeypatch):
    sink, state = SliceSink(new_path(spark, "sink")), new_path(spark, "state")
    stream = inbox(spark, frame, *FILES)
    whole = SliceSink._replace

    def fails(self, rows, kind, number):
        if kind == "marks" and number == 1:
            raise RuntimeError("lost")
        whole(self, rows, kind, number)

    monkeypatch.setattr(SliceSink, "_replace", fails)
    with pytest.raises(Exception, match="lost"):
        live.run_batches(stream, state, sink).awaitTermination()
    # Rows of the batch are there, but it is not whole, and they are not read.
    assert numbers(sink, spark) == [1, 2]
    monkeypatch.setattr(SliceSink, "_replace", whole)
    live.run_batches(stream, state, sink).awaitTermination()
    assert numbers(sink, spark) == [1, 2, 5, 6, 7]
    assert [(r.batch, r.rows, r.late) for r in sink.marks(spark).orderBy("batch").collect()] == [(0, 2, 0), (1, 3, 1)]


def test_late_rows_are_kept_and_counted(spark, frame):
    sink = SliceSink(new_path(spark, "sink"))
    live.run_batches(inbox(spark, frame, *FILES), new_path(spark, "state"), sink).awaitTermination()
    late = sink.late(spark).collect()
    # The row half a day back is within the allowed delay of the latest row before it.
    assert [(r.date, r.late, r.batch) for r in late] == [(date(1970, 1, 4), 1, 1)]
    assert numbers(sink, spark, day=date(1970, 1, 4)) == [6]


def test_a_late_batch_touches_its_own_day_alone(spark, frame):
    sink, first = SliceSink(new_path(spark, "sink")), frame(ROW, *FILES[0])
    sink(first, 0)
    before = sink.read(spark, day=date(1970, 1, 11)).inputFiles()
    for _ in range(2):
        sink(frame(ROW, *FILES[1]), 1)
    after = sink.read(spark, day=date(1970, 1, 11)).inputFiles()
    kept = [f for f in after if "/slices/" in f]
    assert sorted(kept) == sorted(f for f in before if "/slices/" in f)
    out = new_path(spark, "settled")
    sink.settle_days(spark, [date(1970, 1, 4), date(1970, 1, 11)], out)
    assert sorted(r.record_seqnum for r in spark.read.parquet(out).collect()) == [1, 2, 6]


def test_batches_without_rows(spark, frame):
    sink = SliceSink(new_path(spark, "sink"))
    sink(frame(ROW), 0)
    assert [(r.batch, r.rows, r.late, r.latest) for r in sink.marks(spark).collect()] == [(0, 0, 0, None)]
    sink(frame(ROW, *FILES[0]), 1)
    assert numbers(sink, spark) == [1, 2]
