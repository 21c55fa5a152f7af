"""Events on a stream against the last readings of each device.

Every active reading is first added to the last ``window`` readings of its device and then judged by
them, with the rule of the batch detector: the percentile, the dominance over the other axes and the
distance from the median in MADs of those readings. What is kept of a device is one state of bounded
size, in the state store of the stream: it survives restarts, and goes when the device has been
silent, in the time of the readings, for longer than ``silence``. Should it come back, it starts anew.

Readings of a device are judged in the order of time and number within a batch of the stream. One
that is older than the last judged reading of its device cannot be put in its place any more: it is
left out of the window and of the events, and counted in ``late``. Readings behind the watermark are
left out before that, and counted in the progress of the stream. Readings without a device or a time
are left out.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from velotrace.operators.events import AXES, AXIS_EVENTS, active_rows
from velotrace.schemas import DEVICE
from velotrace.settings import Settings
from velotrace.streaming.live import with_event_time

WINDOW, RECENT = 1000, 100
OUT_SCHEMA = (
    "device_id long, timestamp double, record_seqnum double, event_type string, severity int, "
    "peak_value double, latitude double, longitude double, window_rows int, recent_events int, late long"
)
PEAKS = [f"peak_{a}" for a in AXES]
UNKNOWN = float("nan")


def position(values: list[float], share: float) -> float:
    """The interpolated quantile of sorted values."""
    at = share * (len(values) - 1)
    low = int(at)
    if low + 1 >= len(values) or at == low:
        return values[low]
    return (low + 1 - at) * values[low] + (at - low) * values[low + 1]


def median_distance(values: list[float], middle: float) -> float:
    """The median distance of sorted values from ``middle``, met from the middle outwards."""
    right = bisect_left(values, middle)
    left, found = right - 1, []
    while len(found) <= len(values) // 2:
        down = middle - values[left] if left >= 0 else float("inf")
        up = values[right] - middle if right < len(values) else float("inf")
        if down <= up:
            found.append(down)
            left -= 1
        else:
            found.append(up)
            right += 1
    return found[-1] if len(values) % 2 else (found[-1] + found[-2]) / 2


@dataclass
class Device:
    """The last readings of a device, oldest first, and each axis's known values, sorted."""

    window: int
    readings: deque = field(default_factory=deque)
    values: list[list[float]] = field(default_factory=lambda: [[] for _ in AXES])
    last: tuple[float, float] = (float("-inf"), float("-inf"))
    late: int = 0
    recent: int = 0

    def add(self, peaks: tuple[float, ...]) -> None:
        self.readings.append(peaks)
        for values, x in zip(self.values, peaks):
            if x == x:
                insort(values, x)
        if len(self.readings) > self.window:
            for values, x in zip(self.values, self.readings.popleft()):
                if x == x:
                    del values[bisect_left(values, x)]

    def hits(self, settings: Settings) -> Iterator[tuple[str, int, float]]:
        """Event type, severity and peak of the last reading's events."""
        peaks = self.readings[-1]
        if len(self.readings) < settings.min_active_rows:
            return
        for i, (axis, peak) in enumerate(zip(AXES, peaks)):
            others = [x for k, x in enumerate(peaks) if k != i]
            # An unknown peak is NaN, of which no comparison holds.
            if not all(peak > settings.dominance * x for x in others):
                continue
            values = self.values[i]
            threshold = position(values, settings.quantile / 100)
            if not peak > threshold:
                continue
            middle = position(values, 0.5)
            away = median_distance(values, middle)
            if away > 0 and abs(peak - middle) / away > settings.mad_limit:
                highest = values[-1]
                ratio = (peak - threshold) / (highest - threshold) if highest > threshold else 0.0
                yield AXIS_EVENTS[axis], max(1, min(10, int(2 + 8 * ratio))), peak

    def pack(self) -> bytes:
        numbers = array("d", [*self.last, self.late, self.recent])
        for peaks in self.readings:
            numbers.extend(peaks)
        return numbers.tobytes()

    @staticmethod
    def unpack(data: bytes, window: int) -> "Device":
        numbers = array("d")
        numbers.frombytes(data)
        device = Device(window, last=(numbers[0], numbers[1]), late=int(numbers[2]), recent=int(numbers[3]))
        for i in range(4, len(numbers), len(AXES)):
            device.add(tuple(numbers[i : i + len(AXES)]))
        return device


def judge(rows: pd.DataFrame, device_id: int, device: Device, settings: Settings) -> list[tuple]:
    """The events of a batch's readings, which are added to the device."""
    out = []
    for row in rows.sort_values(["timestamp", "record_seqnum", *PEAKS], kind="stable").itertuples(index=False):
        number = row.record_seqnum if row.record_seqnum == row.record_seqnum else float("-inf")
        if (row.timestamp, number) < device.last:
            device.late += 1
            continue
        device.last = (row.timestamp, number)
        device.add(tuple(float(x) for x in (row.peak_x, row.peak_y, row.peak_z)))
        for kind, severity, peak in device.hits(settings):
            device.recent = min(device.recent + 1, RECENT)
            out.append(
                (device_id, row.timestamp, row.record_seqnum, kind, severity, peak, row.position_latitude,
                 row.position_longitude, len(device.readings), device.recent, device.late)
            )
    return out


def rolling_events(
    rows: DataFrame,
    settings: Settings = Settings(),
    window: int = WINDOW,
    silence: int = 86_400,
    delay: str = "1 day",
) -> DataFrame:
    """Events of a stream of telemetry with accelerometer channels; see ``OUT_SCHEMA``.

    ``recent_events`` counts a device's events so far, up to 100. ``silence`` is in seconds, and
    begins to count where the watermark stands, ``delay`` behind the latest reading.
    """
    names = [c.split()[0] for c in OUT_SCHEMA.split(", ")]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = Device.unpack(bytes(state.get[0]), window) if state.exists else Device(window)
        # The readings of one device in one batch of the stream.
        found = judge(pd.concat(list(batches)), key[0], held, settings)
        state.update((held.pack(),))
        until = int((held.last[0] + silence) * 1000)
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        if found:
            yield pd.DataFrame(found, columns=names)

    time = F.col("timestamp")
    active = active_rows(rows).filter(F.col(DEVICE).isNotNull() & time.isNotNull() & ~F.isnan(time))
    columns = ["timestamp", "record_seqnum", *PEAKS, "position_latitude", "position_longitude"]
    known = active.select(F.col(DEVICE).cast("long"), *[F.col(c).cast("double") for c in columns])
    return with_event_time(known).withWatermark("event_time", delay).groupBy(DEVICE).applyInPandasWithState(
        update, OUT_SCHEMA, "packed binary", "append", GroupStateTimeout.EventTimeTimeout
    )
