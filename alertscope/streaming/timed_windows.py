"""Processing-time windows with keyed state and a timer for each window.

Every alert is placed by the time at which its own task reads it, so the alerts of
one micro-batch may fall into two windows. Tasks first sum what they read per
(source, window), with the earliest arrival of each device and type: a source with a
third of all alerts is a few rows per task by the time it is shuffled. Its key's state
holds a map from open windows to their sums, and each window has a processing-time
timer at its end, which emits the window and drops its state. Timers live in the
checkpoint beside the state, so a restart closes what was left open.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from alertscope.functions.severity import ESCALATE_MID, ESCALATE_TOP, escalate_flags, normalised_severity
from alertscope.operators.detect import anomaly_rows, arrival_order
from alertscope.session import ship_package

# The state store that keyed state with timers needs, and digits of an
# arrival order, so that text sorts as the numbers do.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_ORDER_DIGITS = 38

_SUMS = "n long, top boolean, mid boolean, devices array<string>, types array<string>"
_PARTIALS = f"sourceIp string, window_ms long, {_SUMS}"
_CLOSED = (
    "sourceIp string, window_ms long, alertCount long, top boolean, mid boolean, "
    "deviceIds array<string>, alertTypes array<string>"
)


def now_ms() -> int:
    return int(time.time() * 1000)


def earliest(marked: Iterable[str]) -> list[str]:
    """Of texts that are an arrival order and a value, the least of each value, in order."""
    first: dict[str, str] = {}
    for text in sorted(marked):
        first.setdefault(text[_ORDER_DIGITS:], text)
    return list(first.values())


def merged(a: tuple, b: tuple) -> tuple:
    """Sums of two parts of one window: count, flags, devices, types."""
    return (a[0] + b[0], a[1] or b[1], a[2] or b[2], earliest([*a[3], *b[3]]), earliest([*a[4], *b[4]]))


def read_time_partials(events: DataFrame, length_ms: int, clock: Callable[[], int] = now_ms) -> DataFrame:
    """Detector events → sums per (source, window of the time of reading) and Arrow batch."""
    severity = normalised_severity("severity")
    order = F.lpad(arrival_order("kafka_ts", "partition", "offset").cast("string"), _ORDER_DIGITS, "0")
    rows = events.select(
        "sourceIp",
        F.coalesce(severity.isin(*ESCALATE_TOP), F.lit(False)).alias("top"),
        F.coalesce(severity == F.lit(ESCALATE_MID), F.lit(False)).alias("mid"),
        F.when(F.col("deviceId") != "", F.concat(order, "deviceId")).alias("device"),
        F.when(F.col("type") != "", F.concat(order, "type")).alias("type"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = clock() // length_ms * length_ms
            seen: dict[str, list] = {}
            for source, top, mid, device, kind in zip(*(c.to_pylist() for c in batch.columns)):
                sums = seen.setdefault(source, [0, False, False, [], []])
                sums[0] += 1
                sums[1], sums[2] = sums[1] or top, sums[2] or mid
                sums[3] += [device] if device is not None else []
                sums[4] += [kind] if kind is not None else []
            out = [
                {"sourceIp": s, "window_ms": at, "n": n, "top": t, "mid": m, "devices": earliest(d), "types": earliest(k)}
                for s, (n, t, m, d, k) in seen.items()
            ]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return rows.mapInArrow(work, _PARTIALS)


_ARROW = pa.schema(
    [("sourceIp", pa.string()), ("window_ms", pa.int64()), ("n", pa.int64()), ("top", pa.bool_()), ("mid", pa.bool_()),
     ("devices", pa.list_(pa.string())), ("types", pa.list_(pa.string()))]
)


class SourceWindows(StatefulProcessor):
    """The open windows of one source."""

    def __init__(self, length_ms: int, threshold: int) -> None:
        self.length_ms, self.threshold = length_ms, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("windows", "window_ms long", _SUMS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts: dict[int, tuple] = {}
        for r in rows:
            own = (r.n, r.top, r.mid, list(r.devices), list(r.types))
            parts[r.window_ms] = merged(parts[r.window_ms], own) if r.window_ms in parts else own
        for window, own in parts.items():
            if self.open.containsKey((window,)):
                n, top, mid, devices, types = self.open.getValue((window,))
                own = merged((n, top, mid, list(devices), list(types)), own)
            else:
                self.handle.registerTimer(window + self.length_ms)
            self.open.updateValue((window,), own)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        window = expiredTimerInfo.getExpiryTimeInMs() - self.length_ms
        if self.open.containsKey((window,)):
            n, top, mid, devices, types = self.open.getValue((window,))
            self.open.removeKey((window,))
            if n >= self.threshold:
                plain = lambda marked: [t[_ORDER_DIGITS:] for t in marked]
                yield Row(sourceIp=key[0], window_ms=window, alertCount=n, top=top, mid=mid,
                          deviceIds=plain(devices), alertTypes=plain(types))

    def close(self) -> None: ...


def timed_anomalies(
    events: DataFrame, window_seconds: int, threshold: int, clock: Callable[[], int] = now_ms
) -> DataFrame:
    """A stream of detector events → anomaly rows, each when its window's timer fires.

    ``clock`` gives a row's processing time in its task, in ms. Start the query within
    ``timer_state``.
    """
    ship_package(events.sparkSession)
    length_ms = int(window_seconds) * 1000
    closed = (
        read_time_partials(events, length_ms, clock)
        .groupBy("sourceIp")
        .transformWithState(SourceWindows(length_ms, int(threshold)), _CLOSED, "Append", "ProcessingTime")
    )
    start, end = F.timestamp_millis("window_ms"), F.timestamp_millis(F.col("window_ms") + length_ms)
    rows = closed.select(
        F.struct(start.alias("start"), end.alias("end")).alias("window"), "sourceIp", "alertCount",
        "deviceIds", "alertTypes", escalate_flags(F.col("top"), F.col("mid")).alias("severity"),
    )
    return anomaly_rows(rows)


@contextmanager
def timer_state(spark: SparkSession):
    """Start queries with the state store that timers need; the setting is put back."""
    before = spark.conf.get(_PROVIDER_KEY)
    spark.conf.set(_PROVIDER_KEY, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER_KEY, before)


def start_timed_detector(
    events: DataFrame,
    window_seconds: int,
    threshold: int,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    clock: Callable[[], int] = now_ms,
) -> StreamingQuery:
    """Run the detector; ``sink(anomalies, batch_id)`` gets what a batch's timers close.

    Timers fire on the stream's own batches, which go on without new alerts once one
    was read; union a heartbeat (``with_heartbeat``) to close windows of an earlier run
    at once after a restart.
    """
    with timer_state(events.sparkSession):
        writer = timed_anomalies(events, window_seconds, threshold, clock).writeStream.foreachBatch(sink)
        writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def run_until_closed(query: StreamingQuery, length_ms: int, clock: Callable[[], int] = now_ms, idle_s: float = 30) -> None:
    """Let a query read what is there and close every window, then stop it.

    It is done when a batch that began after the last window's end is through; if its
    source has given nothing for ``idle_s`` seconds, there is nothing to close.
    """
    end, since = None, time.monotonic()
    try:
        while query.isActive:
            batches = query.recentProgress
            read = [p for p in batches if p.numInputRows]
            if end is None and read and batches[-1].batchId > read[-1].batchId:
                end = (clock() // length_ms + 1) * length_ms
            if end is not None and _began_ms(batches[-1]) >= end:
                break
            if read or query.status["isTriggerActive"]:
                since = time.monotonic()
            elif time.monotonic() - since > idle_s:
                break
            time.sleep(0.2)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()


def _began_ms(progress: StreamingQueryProgress) -> int:
    return int(datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp() * 1000)
