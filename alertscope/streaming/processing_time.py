"""Processing-time tumbling windows that close on a timer, even when idle.

A native streaming aggregate only closes a window when later data moves the
watermark, so a quiet source would never be reported. Here each micro-batch is
reduced to the same level-1 partial aggregate as the other modes, with the
batch's clock as its window, and written below a store folder that all
executors share, as ``window=<start ms>/batch=<id>``. The first batch whose
clock is at or past a window's end reads that window's partials, merges them
and emits the anomalies.

* There is no Python and no per-key state: a batch is one aggregate, and a window
  is read once, when it closes.
* A batch that is run again after a failure has the clock that the stream's log
  recorded, overwrites its own partials, and closes the same windows again: a
  window is marked with the batch that closed it before it is emitted, and is
  only deleted by a later batch, which starts after that one was committed. The
  sink gets the batch id to make its own write idempotent.
* A heartbeat source lets a batch, and so the closing, run on every trigger.

A row's window is the processing time of the micro-batch that reads it; a
replayed old alert counts in the window in which it is read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertscope.operators.detect import anomaly_partials, anomaly_rows, arrival_order, merge_partials

_CLOCK, _BEAT = "_clock", "_beat"


class WindowStore:
    """Partials of open windows in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        root = self._path(self.folder)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        at = self._path(f"{self.folder}/{kind}")
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def put(self, partials: DataFrame, window_ms: int, batch_id: int) -> None:
        partials.write.mode("overwrite").parquet(f"{self.folder}/open/{window_ms}/{batch_id}")

    def drop_closed_before(self, batch_id: int) -> None:
        """Delete windows that an earlier, and so committed, batch closed."""
        for name in self._names("closed"):
            window, closer = name.split("-")
            if int(closer) < batch_id:
                self._fs.delete(self._path(f"{self.folder}/open/{window}"), True)
                self._fs.delete(self._path(f"{self.folder}/closed/{name}"), True)

    def due(self, clock_ms: int, length_ms: int) -> list[int]:
        """Starts of the windows that end at or before the clock."""
        return sorted(int(n) for n in self._names("open") if int(n) + length_ms <= clock_ms)

    def close(self, window_ms: int, batch_id: int) -> None:
        self._fs.mkdirs(self._path(f"{self.folder}/closed/{window_ms}-{batch_id}"))

    def read(self, windows: list[int], length_ms: int) -> DataFrame:
        """The partials of windows, with their ``window`` column."""
        paths = [f"{self.folder}/open/{w}/{b}" for w in windows for b in self._names(f"open/{w}")]
        rows = self.spark.read.parquet(*paths)
        start, end = F.timestamp_millis("window_ms"), F.timestamp_millis(F.col("window_ms") + length_ms)
        return rows.withColumn("window", F.struct(start.alias("start"), end.alias("end"))).drop("window_ms")


def batch_partials(events: DataFrame, window_ms: int) -> DataFrame:
    """Level-1 partials of one batch, all of it in the window that starts at ``window_ms``."""
    order = arrival_order("kafka_ts", "partition", "offset")
    partials = anomaly_partials(events, F.lit(int(window_ms)).cast("long"), order)
    return partials.withColumnRenamed("window", "window_ms")


def closed_anomalies(store: WindowStore, windows: list[int], length_ms: int, threshold: int) -> DataFrame:
    return anomaly_rows(merge_partials(store.read(windows, length_ms), threshold))


def with_heartbeat(events: DataFrame, rows_per_second: int = 1) -> DataFrame:
    """Union a built-in ``rate`` source whose rows only say that time went on.

    Spark starts a micro-batch when a source has new data or when the last batch
    of this run asks for another; right after a restart there is no last batch,
    so windows kept from before would wait for the next alert. The heartbeat's
    offsets advance every second, so a batch runs on every trigger.
    """
    beat = events.sparkSession.readStream.format("rate").option(
        "rowsPerSecond", str(int(rows_per_second))
    ).load()
    marks = beat.select(*[F.lit(None).cast(t).alias(n) for n, t in events.dtypes], F.lit(True).alias(_BEAT))
    return events.withColumn(_BEAT, F.lit(False)).unionByName(marks)


def start_processing_time_detector(
    events: DataFrame,
    window_seconds: int,
    threshold: int,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    store: str | None = None,
    trigger: dict | None = None,
    heartbeat: bool = True,
) -> StreamingQuery:
    """Run the detector; ``sink(anomalies, batch_id)`` receives what a batch closes.

    ``events`` has the detector fields and ``kafka_ts``, ``partition`` and ``offset``.
    ``store`` is the partials' folder (default: beside the checkpoint).
    """
    spark, length_ms = events.sparkSession, int(window_seconds) * 1000
    folder = store or f"{checkpoint.rstrip('/')}-windows"
    events = with_heartbeat(events) if heartbeat else events.withColumn(_BEAT, F.lit(False))
    clocked = events.withColumn(_CLOCK, F.unix_millis(F.current_timestamp()))

    def each(batch: DataFrame, batch_id: int) -> None:
        windows = WindowStore(batch.sparkSession, folder)
        windows.drop_closed_before(batch_id)
        # the stream's log fixes a batch's clock, the same in each of its rows: the first
        # ones tell it, and whether there is anything to place, without a second parse
        row = batch.select(_CLOCK).first()
        clock = row[_CLOCK] if row is not None else int(time.time() * 1000)
        own = batch.filter(~F.col(_BEAT)).drop(_BEAT, _CLOCK)
        if not own.isEmpty():
            start = clock // length_ms * length_ms
            windows.put(batch_partials(own, start), start, batch_id)
        due = windows.due(clock, length_ms)
        if due:
            for window in due:
                windows.close(window, batch_id)
            sink(closed_anomalies(windows, due, length_ms, threshold), batch_id)

    writer = clocked.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "1 second"}))
    return writer.start()


def run_processing_time_once(
    events: DataFrame, window_seconds: int, threshold: int, base: str
) -> DataFrame:
    """Read all that is there as one stream run, then close every window.

    What one micro-batch reads is one window. The anomalies of all windows are returned.
    """
    spark, length_ms = events.sparkSession, int(window_seconds) * 1000
    out = f"{base}/anomalies"

    def sink(anomalies: DataFrame, batch_id: int) -> None:
        anomalies.write.mode("overwrite").parquet(f"{out}/{batch_id}")

    query = start_processing_time_detector(
        events, window_seconds, threshold, sink, f"{base}/checkpoint", f"{base}/windows",
        trigger={"availableNow": True}, heartbeat=False,
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    store = WindowStore(spark, f"{base}/windows")
    closed = {int(n.split("-")[0]) for n in store._names("closed")}
    rest = [w for w in store.due(1 << 62, length_ms) if w not in closed]
    if rest:
        sink(closed_anomalies(store, rest, length_ms, threshold), -1)
    root = store._path(out)
    if not store._fs.exists(root):
        return anomaly_rows(merge_partials(_no_partials(spark), threshold))
    return spark.read.parquet(*[f"{out}/{s.getPath().getName()}" for s in store._fs.listStatus(root)])


def _no_partials(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "window struct<start: timestamp, end: timestamp>, sourceIp string, deviceId string, type string, "
        "n long, first decimal(38,0), top boolean, mid boolean, by_device boolean",
    )
