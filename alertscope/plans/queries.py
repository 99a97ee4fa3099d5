"""Named end-to-end queries over the driver's tables (``events`` mapped to alerts).

Each takes ``(spark, sf_dir)`` and returns a DataFrame without running it.
Timestamps in outputs meant for cross-engine comparison are rendered as
UTC ISO text; window lists are also given joined by ',' where a flat
column is wanted.
"""

from __future__ import annotations

import datetime
import functools
import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from alertscope.functions.time import ISO_MICROS_FORMAT
from alertscope.operators import reports as R
from alertscope.operators.detect import arrival_order, detect_anomalies, to_anomaly_json
from alertscope.operators.incremental import (
    cursor_fields,
    empty_mark,
    new_over_pages,
    new_since_mark,
    next_mark,
)
from alertscope.operators.parse import detector_events, parse_alerts
from alertscope.operators.rollups import ReportRollups
from alertscope.plans.compaction import compact_closed, compacted_lake
from alertscope.plans.ingest_job import poll_batch, read_mark, write_mark
from alertscope.plans.lake_job import PARSE, read_lake, start_lake
from alertscope.plans.report_job import read_report, run_reports, start_rolling_reports
from alertscope.schema import ALERT_FIELDS, ALERT_SCHEMA, LAKE_SCHEMA
from alertscope.session import ensure_utc, scratch_path, spread
from alertscope.sources.delivery import deliver
from alertscope.sources.events import (
    alert_json,
    alerts_from_events,
    dirty_messages,
    load_alerts,
    messages_from_alerts,
    messages_from_events,
    pages_from_alerts,
)
from alertscope.sources.pages import latest, unnest_pages
from alertscope.streaming.event_time import detector_stream, finish, state_partitions, table_stream
from alertscope.streaming.ledger import Ledger
from alertscope.streaming.processing_time import run_processing_time_once
from alertscope.streaming.progress import observed_totals
from alertscope.streaming.timed_windows import now_ms, run_until_closed, start_timed_detector

Query = Callable[[SparkSession, str], DataFrame]

# Detector parameters for the test tables. At 60 s no
# (source, window) reaches 3 alerts in ``events``, so a 1-day window is used.
DETECT_WINDOW_SECONDS = 86_400
DETECT_WINDOW_6H_SECONDS = 21_600
DETECT_THRESHOLD = 3
STREAM_DELAY = "1 minute"
# The first poll of the incremental-load scenario ends this many days
# before the day of the newest alert.
FIRST_POLL_DAYS_BEFORE_END = 7


def _iso(c) -> F.Column:
    return F.date_format(c, ISO_MICROS_FORMAT)


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = R.REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_alerts(spark, sf_dir))

    run.__name__ = name
    return run


def _sql_report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return R.sql_report(spark, load_alerts(spark, sf_dir), name)

    run.__name__ = f"sql_{name}"
    return run


def _written_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events (file stream) → topic messages → partitioned lake → read back.

    The lake and its checkpoint go to a new folder under the session's
    checkpoint root; the stream runs with ``availableNow`` and stops.
    """
    stream = table_stream(spark, sf_dir, "events.parquet")
    base = scratch_path(spark, "lake")
    query = start_lake(
        messages_from_events(spread(stream)),
        f"{base}/alerts",
        f"{base}/_checkpoint",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    lake = read_lake(spark, f"{base}/alerts")
    return lake if lake is not None else spark.createDataFrame([], LAKE_SCHEMA)


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _written_lake(spark, sf_dir)
    return lake.select(
        *ALERT_FIELDS,
        _iso("kafka_ts").alias("kafka_ts"),
        _iso("event_ts").alias("event_ts"),
        "dt",
    )


def lake_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.daily_trend(_written_lake(spark, sf_dir))


def total_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.total_alerts(load_alerts(spark, sf_dir))


def lake_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alerts → topic messages (JSON) → typed lake rows."""
    lake = parse_alerts(messages_from_alerts(spread(load_alerts(spark, sf_dir))))
    return lake.select(
        *ALERT_FIELDS,
        _iso("kafka_ts").alias("kafka_ts"),
        _iso("event_ts").alias("event_ts"),
        "dt",
    )


def _dirty_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_alerts(dirty_messages(spread(load_alerts(spark, sf_dir))))


def dirty_lake_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake parse over messages of which most have something wrong."""
    return _dirty_lake(spark, sf_dir).select(
        *ALERT_FIELDS, _iso("kafka_ts").alias("kafka_ts"), _iso("event_ts").alias("event_ts"), "dt"
    )


def dirty_top_source_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_source_ips(_dirty_lake(spark, sf_dir))


def dirty_severity_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.severity_distribution(_dirty_lake(spark, sf_dir))


def dirty_detector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = detector_events(dirty_messages(spread(load_alerts(spark, sf_dir))))
    return events.select("sourceIp", "deviceId", "type", "severity", "timestamp")


def dirty_source_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = detector_events(dirty_messages(spread(load_alerts(spark, sf_dir))))
    return _flat(
        detect_anomalies(
            events, DETECT_WINDOW_SECONDS, DETECT_THRESHOLD, time_col="event_ts", order=_arrival_order()
        )
    )


def _detector_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detector_events(messages_from_alerts(spread(load_alerts(spark, sf_dir))))


def detector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detector_events(spark, sf_dir).select(
        "sourceIp", "deviceId", "type", "severity", "timestamp"
    )


def _arrival_order() -> F.Column:
    return arrival_order("kafka_ts", "partition", "offset")


def _flat(anoms: DataFrame) -> DataFrame:
    return anoms.select(
        "type",
        "sourceIp",
        "deviceId",
        F.array_join("deviceIds", ",").alias("deviceIdList"),
        "alertCount",
        "severity",
        "windowStart",
        "windowEnd",
        F.array_join("alertTypes", ",").alias("alertTypeList"),
    )


def source_anomalies_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_anomalies(
        _detector_events(spark, sf_dir),
        DETECT_WINDOW_SECONDS,
        DETECT_THRESHOLD,
        time_col="event_ts",
        order=_arrival_order(),
    )


def source_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(source_anomalies_frame(spark, sf_dir))


def source_anomalies_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector with 6-hour windows (epoch-aligned, sub-day)."""
    return _flat(
        detect_anomalies(
            _detector_events(spark, sf_dir),
            DETECT_WINDOW_6H_SECONDS,
            DETECT_THRESHOLD,
            time_col="event_ts",
            order=_arrival_order(),
        )
    )


def anomaly_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_anomaly_json(source_anomalies_frame(spark, sf_dir))


def source_anomalies_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same detector as a Structured Streaming query (``availableNow``)."""
    from alertscope.streaming.event_time import run_detector_available_now

    out = run_detector_available_now(
        spark,
        sf_dir,
        DETECT_WINDOW_SECONDS,
        DETECT_THRESHOLD,
        STREAM_DELAY,
    )
    return _flat(out)


def latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = latest(load_alerts(spark, sf_dir))
    return top.select("alertId", "deviceId", "timestamp", "sourceIp", "severity")


def _raw_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The poll's raw alerts straight from message text: narrow, no pages."""
    texts = spread(load_alerts(spark, sf_dir)).select(alert_json().alias("json"))
    return cursor_fields(texts.select("json", F.try_parse_json("json").alias("alert")))


def page_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = unnest_pages(pages_from_alerts(load_alerts(spark, sf_dir)))
    return raw.select(F.from_json("json", ALERT_SCHEMA).alias("a")).select("a.*")


def publish_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_alerts(spark, sf_dir)
    return raw.select(F.col("cursor_id").alias("alertId"), "publish_key")


def _poll_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The poll batch's cursor columns, written once and read back: the mark
    computations read it several times, each a pruned scan."""
    path = scratch_path(spark, "poll-batch")
    rows = _raw_alerts(spark, sf_dir).select("cursor_ts", "cursor_id")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _first_poll_mark(spark: SparkSession, raw: DataFrame) -> DataFrame:
    end_day = F.date_trunc("day", raw.select(F.max("cursor_ts")).scalar())
    cutoff = end_day - F.make_interval(days=F.lit(FIRST_POLL_DAYS_BEFORE_END))
    first = raw.filter(F.col("cursor_ts") < cutoff)
    return next_mark(first, empty_mark(spark)).checkpoint()


def new_since_mark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _poll_batch(spark, sf_dir)
    mark = _first_poll_mark(spark, raw)
    new = new_since_mark(raw, mark)
    return new.select(F.col("cursor_id").alias("alertId"), _iso("cursor_ts").alias("cursor_ts"))


def next_mark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _poll_batch(spark, sf_dir)
    mark = _first_poll_mark(spark, raw)
    nxt = next_mark(new_since_mark(raw, mark), mark)
    return nxt.select(_iso("mark_ts").alias("mark_ts"), "mark_id")


def new_since_mark_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pages in one batch: page p holds the alerts of hours p and p + 1,
    so every alert but the last hour's is on two pages, and is published once."""
    base = _raw_alerts(spark, sf_dir).select("cursor_ts", "cursor_id")
    hour = F.floor(F.unix_seconds("cursor_ts") / 3600)
    rows = base.withColumn("page_seq", F.explode(F.array(hour - 1, hour)))
    path = scratch_path(spark, "poll-pages")
    rows.write.parquet(path)
    batch = spark.read.schema(rows.schema).parquet(path)
    new = new_over_pages(batch, empty_mark(spark))
    return new.select(F.col("cursor_id").alias("alertId"), _iso("cursor_ts").alias("cursor_ts"))


def source_anomalies_processing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector in its default mode: ``events`` as one micro-batch, so one
    processing-time window; the wall-clock columns are left out."""
    stream = table_stream(spark, sf_dir, "events.parquet", max_files=1_000_000)
    events = detector_events(messages_from_events(spread(stream))).drop("event_ts")
    out = run_processing_time_once(
        events, DETECT_WINDOW_SECONDS, DETECT_THRESHOLD, scratch_path(spark, "detector-processing")
    )
    return _flat(out).drop("windowStart", "windowEnd")


# How the test sender treats alerts, by alertId % 10.
REFUSED, THIRD_TIME = 3, 5


class UnreliableSender:
    """Refuses some records for good and some the first two times."""

    def __init__(self) -> None:
        self.tries: Counter = Counter()

    def send(self, records: list[tuple[str, str]]) -> list[str | None]:
        out: list[str | None] = []
        for _, value in records:
            digit = int(json.loads(value)["alertId"]) % 10
            self.tries[value] += 1
            waits = digit == THIRD_TIME and self.tries[value] < 3
            out.append("refused" if digit == REFUSED else "busy" if waits else None)
        return out

    def close(self) -> None:
        self.tries.clear()


def delivered_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each alert published through an unreliable sender."""
    done = deliver(_raw_alerts(spark, sf_dir), UnreliableSender)
    return done.select(F.col("cursor_id").alias("alertId"), "delivered", "attempts", "error")


def _pages_before(alerts: DataFrame, cutoff: F.Column) -> DataFrame:
    return pages_from_alerts(alerts.filter(F.col("event_ts") < cutoff)).select("body")


def _cutoff(alerts: DataFrame) -> F.Column:
    last = alerts.select(F.max("event_ts")).scalar()
    return F.date_trunc("day", last) - F.make_interval(days=F.lit(FIRST_POLL_DAYS_BEFORE_END))


def partial_next_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls, the second through an unreliable sender: the mark covers what was
    delivered, so alerts newer than it are left for the next poll."""
    alerts = load_alerts(spark, sf_dir)
    base = scratch_path(spark, "partial-poll")
    ledger, mark = Ledger(spark, f"{base}/ledger"), f"{base}/mark"
    poll_batch(spark, _pages_before(alerts, _cutoff(alerts)), mark, lambda new: None, ledger, 0)
    pages = pages_from_alerts(alerts).select("body")
    poll_batch(spark, pages, mark, lambda new: deliver(new, UnreliableSender), ledger, 1)
    return read_mark(spark, mark).select(_iso("mark_ts").alias("mark_ts"), "mark_id")


# Fixed value: alertId % 16 of alerts without a time in the replay query.
TIMELESS = 10


def replayed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls, each run twice under its batch id, as after a lost commit. An alert
    without a time is new at every poll, and published once by each."""
    alerts = load_alerts(spark, sf_dir)
    timeless = F.col("alertId").cast("long") % 16 == TIMELESS
    sent_as = alerts.withColumn("timestamp", F.when(~timeless, F.col("timestamp")))
    base = scratch_path(spark, "replayed-polls")
    ledger, topic = Ledger(spark, f"{base}/ledger"), f"{base}/topic"
    both = [_pages_before(sent_as, _cutoff(alerts)), pages_from_alerts(sent_as).select("body")]
    for batch_id, pages in enumerate(both):
        for _ in range(2):
            send = lambda new: new.select(F.lit(batch_id).alias("poll"), "cursor_id", "publish_key").write.mode(  # noqa: E731, B023
                "append"
            ).parquet(topic)
            poll_batch(spark, pages, f"{base}/mark", send, ledger, batch_id)
    return spark.read.parquet(topic).select("poll", F.col("cursor_id").alias("alertId"), "publish_key")


def replayed_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event-time detector through the ledger: each batch is kept, dies before its
    commit once, and is run again; the sink still has every anomaly once."""
    base = scratch_path(spark, "replayed-anomalies")
    anomalies = detector_stream(
        messages_from_events(spread(table_stream(spark, sf_dir, "events.parquet"))),
        DETECT_WINDOW_SECONDS, DETECT_THRESHOLD, STREAM_DELAY,
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, f"{base}/ledger")
        batch.write.parquet(f"{ledger.folder}/anomalies/data/{batch_id}-torn")  # no commit: never read
        for _ in range(2):
            ledger.keep("anomalies", batch_id, lambda: batch)

    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        writer = anomalies.writeStream.foreachBatch(each).outputMode("append").trigger(availableNow=True)
        finish(writer.option("checkpointLocation", f"{base}/checkpoint").start())
    found = Ledger(spark, f"{base}/ledger").read("anomalies")
    return _flat(spark.createDataFrame([], anomalies.schema) if found is None else found)


#: Windows of the timer query are short, as it has to wait for the end of one.
TIMED_WINDOW_SECONDS = 2


def source_anomalies_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector with keyed state and timers over the whole table. The rows' clock
    stands still at the start, so all of them fall into one window, which closes when
    the stream's own clock has passed its end."""
    base, length = scratch_path(spark, "detector-timed"), TIMED_WINDOW_SECONDS * 1000
    stream = table_stream(spark, sf_dir, "events.parquet", max_files=1_000_000)
    events = detector_events(messages_from_events(spread(stream))).drop("event_ts")
    start = now_ms()
    ledger = Ledger(spark, f"{base}/ledger")
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        query = start_timed_detector(
            events, TIMED_WINDOW_SECONDS, DETECT_THRESHOLD,
            lambda closed, batch_id: ledger.keep("anomalies", batch_id, lambda: closed),
            f"{base}/checkpoint", clock=lambda: start,
        )
    run_until_closed(query, length, clock=lambda: start)
    found = ledger.read("anomalies")
    if found is None:
        found = detect_anomalies(_detector_events(spark, sf_dir).limit(0), length, DETECT_THRESHOLD)
    return _flat(found).drop("windowStart", "windowEnd")


def parse_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both parses dropped of the dirty messages, as observed while the lake stream
    wrote them and while the detector's events were read: no job counts."""
    base = scratch_path(spark, "parse-outcomes")
    stream = alerts_from_events(table_stream(spark, sf_dir, "events.parquet"))
    lake = start_lake(dirty_messages(stream), f"{base}/lake", f"{base}/checkpoint", trigger={"availableNow": True})
    finish(lake)
    seen = Observation()
    events = detector_events(dirty_messages(spread(load_alerts(spark, sf_dir))), observe=seen)
    events.write.format("noop").mode("overwrite").save()
    found = {"lake": observed_totals(lake.recentProgress).get(PARSE, {}), "detector": seen.get}
    rows = [(parse, outcome, n) for parse, outcomes in found.items() for outcome, n in outcomes.items()]
    return spark.createDataFrame(rows, "parse string, outcome string, n long")


def versioned_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports published twice as versions, the first time over part of the alerts; a
    third write of each dies before its commit. The second version is what is read."""
    out, alerts = scratch_path(spark, "versioned-reports"), load_alerts(spark, sf_dir)
    for some in (alerts.filter("alertId % 2 = 0"), alerts):
        failed = {k: v for k, v in run_reports(spark, some, out, versioned=True).items() if v != "ok"}
        if failed:
            raise RuntimeError(f"report job failed: {failed}")
    frames = []
    for name, key in REPORT_KEYS.items():
        torn = alerts.limit(1).select(F.col(key), F.lit(-1).cast("long").alias("alert_count"))
        torn.write.parquet(f"{out}/{name}/data/2-torn")
        rows = read_report(spark, out, name)
        frames.append(rows.select(F.lit(name).alias("report"), F.col(key).cast("string").alias("key"), "alert_count"))
    return functools.reduce(DataFrame.unionByName, frames)


def _damage(spark: SparkSession, folder: str) -> None:
    """Cut off every file of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        out = files.create(status.getPath(), True)
        out.write(bytearray(b"PAR1 cut off"))
        out.close()


def new_since_damaged_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mark store whose newest slot is damaged: the mark before it counts, so alerts
    since then are new again and none is lost."""
    raw = _poll_batch(spark, sf_dir)
    store, first = scratch_path(spark, "mark"), _first_poll_mark(spark, raw)
    write_mark(first, store, 0)
    write_mark(next_mark(raw, first), store, 1)
    _damage(spark, f"{store}/slot=1")
    new = new_since_mark(raw, read_mark(spark, store))
    return new.select(F.col("cursor_id").alias("alertId"), _iso("cursor_ts").alias("cursor_ts"))


def compacted_lake_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake written in three batches, its closed days compacted after the second, read
    back with the third's late alerts."""
    base, alerts = scratch_path(spark, "compacted-lake"), load_alerts(spark, sf_dir)
    last = alerts.agg(F.max("dt")).first()[0]
    for batch in range(3):
        if batch == 2 and last is not None:
            compact_closed(spark, f"{base}/lake", f"{base}/compact", before=last, most_files=1)
        some = alerts.filter(F.col("alertId").cast("long") % 3 == batch)
        some.write.mode("append").partitionBy("dt").parquet(f"{base}/lake")
    lake = compacted_lake(spark, f"{base}/lake", f"{base}/compact")
    return lake.select(*ALERT_FIELDS, _iso("kafka_ts").alias("kafka_ts"), _iso("event_ts").alias("event_ts"), "dt")


def damaged_lake_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily trend over a lake whose file of the first day is damaged, read back
    from the report job: the other days are reported."""
    base, alerts = scratch_path(spark, "damaged-lake"), load_alerts(spark, sf_dir)
    alerts.repartition("dt").write.partitionBy("dt").parquet(f"{base}/lake")
    first = alerts.agg(F.min("dt")).first()[0]
    _damage(spark, f"{base}/lake/dt={first}")
    run_reports(spark, f"{base}/lake", f"{base}/reports")
    return spark.read.parquet(f"{base}/reports/daily_trend")


#: Days at the end of the table that the rollup queries add one by one.
ROLLED_DAYS = 2


def _rolled(name: str) -> Query:
    """The named report from parts: all days but the last ones, then a day at a time,
    the last of them twice."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        alerts = load_alerts(spark, sf_dir)
        rollups = ReportRollups(spark, scratch_path(spark, "rollups"))
        last = alerts.agg(F.max("dt")).first()[0]
        if last is not None:
            days = [last - datetime.timedelta(days=n) for n in range(ROLLED_DAYS - 1, -1, -1)]
            rollups.add(0, alerts.filter(F.col("dt").isNull() | (F.col("dt") < F.lit(days[0]))))
            rollups.add_days(alerts, [*days, last])
        return rollups.report(name)

    run.__name__ = f"rolled_{name}"
    return run


def _streamed(name: str) -> Query:
    """The named report kept by a stream over the table, read after its last batch."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_path(spark, "streamed-report")
        alerts = alerts_from_events(table_stream(spark, sf_dir, "events.parquet"))
        finish(start_rolling_reports(alerts, f"{base}/reports", f"{base}/checkpoint", trigger={"availableNow": True}))
        return ReportRollups(spark, f"{base}/reports").report(name)

    run.__name__ = f"streamed_{name}"
    return run




def _in_utc(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


# Group key of each report, for the long read-back form.
REPORT_KEYS = {
    "top_source_ips": "sourceIp",
    "alerts_per_device": "deviceId",
    "severity_distribution": "severity",
    "type_distribution": "type",
    "daily_trend": "dt",
    "top_destination_ports": "destinationPort",
}


def written_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the report job to files, read every report back as (report, key, alert_count)."""
    out = scratch_path(spark, "reports")
    status = run_reports(spark, load_alerts(spark, sf_dir), out)
    failed = {k: v for k, v in status.items() if v != "ok"}
    if failed:
        raise RuntimeError(f"report job failed: {failed}")
    frames = [
        spark.read.parquet(f"{out}/{name}").select(
            F.lit(name).alias("report"), F.col(key).cast("string").alias("key"), "alert_count"
        )
        for name, key in REPORT_KEYS.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def new_since_stored_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restart case: the first poll's mark goes through the mark store and is
    read back timestamp-only, so alerts at exactly the mark instant are new again."""
    raw = _poll_batch(spark, sf_dir)
    store = scratch_path(spark, "mark")
    write_mark(_first_poll_mark(spark, raw), store, 0)
    stored = read_mark(spark, store, timestamp_only=True)
    new = new_since_mark(raw, stored)
    return new.select(F.col("cursor_id").alias("alertId"), _iso("cursor_ts").alias("cursor_ts"))


# The reports with distinct counts, which cannot be added up.
ROLLED = ("top_source_ips", "alerts_per_device", "daily_trend")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"rolled_{name}": _rolled(name) for name in ROLLED},
    **{f"streamed_{name}": _streamed(name) for name in ROLLED[:2]},
    "delivered_alerts": delivered_alerts,
    "partial_next_mark": partial_next_mark,
    "replayed_polls": replayed_polls,
    "source_anomalies_timed": source_anomalies_timed,
    "parse_outcomes": parse_outcomes,
    "versioned_reports": versioned_reports,
    "damaged_lake_trend": damaged_lake_trend,
    "compacted_lake_parse": compacted_lake_parse,
    "new_since_damaged_mark": new_since_damaged_mark,
    "replayed_anomalies": replayed_anomalies,
    **{name: _report(name) for name in R.REPORTS},
    **{f"sql_{name}": _sql_report(name) for name in R.REPORTS},
    "total_alerts": total_alerts,
    "lake_parse": lake_parse,
    "lake_roundtrip": lake_roundtrip,
    "lake_daily_trend": lake_daily_trend,
    "detector_parse": detector_parse,
    "source_anomalies": source_anomalies,
    "source_anomalies_6h": source_anomalies_6h,
    "anomaly_json": anomaly_json,
    "source_anomalies_stream": source_anomalies_stream,
    "source_anomalies_processing": source_anomalies_processing,
    "new_since_mark_pages": new_since_mark_pages,
    "dirty_lake_parse": dirty_lake_parse,
    "dirty_top_source_ips": dirty_top_source_ips,
    "dirty_severity_distribution": dirty_severity_distribution,
    "dirty_detector_parse": dirty_detector_parse,
    "dirty_source_anomalies": dirty_source_anomalies,
    "latest_alerts": latest_alerts,
    "page_unnest": page_unnest,
    "publish_key": publish_keys,
    "new_since_mark": new_since_mark_q,
    "next_mark": next_mark_q,
    "written_reports": written_reports,
    "new_since_stored_mark": new_since_stored_mark,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _in_utc(fn) for name, fn in _QUERIES.items()
}
