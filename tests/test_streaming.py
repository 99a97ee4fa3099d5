"""Streams: lake append with restart, event-time detector = batch on closed
windows, processing-time windows that close while idle."""

from __future__ import annotations

import datetime as dt
import json
import time

from pyspark.sql import functions as F

from alertscope.operators.detect import detect_anomalies
from alertscope.operators.parse import parse_events
from alertscope.plans.lake_job import read_lake, start_lake
from alertscope.schema import KAFKA_ROW_SCHEMA
from alertscope.streaming.event_time import detector_stream
from alertscope.streaming.processing_time import start_processing_time_detector

T0 = dt.datetime(2024, 1, 1)


def _write_messages(spark, folder, alerts, first_offset=0):
    rows = []
    for i, a in enumerate(alerts):
        ts = T0 + dt.timedelta(seconds=first_offset + i)
        rows.append((None, json.dumps(a).encode(), "ids.alerts", 0, first_offset + i, ts, 0))
    spark.createDataFrame(rows, KAFKA_ROW_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    return spark.readStream.schema(KAFKA_ROW_SCHEMA).parquet(folder)


def test_lake_append_resumes_without_loss_or_duplicates(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    first = [
        {"alertId": str(i), "timestamp": f"2026-06-1{i % 2}T10:00:00Z", "sourceIp": "s"}
        for i in range(5)
    ]
    first.append({"alertId": "bad-ts", "timestamp": "garbage"})
    first.append({"sourceIp": "no id"})
    _write_messages(spark, src, first)
    q = start_lake(_stream(spark, src), lake, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    assert read_lake(spark, lake).count() == 6

    _write_messages(spark, src, [{"alertId": "late", "timestamp": "2026-06-12T00:00:00+02:00"}], 100)
    q = start_lake(_stream(spark, src), lake, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    back = read_lake(spark, lake)
    ids = sorted(r.alertId for r in back.collect())
    assert ids == sorted([str(i) for i in range(5)] + ["bad-ts", "late"])
    by_id = {r.alertId: r.dt for r in back.collect()}
    assert by_id["bad-ts"] is None
    assert by_id["late"] == dt.date(2026, 6, 11)
    assert by_id["0"] == dt.date(2026, 6, 10)
    assert dict(back.dtypes)["dt"] == "date"


def test_event_time_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    alerts = []
    for minute in range(5):
        for k in range(4):
            alerts.append({
                "sourceIp": f"s{k % 2}",
                "deviceId": f"d{k}",
                "type": "SCAN",
                "severity": "MEDIUM",
                "timestamp": (T0 + dt.timedelta(minutes=minute, seconds=k)).strftime("%Y-%m-%dT%H:%M:%SZ"),
            })
    _write_messages(spark, src, alerts)
    anoms = detector_stream(_stream(spark, src), 60, 2, "10 seconds")
    q = (
        anoms.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    streamed = sorted(
        (r.sourceIp, r.windowStart, r.alertCount, tuple(r.deviceIds))
        for r in spark.read.schema(anoms.schema).parquet(out).collect()
    )

    static = spark.read.schema(KAFKA_ROW_SCHEMA).parquet(src)
    ev = parse_events(static.withColumnRenamed("timestamp", "kafka_ts"), keep=("kafka_ts", "partition", "offset"))
    ev = ev.withColumn("event_ts", F.try_to_timestamp("timestamp"))
    batch = detect_anomalies(ev, 60, 2, order=F.struct("kafka_ts", "partition", "offset"))
    max_ts = T0 + dt.timedelta(minutes=4, seconds=3)
    closed = [
        (r.sourceIp, r.windowStart, r.alertCount, tuple(r.deviceIds))
        for r in batch.collect()
        if r.window.end <= max_ts - dt.timedelta(seconds=10)
    ]
    assert streamed == sorted(closed)
    # watermark = 00:04:03 - 10 s: minutes 0-2 closed, minutes 3-4 still open
    assert len(streamed) == 6


def test_processing_time_window_closes_while_idle(spark, tmp_dir):
    src, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    got = []

    def sink(df, batch_id):
        got.extend(df.collect())

    _write_messages(spark, src, [{"sourceIp": "x", "deviceId": "warmup"}])
    events = parse_events(
        _stream(spark, src).withColumnRenamed("timestamp", "kafka_ts"),
        keep=("kafka_ts", "partition", "offset"),
    )
    q = start_processing_time_detector(
        events, window_seconds=2, threshold=3, sink=sink, checkpoint=ckpt,
        trigger={"processingTime": "500 milliseconds"},
    )
    try:
        time.sleep(3)
        burst = [
            {"sourceIp": "a", "deviceId": f"d{i % 3}", "type": "SCAN", "severity": sev}
            for i, sev in enumerate(["LOW", "medium", "LOW", "LOW", "LOW"])
        ] + [{"sourceIp": "b", "deviceId": "z"}]
        _write_messages(spark, src, burst, 10)
        deadline = time.time() + 30
        while time.time() < deadline and not any(r.sourceIp == "a" for r in got):
            time.sleep(0.5)
    finally:
        q.stop()
    hits = [r for r in got if r.sourceIp == "a"]
    assert q.exception() is None
    # one anomaly for the burst (it may straddle a window edge: counts then add up to 5)
    assert sum(r.alertCount for r in hits) == 5 or any(r.alertCount >= 3 for r in hits)
    first = hits[0]
    assert first.type == "ESCALATED_SOURCE"
    assert first.deviceIds[0] == "d0" and first.alertTypes == ["SCAN"]
    assert first.severity in ("HIGH", "MEDIUM")
    assert not any(r.sourceIp == "b" for r in got)


def test_lake_dedupe_within_watermark(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    alerts = [{"alertId": "a", "timestamp": "2026-06-11T10:00:00Z"}] * 3 + [
        {"alertId": "b", "timestamp": "2026-06-11T10:00:00Z"}
    ]
    _write_messages(spark, src, alerts)
    q = start_lake(_stream(spark, src), lake, ckpt, trigger={"availableNow": True},
                   dedupe_within="1 hour")
    q.awaitTermination()
    assert sorted(r.alertId for r in read_lake(spark, lake).collect()) == ["a", "b"]


def test_event_time_detector_resumes_from_checkpoint(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def minute_alerts(minutes, offset):
        rows = []
        for minute in minutes:
            for k in range(3):
                rows.append({
                    "sourceIp": "s1" if k < 2 else "s2",
                    "deviceId": f"d{k}",
                    "type": "SCAN",
                    "severity": "LOW",
                    "timestamp": (T0 + dt.timedelta(minutes=minute, seconds=k)).strftime(
                        "%Y-%m-%dT%H:%M:%SZ"
                    ),
                })
        _write_messages(spark, src, rows, offset)

    def run():
        anoms = detector_stream(_stream(spark, src), 60, 2, "5 seconds")
        q = (
            anoms.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt).outputMode("append")
            .trigger(availableNow=True).start()
        )
        q.awaitTermination()
        return anoms.schema

    minute_alerts(range(0, 3), 0)
    run()  # state for the open minute is kept in the checkpoint
    minute_alerts(range(3, 6), 100)
    schema = run()
    got = sorted(
        (r.sourceIp, r.windowStart, r.alertCount)
        for r in spark.read.schema(schema).parquet(out).collect()
    )
    # s1 has 2 alerts per minute (threshold 2). Final watermark 00:05:02 - 5 s
    # = 00:04:57: minutes 0-3 closed (minute 0 in the first run, 1-3 after the
    # restart), each exactly once; minutes 4-5 still open.
    assert got == [("s1", f"2024-01-01T00:0{m}:00Z", 2) for m in range(4)]


def test_processing_time_merge_is_exact(spark, tmp_dir):
    import random

    src, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    got = []
    rnd = random.Random(5)
    burst = [
        {"sourceIp": "hot", "deviceId": f"d{rnd.randrange(12)}", "type": rnd.choice(["A", "B", "C"]),
         "severity": rnd.choice(["LOW", "MEDIUM"])}
        for _ in range(120)
    ]
    _write_messages(spark, src, [{"sourceIp": "x"}])
    events = parse_events(
        _stream(spark, src).withColumnRenamed("timestamp", "kafka_ts"),
        keep=("kafka_ts", "partition", "offset"),
    )
    q = start_processing_time_detector(
        events, window_seconds=3, threshold=3, sink=lambda df, _: got.extend(df.collect()),
        checkpoint=ckpt, trigger={"processingTime": "500 milliseconds"},
    )
    try:
        time.sleep(2)
        _write_messages(spark, src, burst, 10)  # one file: one micro-batch, one window
        deadline = time.time() + 40
        while time.time() < deadline and not any(r.sourceIp == "hot" for r in got):
            time.sleep(0.5)
    finally:
        q.stop()
    hits = [r for r in got if r.sourceIp == "hot"]
    assert len(hits) == 1, hits
    (row,) = hits
    # arrival order = offset order here (one partition, increasing offsets)
    devices, types = [], []
    for a in burst:
        if a["deviceId"] not in devices:
            devices.append(a["deviceId"])
        if a["type"] not in types:
            types.append(a["type"])
    assert row.alertCount == 120
    assert row.deviceIds == devices and row.deviceId == devices[0]
    assert row.alertTypes == types
    assert row.severity == "HIGH"


def test_processing_time_state_survives_restart(spark, tmp_dir, heartbeat=True):
    src, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    got, batches = [], []
    _write_messages(spark, src, [{"sourceIp": "x"}])

    def sink(df, batch_id):
        got.extend(df.collect())
        batches.append(batch_id)

    def start():
        events = parse_events(
            _stream(spark, src).withColumnRenamed("timestamp", "kafka_ts"),
            keep=("kafka_ts", "partition", "offset"),
        )
        return start_processing_time_detector(
            events, window_seconds=10, threshold=3, sink=sink, checkpoint=ckpt,
            trigger={"processingTime": "500 milliseconds"}, heartbeat=heartbeat,
        )

    q = start()
    try:
        time.sleep(1.5)
        # land the burst near the start of a 10 s processing-time window
        time.sleep((10 - time.time() % 10) + 0.3)
        window_end = time.time() - time.time() % 10 + 10
        _write_messages(spark, src, [{"sourceIp": "r", "deviceId": f"d{i}"} for i in range(4)], 10)
        time.sleep(5)  # the burst's batch is committed
    finally:
        q.stop()
    assert not any(r.sourceIp == "r" for r in got)  # window still open when stopped
    time.sleep(max(window_end - time.time(), 0) + 0.5)  # the window ends while down
    q = start()  # no new alerts after the restart
    try:
        deadline = time.time() + 20
        while time.time() < deadline and not any(r.sourceIp == "r" for r in got):
            time.sleep(0.5)
    finally:
        q.stop()
    hits = [r for r in got if r.sourceIp == "r"]
    assert len(hits) == 1 and hits[0].alertCount == 4
    assert hits[0].deviceIds == ["d0", "d1", "d2", "d3"]


def test_event_time_drops_rows_behind_the_watermark(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def alert(src_ip, minute, second):
        ts = T0 + dt.timedelta(minutes=minute, seconds=second)
        return {"sourceIp": src_ip, "deviceId": "d", "timestamp": ts.strftime("%Y-%m-%dT%H:%M:%SZ")}

    def run():
        anoms = detector_stream(_stream(spark, src), 60, 2, "5 seconds")
        q = (
            anoms.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt).outputMode("append")
            .trigger(availableNow=True).start()
        )
        q.awaitTermination()
        return spark.read.schema(anoms.schema).parquet(out).collect()

    _write_messages(spark, src, [alert("on-time", m, s) for m in range(6) for s in (1, 2)])
    run()  # watermark now past minute 4
    _write_messages(spark, src, [alert("late", 0, s) for s in (10, 20, 30)], 100)
    rows = run()
    assert not any(r.sourceIp == "late" for r in rows)
    # watermark 00:05:02 - 5 s = 00:04:57: minutes 0-3 closed, 4-5 open
    assert sorted(r.windowStart for r in rows if r.sourceIp == "on-time") == [
        f"2024-01-01T00:0{m}:00Z" for m in range(4)
    ]
