"""Windows with keyed state and timers: sums, placement by reading time, restarts."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import sys
import time

from pyspark import cloudpickle

from alertscope.operators.parse import detector_events
from alertscope.schema import KAFKA_ROW_SCHEMA
from alertscope.streaming import timed_windows as W
from alertscope.streaming.processing_time import with_heartbeat

cloudpickle.register_pickle_by_value(sys.modules[__name__])
BASE = dt.datetime(2026, 1, 1)


def mark(order, value):
    return f"{order:038d}{value}"


def test_merging_parts_in_any_order():
    rnd = random.Random(1)
    rows = [(i, rnd.choice("abc"), rnd.random() < 0.2) for i in range(60)]
    want = list(dict.fromkeys(v for _, v, _ in rows))
    for _ in range(5):
        rnd.shuffle(rows)
        parts = [(1, top, False, [mark(i, v)], []) for i, v, top in rows]
        whole = parts[0]
        for part in parts[1:]:
            whole = W.merged(whole, part)
        assert whole[0] == 60 and whole[1] == any(t for *_, t in rows) and [x[38:] for x in whole[3]] == want


def messages(spark, folder, alerts, first=0):
    rows = [(None, json.dumps(a).encode(), "t", 0, first + i, BASE + dt.timedelta(seconds=first + i), 0) for i, a in enumerate(alerts)]
    spark.createDataFrame(rows, KAFKA_ROW_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def alert(source, device, kind="SCAN", severity="LOW"):
    return {"sourceIp": source, "deviceId": device, "type": kind, "severity": severity}


def test_rows_are_placed_when_they_are_read(spark):
    events = spark.createDataFrame(
        [("a", "d1", "T", "HIGH", BASE, 0, 1), ("a", "d0", "", "low", BASE, 0, 0), ("b", "", "T", "MEDIUM", BASE, 0, 2)],
        "sourceIp string, deviceId string, type string, severity string, kafka_ts timestamp, partition int, offset long",
    ).coalesce(1)
    got = {r.sourceIp: r for r in W.read_time_partials(events, 1000, clock=lambda: 12_345).collect()}
    assert {r.window_ms for r in got.values()} == {12_000}
    assert (got["a"].n, got["a"].top, got["a"].mid) == (2, True, False) and (got["b"].top, got["b"].mid) == (False, True)
    assert [x[38:] for x in got["a"].devices] == ["d0", "d1"] and [x[38:] for x in got["b"].devices] == []

    def ticking():
        time.sleep(0.01)
        return W.now_ms()

    # one batch whose rows are read at different times: several windows
    many = spark.range(0, 200, 1, 1).selectExpr(
        "'a' sourceIp", "'d' deviceId", "'t' type", "'LOW' severity", "timestamp_seconds(id) kafka_ts", "0 partition", "id offset")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        parts = W.read_time_partials(many, 20, clock=ticking).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r.n for r in parts) == 200 and len({r.window_ms for r in parts}) > 3


def test_a_restart_closes_what_was_left_open(spark, tmp_dir):
    src, ckpt, found = f"{tmp_dir}/in", f"{tmp_dir}/ckpt", []
    hot = [alert("hot", f"d{i % 3}", severity="MEDIUM") for i in range(40)]
    messages(spark, src, [*hot, alert("few", "d"), alert("few", "d"), alert("", "d")])

    def start(hour, heartbeat=False):
        stream = spark.readStream.schema(KAFKA_ROW_SCHEMA).parquet(src)
        events = detector_events(stream).drop("event_ts")
        if heartbeat:
            events = with_heartbeat(events).filter("not _beat").drop("_beat")
        sink = lambda df, i: found.extend(r.asDict() for r in df.collect())
        return W.start_timed_detector(events, 3600, 3, sink, ckpt, clock=lambda: hour)

    now = W.now_ms()
    hour = now // 3_600_000 * 3_600_000
    q = start(hour)  # the window's end is still to come
    deadline = time.time() + 90
    while time.time() < deadline and not any(p.numInputRows for p in q.recentProgress):
        time.sleep(0.2)
    q.stop()
    assert not found
    # more of the same window, read at a time that is over: its timer fires at once
    messages(spark, src, [alert("hot", "late", "OTHER")], first=100)
    q = start(hour - 7_200_000)
    W.run_until_closed(q, 3_600_000, clock=lambda: hour - 7_200_000)
    assert not found  # one alert only in the older window, and the other is open still
    assert os.path.isdir(f"{ckpt}/state")
