"""Windowed anomaly detection (batch form), checked against brute force."""

from __future__ import annotations

import collections
import datetime as dt
import random

from pyspark.sql import functions as F

from alertscope.operators.detect import detect_anomalies

BASE = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    """rows: (sourceIp, deviceId, type, severity, seconds from BASE, seq)."""
    data = [(s, d, t, sev, BASE + dt.timedelta(seconds=sec), seq) for s, d, t, sev, sec, seq in rows]
    return spark.createDataFrame(
        data, "sourceIp string, deviceId string, type string, severity string, event_ts timestamp, seq long"
    )


def _detect(spark, rows, window=60, threshold=3):
    ev = _events(spark, rows)
    out = detect_anomalies(ev, window, threshold, order=F.struct("event_ts", "seq"))
    return sorted(out.drop("window").collect(), key=lambda r: (r.sourceIp, r.windowStart))


def test_threshold_rows(spark):
    two = [("a", "d", "T", "LOW", 1, 1), ("a", "d", "T", "LOW", 2, 2)]
    assert _detect(spark, two) == []
    three = two + [("a", "d", "T", "LOW", 3, 3)]
    (row,) = _detect(spark, three)
    assert row.alertCount == 3 and row.severity == "MEDIUM"
    assert (row.windowStart, row.windowEnd) == ("2024-01-01T00:00:00Z", "2024-01-01T00:01:00Z")


def test_first_seen_order_and_blanks(spark):
    rows = [
        ("a", "d2", "SCAN", "LOW", 5, 1),
        ("a", "", "", "medium", 6, 2),
        ("a", "d1", "DOS", "LOW", 7, 3),
        ("a", "d2", "SCAN", "LOW", 8, 4),
        ("a", "d3", "SCAN", "LOW", 9, 5),
    ]
    (row,) = _detect(spark, rows)
    assert row.deviceIds == ["d2", "d1", "d3"] and row.deviceId == "d2"
    assert row.alertTypes == ["SCAN", "DOS"]
    assert row.severity == "HIGH" and row.alertCount == 5


def test_windows_are_epoch_aligned_half_open(spark):
    rows = [("a", "d", "T", "HIGH", s, i) for i, s in enumerate([57, 58, 59, 60, 61])]
    got = _detect(spark, rows)
    assert [(r.windowStart, r.alertCount, r.severity) for r in got] == [
        ("2024-01-01T00:00:00Z", 3, "CRITICAL")
    ]


def test_no_device_gives_empty_first_device(spark):
    rows = [("a", "", "", "LOW", i, i) for i in range(3)]
    (row,) = _detect(spark, rows)
    assert row.deviceId == "" and row.deviceIds == [] and row.alertTypes == []


def test_hot_source_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    seq = 0
    for _ in range(6000):
        src = "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(50)}"
        rows.append((src, f"d{rnd.randrange(40)}", rnd.choice(["A", "B", "C", ""]),
                     rnd.choice(["LOW", "MEDIUM", "HIGH", "low"]), rnd.randrange(600), seq))
        seq += 1
    got = _detect(spark, rows, window=120, threshold=3)

    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[0], r[4] // 120)].append(r)
    want = []
    for (src, w), evs in groups.items():
        if len(evs) < 3:
            continue
        evs.sort(key=lambda e: (e[4], e[5]))
        devs, typs = [], []
        for e in evs:
            if e[1] and e[1] not in devs:
                devs.append(e[1])
            if e[2] and e[2] not in typs:
                typs.append(e[2])
        sevs = {e[3].upper() for e in evs}
        sev = "CRITICAL" if sevs & {"CRITICAL", "HIGH"} else "HIGH" if "MEDIUM" in sevs else "MEDIUM"
        start = BASE + dt.timedelta(seconds=w * 120)
        want.append((src, start.strftime("%Y-%m-%dT%H:%M:%SZ"), len(evs), devs, typs, sev))
    want.sort(key=lambda t: (t[0], t[1]))
    assert [(r.sourceIp, r.windowStart, r.alertCount, r.deviceIds, r.alertTypes, r.severity) for r in got] == want


def test_plan_combines_before_each_shuffle(spark):
    ev = _events(spark, [("a", "d", "T", "LOW", 1, 1)])
    plan = detect_anomalies(ev, 60, 3, order=F.col("event_ts"))._jdf.queryExecution().executedPlan().toString()
    # level 1 partial → exchange on (window, source, device, type) → final;
    # level 2 partial → exchange on (window, source) → final
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_count") == 1 and plan.count("partial_sum") == 1
    assert "partial_collect_list" in plan


def test_arrival_order_is_total(spark):
    from alertscope.operators.detect import arrival_order

    rows = [
        (None, None, None), (-1, 0, 5), (-1, 0, 6), (0, 0, 0), (1, None, 3), (1, 0, 2), (1, 99_999, 0),
        (1, 2_000_000_000, (1 << 63) - 1), (10**15, 0, 0),
    ]
    df = spark.createDataFrame(rows, "ms long, p int, o long").selectExpr("*", "timestamp_millis(ms) AS t")
    got = [r.x for r in df.select(arrival_order("t", "p", "o").alias("x")).collect()]
    assert None not in got and got == sorted(got)
