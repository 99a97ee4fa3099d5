"""Reports against brute force on a fixture, the report job, pages and latest-N."""

from __future__ import annotations

import collections
import datetime as dt
import os

from pyspark.sql import functions as F

from alertscope.operators import reports as R
from alertscope.plans.report_job import GROWING_REPORTS, run_reports
from alertscope.schema import LAKE_SCHEMA
from alertscope.sources.pages import latest, unnest_pages

DAY = dt.date(2026, 6, 11)


def _alerts(spark, rows):
    """rows: (alertId, deviceId, type, severity, sourceIp, destinationIp, destinationPort, dt)."""
    full = []
    for aid, dev, typ, sev, src, dst, port, day in rows:
        ts = None if day is None else dt.datetime(day.year, day.month, day.day, 12, 0, 0)
        full.append(
            (aid, dev, None, typ, sev, "TCP", src, dst, 1, port, 1, 1, 60, None, False, None, ts, ts, day)
        )
    return spark.createDataFrame(full, LAKE_SCHEMA)


FIXTURE = [
    ("1", "d1", "SCAN", "HIGH", "s1", "t1", 80, DAY),
    ("2", "d1", "SCAN", "high", "s1", "t2", 80, DAY),
    ("3", "d2", None, None, "s1", "t1", 443, DAY),
    ("4", "d2", "DOS", "CRITICAL", "s2", "t3", None, DAY),
    ("5", None, "DOS", "LOW", None, "t3", 22, DAY + dt.timedelta(days=1)),
    ("6", None, None, "MEDIUM", "s3", None, 22, None),
    ("7", "d3", "SCAN", "bogus", "s2", "t3", 22, DAY + dt.timedelta(days=1)),
]


def test_reports_match_brute_force(spark):
    alerts = _alerts(spark, FIXTURE)
    rank = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}

    # top_source_ips
    exp = collections.defaultdict(list)
    for r in FIXTURE:
        if r[4] is not None:
            exp[r[4]].append(r)
    want = sorted(
        (
            (s, len(v), len({x[5] for x in v if x[5]}), len({x[6] for x in v if x[6] is not None}),
             max(rank.get(x[3], 0) for x in v))
            for s, v in exp.items()
        ),
        key=lambda t: (-t[1], t[0]),
    )
    got = [tuple(r) for r in R.top_source_ips(alerts).collect()]
    assert got == want

    # alerts_per_device: null device is its own group
    per_dev = collections.Counter(r[1] for r in FIXTURE)
    got = {r.deviceId: r.alert_count for r in R.alerts_per_device(alerts).collect()}
    assert got == dict(per_dev)

    sev = {r.severity: r.alert_count for r in R.severity_distribution(alerts).collect()}
    assert sev == {"HIGH": 1, "high": 1, "UNKNOWN": 1, "CRITICAL": 1, "LOW": 1, "MEDIUM": 1, "bogus": 1}
    typ = {r.type: r.alert_count for r in R.type_distribution(alerts).collect()}
    assert typ == {"SCAN": 3, "UNKNOWN": 2, "DOS": 2}

    trend = [tuple(r) for r in R.daily_trend(alerts).collect()]
    assert trend == [
        (None, 1, 1, 0),
        (DAY, 4, 2, 2),
        (DAY + dt.timedelta(days=1), 2, 1, 1),
    ]

    ports = [tuple(r) for r in R.top_destination_ports(alerts).collect()]
    assert ports == [(22, 3), (80, 2), (443, 1)]
    assert R.total_alerts(alerts).first()[0] == 7


def test_top_k_cut_is_deterministic(spark):
    rows = [(str(i), "d", "T", "LOW", f"s{i:03d}", "t", i, DAY) for i in range(150)]
    alerts = _alerts(spark, rows)
    top = [r.sourceIp for r in R.top_source_ips(alerts).collect()]
    assert top == [f"s{i:03d}" for i in range(100)]
    ports = [r.destinationPort for r in R.top_destination_ports(alerts).collect()]
    assert ports == list(range(50))


def test_report_plan_prunes_and_pushes_down(spark, tmp_dir):
    path = f"{tmp_dir}/lake"
    _alerts(spark, FIXTURE).write.partitionBy("dt").parquet(path)
    lake = spark.read.schema(LAKE_SCHEMA).parquet(path)
    plan = R.top_source_ips(lake)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sourceIp)]" in plan
    assert "TakeOrderedAndProject" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<severity:string,sourceIp:string,destinationIp:string,destinationPort:int>" in scan
    ranged = R.daily_trend(R.in_date_range(lake, since=DAY, until=DAY))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert [r.dt for r in ranged.collect()] == [DAY]


def test_run_reports_writes_each_report(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    _alerts(spark, FIXTURE).write.partitionBy("dt").parquet(lake)
    status = run_reports(spark, lake, f"{tmp_dir}/reports")
    assert status == {name: "ok" for name in R.REPORTS}
    for name in R.REPORTS:
        files = [f for f in os.listdir(f"{tmp_dir}/reports/{name}") if f.endswith(".parquet")]
        if name in GROWING_REPORTS:  # free keys: written by many tasks
            assert len(files) >= 1
        else:
            assert len(files) == 1
    back = spark.read.parquet(f"{tmp_dir}/reports/top_source_ips").collect()
    assert [r.sourceIp for r in back] == ["s1", "s2", "s3"]


def test_run_reports_skips_empty_and_missing(spark, tmp_dir):
    assert set(run_reports(spark, f"{tmp_dir}/missing", f"{tmp_dir}/out").values()) == {
        "skipped: no readable input"
    }
    empty = _alerts(spark, FIXTURE).limit(0)
    assert set(run_reports(spark, empty, f"{tmp_dir}/out").values()) == {"skipped: no alerts"}


def test_unnest_pages(spark):
    bodies = [
        '{"data":{"content":[{"alertId":"1"},{"alertId":"2","x":{"y":1}},5,null]}}',
        '{"data":{"content":{"alertId":"3"}}}',
        '{"data":[{"content":[{"alertId":"4"}]}]}',
        "{}",
        "bad",
        "[1]",
        None,
    ]
    bodies.append('{"data":{"content":[{"z":1,"alertId":"7"},{"alertId":"8","alertId":"9"},"s",[1]]}}')
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    out = unnest_pages(pages)
    rows = out.selectExpr("json", "variant_get(alert, '$.alertId', 'string') AS id").collect()
    # elements keep their own text and key order; of a repeated key the last value
    # counts; text that looks like an object is text
    assert sorted((r.json, r.id) for r in rows) == [
        ('{"alertId":"1"}', "1"),
        ('{"alertId":"2","x":{"y":1}}', "2"),
        ('{"alertId":"8","alertId":"9"}', "9"),
        ('{"z":1,"alertId":"7"}', "7"),
    ]
    quoted = spark.createDataFrame([('{"data":{"content":["{\\"alertId\\":\\"x\\"}"]}}',)], "body string")
    assert unnest_pages(quoted).count() == 0


def test_latest_n(spark):
    rows = [(str(i), "d", "T", "LOW", "s", "t", 1, DAY) for i in range(10)]
    alerts = _alerts(spark, rows).withColumn(
        "event_ts", F.timestamp_seconds(F.col("alertId").cast("long"))
    )
    assert [r.alertId for r in latest(alerts, 3).collect()] == ["9", "8", "7"]


def test_run_reports_dedupe_is_opt_in(spark, tmp_dir):
    twice = _alerts(spark, FIXTURE + FIXTURE[:2])
    run_reports(spark, twice, f"{tmp_dir}/plain")
    run_reports(spark, twice, f"{tmp_dir}/dedup", dedupe=True)
    plain = spark.read.parquet(f"{tmp_dir}/plain/top_source_ips").collect()
    dedup = spark.read.parquet(f"{tmp_dir}/dedup/top_source_ips").collect()
    assert [(r.sourceIp, r.alert_count) for r in plain][0] == ("s1", 5)
    assert [(r.sourceIp, r.alert_count) for r in dedup][0] == ("s1", 3)


def test_reports_with_a_source_holding_a_third_of_rows(spark):
    import random

    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        src = "hot" if i % 3 == 0 else f"s{rnd.randrange(200)}"
        rows.append((str(i), f"d{rnd.randrange(30)}", "SCAN", rnd.choice(["LOW", "HIGH"]), src,
                     f"t{rnd.randrange(500)}", rnd.randrange(1000), DAY))
    alerts = _alerts(spark, rows).repartition(8)
    top = R.top_source_ips(alerts)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "partial_count" in plan
    got = {r.sourceIp: (r.alert_count, r.distinct_targets, r.distinct_ports) for r in top.collect()}
    hot = [r for r in rows if r[4] == "hot"]
    assert got["hot"] == (1000, len({r[5] for r in hot}), len({r[6] for r in hot}))
    per_dev = {r.deviceId: r.alert_count for r in R.alerts_per_device(alerts).collect()}
    assert sum(per_dev.values()) == 3000


def test_one_failed_report_does_not_stop_the_others(spark, tmp_dir, monkeypatch):
    def broken(alerts):
        raise RuntimeError("no such measure")

    monkeypatch.setitem(R.REPORTS, "daily_trend", broken)
    status = run_reports(spark, _alerts(spark, FIXTURE), f"{tmp_dir}/reports")
    assert status["daily_trend"] == "failed: RuntimeError: no such measure"
    assert all(v == "ok" for k, v in status.items() if k != "daily_trend")


def test_damaged_lake_is_skipped(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/lake/dt=2026-06-11")
    with open(f"{tmp_dir}/lake/dt=2026-06-11/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    status = run_reports(spark, f"{tmp_dir}/lake", f"{tmp_dir}/reports")
    assert set(status.values()) == {"skipped: no readable input"}
