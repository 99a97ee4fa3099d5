"""JSON edge rows (FIXTURES §6) through the lake parse and the detector parse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from alertscope.operators.parse import parse_alerts, parse_events
from alertscope.schema import LAKE_COLUMNS


def _messages(spark, values):
    ts = dt.datetime(2026, 6, 11, 10, 0, 0)
    rows = [
        (None if v is None else v.encode("utf-8"), i, ts) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "value binary, offset long, timestamp timestamp")


def _lake_ids(spark, values):
    out = parse_alerts(_messages(spark, values))
    return [r.alertId for r in out.collect()]


def test_lake_parse_alert_id_guard(spark):
    values = [
        '{"alertId":"a"}',
        '{"alertId":123}',
        '{"alertId":true}',
        '{"alertId":{"x":1}}',
        '{"alertId":null}',
        "{}",
        '{"alertId":"  "}',
        '{"alertId":"\\t a "}',
        "not json",
        '{"alertId":"tr',
        "",
        "   ",
        None,
        '[{"alertId":"z"}]',
        "null",
        '{"alertId":"d"} trailing',
        '{"alertId":"e","alertId":"f"}',
        '{"AlertId":"wrong-case"}',
    ]
    got = _lake_ids(spark, values)
    assert got == ["a", "123", "true", '{"x":1}', "  ", "\t a ", "d", "f"]


def test_lake_parse_types_and_partition(spark):
    values = [
        '{"alertId":"1","destinationPort":"80","sourcePort":80.5,"packetCount":"abc",'
        '"windowSeconds":3000000000,"acknowledged":"true","timestamp":"2026-06-12T00:00:00+02:00"}',
        '{"alertId":"2","destinationPort":443,"acknowledged":false,"timestamp":"garbage"}',
        '{"alertId":"3","timestamp":""}',
        '{"alertId":"4","timestamp":"2026-06-11T10:00:00.123Z"}',
        '{"alertId":"5","timestamp":"2026-06-11"}',
        '{"alertId":"6","timestamp":"2026-06-11T23:30:00"}',
    ]
    out = parse_alerts(_messages(spark, values))
    assert out.columns == LAKE_COLUMNS
    types = dict(out.dtypes)
    assert types["sourcePort"] == "int" and types["packetCount"] == "bigint"
    assert types["event_ts"] == "timestamp" and types["dt"] == "date"
    rows = {r.alertId: r for r in out.collect()}
    r1 = rows["1"]
    assert (r1.destinationPort, r1.sourcePort, r1.packetCount, r1.windowSeconds, r1.acknowledged) == (
        None, None, None, None, None,
    )
    assert r1.dt == dt.date(2026, 6, 11)  # +02:00 midnight is the previous UTC day
    assert rows["2"].destinationPort == 443 and rows["2"].acknowledged is False
    assert rows["2"].event_ts is None and rows["2"].dt is None
    assert rows["3"].event_ts is None and rows["3"].dt is None
    assert rows["4"].event_ts == dt.datetime(2026, 6, 11, 10, 0, 0, 123000)
    assert rows["5"].dt == dt.date(2026, 6, 11)
    # zone-less text is read in the (UTC) session zone
    assert rows["6"].event_ts == dt.datetime(2026, 6, 11, 23, 30) and rows["6"].dt == dt.date(2026, 6, 11)


def test_detector_parse_edges(spark):
    values = [
        '{"sourceIp":"a"}',
        '{"sourceIp":123}',
        '{"sourceIp":true}',
        '{"sourceIp":{"x":1}}',
        '{"sourceIp":[1]}',
        '{"sourceIp":null}',
        "{}",
        '{"sourceIp":"  "}',
        '{"sourceIp":"\\t a "}',
        "not json",
        '{"sourceIp":"tr',
        "",
        "  ",
        None,
        '[{"sourceIp":"z"}]',
        "null",
        '"just a string"',
        '{"sourceIp":"d"} trailing',
        '{"sourceIp":"e","sourceIp":"f"}',
        '{"sourceIp":1.50}',
    ]
    got = [r.sourceIp for r in parse_events(_messages(spark, values), keep=("offset",)).orderBy("offset").collect()]
    assert got == ["a", "123", "true", "a", "d", "f", "1.5"]


def test_detector_parse_defaults(spark):
    values = [
        '{"sourceIp":"s1"}',
        '{"sourceIp":"s2","severity":null,"deviceId":{"a":1},"type":[1]}',
        '{"sourceIp":"s3","severity":"  ","deviceId":" dev \\u00a0","type":" scan "}',
        '{"sourceIp":"s4","severity":" high ","timestamp":" 2026-06-11T10:00:00Z "}',
    ]
    out = parse_events(_messages(spark, values)).orderBy("sourceIp").collect()
    assert [(r.sourceIp, r.deviceId, r.type, r.severity, r.timestamp) for r in out] == [
        ("s1", "", "", "LOW", ""),
        ("s2", "", "", "LOW", ""),
        ("s3", "dev", "scan", "LOW", ""),
        ("s4", "", "", "high", "2026-06-11T10:00:00Z"),
    ]


def test_detector_parse_is_narrow(spark):
    """No shuffle, and the message is parsed once per row."""
    df = parse_events(_messages(spark, ['{"sourceIp":"a"}']))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("parseJson") == 1
    assert df.select(F.count("*")).first()[0] == 1


def test_detector_parse_number_text(spark):
    # numbers read as text the way a tree-model JSON reader renders them
    cases = {
        "3": "3", "-7": "-7", "1.50": "1.5", "100.0": "100.0", "0.10": "0.1",
        "1e3": "1000.0", "1E-7": "1.0E-7", "-0.0": "-0.0",
        "12345678901234567890": "12345678901234567890",
    }
    values = ['{"sourceIp":"s","deviceId":%s}' % raw for raw in cases]
    out = parse_events(_messages(spark, values), keep=("offset",)).orderBy("offset").collect()
    assert [r.deviceId for r in out] == list(cases.values())
