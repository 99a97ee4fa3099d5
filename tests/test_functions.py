"""Scalar and aggregate helpers: trim, blank, instants, severity rules, JSON."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from alertscope.functions import (
    escalated_severity,
    iso_instant,
    is_blank,
    non_blank,
    severity_rank,
    strict_instant,
    unicode_trim,
)
from alertscope.functions.anomaly import anomaly_json, anomaly_struct


def test_unicode_trim_and_blank(spark):
    rows = [
        ("\u00a0\t a \u2028",),  # NBSP, tab, line separator
        (" b\u3000",),  # ideographic space
        ("\x1c c \x0b",),  # file separator, vertical tab
        ("\u0085d",),  # NEL is not whitespace here
        ("e\u200b",),  # zero-width space is not whitespace
        ("  ",),
        ("",),
        (None,),
    ]
    df = spark.createDataFrame(rows, "s string")
    out = df.select(
        unicode_trim("s").alias("t"), is_blank("s").alias("b"), non_blank("s").alias("nb")
    ).collect()
    assert [r.t for r in out] == ["a", "b", "c", "\u0085d", "e\u200b", "", "", None]
    assert [r.b for r in out] == [False, False, False, False, False, True, True, True]
    assert [r.nb for r in out] == [True, True, True, True, True, False, False, False]


def test_strict_instant(spark):
    rows = [
        ("2026-06-11T10:00:00Z", "2026-06-11T10:00:00.000000"),
        ("2026-06-11T10:00:00.123Z", "2026-06-11T10:00:00.123000"),
        ("2026-06-12T00:00:00+02:00", "2026-06-11T22:00:00.000000"),
        ("2026-06-11t10:00:00z", "2026-06-11T10:00:00.000000"),
        ("2026-06-11T10:00:00+02:00:30", "2026-06-11T07:59:30.000000"),
        ("2026-02-30T10:00:00Z", None),
        ("2026-06-11T24:00:00Z", "2026-06-12T00:00:00.000000"),
        ("2026-06-11T24:00:00.000+02:00", "2026-06-11T22:00:00.000000"),
        ("2026-06-11T24:00:00.5Z", None),
        ("2026-06-11T24:01:00Z", None),
        ("2026-06-11T10:00:00Z\n", None),
        ("+2026-06-11T10:00:00Z", None),
        ("2026-06-11T10:00:00+0200", None),
        ("2026-06-11", None),
        ("2026-06-11T10:00:00", None),
        ("2026-06-11T10:00Z", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "s string")
    got = df.select(
        F.date_format(strict_instant("s"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("t")
    ).collect()
    assert [r.t for r in got] == [r[1] for r in rows]


def test_severity_rank_is_case_sensitive(spark):
    df = spark.createDataFrame(
        [("CRITICAL",), ("HIGH",), ("MEDIUM",), ("LOW",), ("high",), (None,), ("bogus",)],
        "s string",
    )
    got = [r[0] for r in df.select(severity_rank("s")).collect()]
    assert got == [4, 3, 2, 1, 0, 0, 0]
    assert dict(df.select(severity_rank("s").alias("r")).dtypes)["r"] == "int"


def test_escalation_rows(spark):
    # FIXTURES §5: set → escalated severity.
    cases = {
        1: ["LOW"],
        2: [],
        3: ["bogus"],
        4: [" medium "],
        5: ["LOW", "MEDIUM"],
        6: ["high"],
        7: ["CRITICAL", "LOW"],
    }
    expected = {1: "MEDIUM", 2: "MEDIUM", 3: "MEDIUM", 4: "HIGH", 5: "HIGH", 6: "CRITICAL", 7: "CRITICAL"}
    rows = [(g, s) for g, sevs in cases.items() for s in (sevs or [None])]
    df = spark.createDataFrame(rows, "g int, s string")
    got = {r.g: r.e for r in df.groupBy("g").agg(escalated_severity("s").alias("e")).collect()}
    assert got == expected


def test_iso_instant_whole_seconds(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:00",)], "s string").select(
        F.to_timestamp("s").alias("t")
    )
    assert df.select(iso_instant("t")).first()[0] == "2024-01-02T00:00:00Z"


def test_anomaly_json_field_order_and_escaping(spark):
    df = spark.createDataFrame(
        [("10.0.0.1", ["d\"1", "d\\2"], 3, "HIGH", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", ["T\n"])],
        "s string, d array<string>, c long, sev string, ws string, we string, t array<string>",
    )
    rec = anomaly_struct(
        F.col("s"), F.col("d"), F.col("c"), F.col("sev"), F.col("ws"), F.col("we"), F.col("t")
    )
    text = df.select(anomaly_json(rec)).first()[0]
    parsed = json.loads(text)
    assert list(parsed) == [
        "type", "sourceIp", "deviceId", "deviceIds", "alertCount", "severity",
        "windowStart", "windowEnd", "alertTypes",
    ]
    assert parsed["type"] == "ESCALATED_SOURCE"
    assert parsed["deviceId"] == "d\"1"
    assert parsed["deviceIds"] == ["d\"1", "d\\2"]
    assert parsed["alertCount"] == 3
    assert parsed["alertTypes"] == ["T\n"]


def test_anomaly_first_device_defaults_to_empty(spark):
    df = spark.createDataFrame([("s", [], 3)], "s string, d array<string>, c int")
    rec = anomaly_struct(F.col("s"), F.col("d"), F.col("c"), F.lit("MEDIUM"), F.lit("a"), F.lit("b"), F.col("d"))
    row = df.select(rec.alias("r")).first().r
    assert row.deviceId == "" and row.deviceIds == [] and row.alertTypes == []


def _wire(value: str) -> str:
    """The anomaly wire format's string escaping, written from its rules."""
    out = []
    for ch in value:
        if ch == "\\":
            out.append("\\\\")
        elif ch == '"':
            out.append('\\"')
        elif ch == "\n":
            out.append("\\n")
        elif ch == "\r":
            out.append("\\r")
        elif ch == "\t":
            out.append("\\t")
        elif ch < " ":
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return '"' + "".join(out) + '"'


def test_anomaly_json_is_byte_equal_to_the_wire_format(spark):
    tricky = "".join(chr(c) for c in range(32)) + ' a\\b \\\\f "q" é日 / \x7f'
    devices = ["d\x08", "d\\u000B", tricky]
    types = ["T\x0c", "x\x1f"]
    df = spark.createDataFrame(
        [(tricky, devices, 3, "HIGH", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", types)],
        "s string, d array<string>, c long, sev string, ws string, we string, t array<string>",
    )
    rec = anomaly_struct(
        F.col("s"), F.col("d"), F.col("c"), F.col("sev"), F.col("ws"), F.col("we"), F.col("t")
    )
    got = df.select(anomaly_json(rec)).first()[0]
    arr = lambda xs: "[" + ",".join(_wire(x) for x in xs) + "]"
    want = (
        '{"type":"ESCALATED_SOURCE","sourceIp":' + _wire(tricky)
        + ',"deviceId":' + _wire(devices[0]) + ',"deviceIds":' + arr(devices)
        + ',"alertCount":3,"severity":"HIGH","windowStart":"2024-01-01T00:00:00Z"'
        + ',"windowEnd":"2024-01-02T00:00:00Z","alertTypes":' + arr(types) + "}"
    )
    assert got == want
    assert json.loads(got)["deviceIds"] == devices
