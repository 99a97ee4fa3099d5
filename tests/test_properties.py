"""Property tests: trim and the windowed detector against plain-Python folds."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alertscope.functions.text import WHITESPACE_CHARS, unicode_trim
from alertscope.operators.detect import detect_anomalies

SETTINGS = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

# whitespace, look-alikes that are not trimmed (NEL, zero-width space, BOM), text
ALPHABET = list(WHITESPACE_CHARS) + ["\u0085", "\u200b", "\ufeff", "a", "\u00e9", "\u65e5", "-"]


@SETTINGS
@given(texts=st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=1, max_size=20))
def test_trim_matches_python_strip(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r.t for r in df.select("i", unicode_trim("s").alias("t")).orderBy("i").collect()]
    assert got == [t.strip(WHITESPACE_CHARS) for t in texts]


BASE = dt.datetime(2024, 1, 1)
event = st.tuples(
    st.sampled_from(["s1", "s2"]),
    st.sampled_from(["", "d1", "d2", "d3"]),
    st.sampled_from(["", "A", "B"]),
    st.sampled_from(["LOW", "MEDIUM", "medium", " high ", "CRITICAL", "bogus"]),
    st.integers(0, 179),  # seconds: three 60 s windows
)


def _expected(rows, threshold):
    groups: dict = {}
    for seq, (src, dev, typ, sev, sec) in enumerate(rows):
        groups.setdefault((src, sec // 60), []).append((sec, seq, dev, typ, sev))
    out = []
    for (src, w), evs in groups.items():
        if len(evs) < threshold:
            continue
        evs.sort()
        devs, typs = [], []
        for _, _, dev, typ, _ in evs:
            if dev and dev not in devs:
                devs.append(dev)
            if typ and typ not in typs:
                typs.append(typ)
        sevs = {e[4].strip().upper() for e in evs}
        sev = "CRITICAL" if sevs & {"CRITICAL", "HIGH"} else "HIGH" if "MEDIUM" in sevs else "MEDIUM"
        start = (BASE + dt.timedelta(seconds=60 * w)).strftime("%Y-%m-%dT%H:%M:%SZ")
        out.append((src, start, len(evs), tuple(devs), tuple(typs), sev))
    return sorted(out)


@SETTINGS
@given(rows=st.lists(event, max_size=25), threshold=st.integers(1, 4))
def test_detector_matches_fold(spark, rows, threshold):
    data = [
        (src, dev, typ, sev, BASE + dt.timedelta(seconds=sec), seq)
        for seq, (src, dev, typ, sev, sec) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data,
        "sourceIp string, deviceId string, type string, severity string, event_ts timestamp, seq long",
    )
    got = detect_anomalies(df, 60, threshold, order=F.struct("event_ts", "seq")).collect()
    assert sorted(
        (r.sourceIp, r.windowStart, r.alertCount, tuple(r.deviceIds), tuple(r.alertTypes), r.severity)
        for r in got
    ) == _expected(rows, threshold)
