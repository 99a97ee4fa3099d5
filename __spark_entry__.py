"""

Every query reads the ``events`` table at ``sf_dir`` and maps each event to
one alert (see ``alertscope.sources.events``); the oracle SQL below writes
the same mapping independently in DuckDB's dialect and then the expected
result directly, without the package's operators.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from alertscope.plans.queries import QUERIES  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline  # noqa: E402
    from alertscope.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "alertscope.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the top-100 source report over sf0.001."""
    return QUERIES["top_source_ips"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(QUERIES)
    if llm_queries is not None:
        out |= llm_queries.QUERIES
        out["pipeline"] = corpus_pipeline.run
    return out


# The events → alerts mapping, in DuckDB SQL.
_ALERTS = """
alerts AS (
  SELECT
    CAST(event_id AS VARCHAR) AS alertId,
    'dev-' || CAST(event_id % 7 AS VARCHAR) AS deviceId,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
    CASE WHEN event_type <> 'view' THEN upper(event_type) END AS "type",
    CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH'
                    WHEN 'click' THEN 'MEDIUM' WHEN 'signup' THEN 'LOW' END AS severity,
    'TCP' AS protocol,
    CASE WHEN user_id % 50 <> 49 THEN '10.0.0.' || CAST(user_id AS VARCHAR) END AS sourceIp,
    '192.168.1.' || CAST(event_id % 64 AS VARCHAR) AS destinationIp,
    CAST(40000 + event_id % 20000 AS INTEGER) AS sourcePort,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 <> 0
         THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS destinationPort,
    CAST(event_id % 1000 + 1 AS BIGINT) AS packetCount,
    CAST((event_id % 1000 + 1) * 512 AS BIGINT) AS bytesCount,
    CAST(60 AS INTEGER) AS windowSeconds,
    event_type AS description,
    event_id % 2 = 0 AS acknowledged,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS createdAt,
    date_trunc('millisecond', ts) AS kafka_ts,
    ts AS event_ts,
    CAST(ts AS DATE) AS dt
  FROM events
)"""

_SEV_RANK = (
    "MAX(CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 "
    "WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END)"
)

_REPORT_SQL = {
    "top_source_ips": f"""
SELECT sourceIp, COUNT(*) AS alert_count,
       COUNT(DISTINCT destinationIp) AS distinct_targets,
       COUNT(DISTINCT destinationPort) AS distinct_ports,
       {_SEV_RANK} AS max_severity_rank
FROM alerts WHERE sourceIp IS NOT NULL
GROUP BY sourceIp ORDER BY alert_count DESC, sourceIp LIMIT 100""",
    "alerts_per_device": """
SELECT deviceId, COUNT(*) AS alert_count, COUNT(DISTINCT sourceIp) AS distinct_sources
FROM alerts GROUP BY deviceId ORDER BY alert_count DESC, deviceId NULLS FIRST""",
    "severity_distribution": """
SELECT COALESCE(severity, 'UNKNOWN') AS severity, COUNT(*) AS alert_count
FROM alerts GROUP BY COALESCE(severity, 'UNKNOWN') ORDER BY alert_count DESC, 1""",
    "type_distribution": """
SELECT COALESCE("type", 'UNKNOWN') AS "type", COUNT(*) AS alert_count
FROM alerts GROUP BY COALESCE("type", 'UNKNOWN') ORDER BY alert_count DESC, 1""",
    "daily_trend": """
SELECT dt, COUNT(*) AS alert_count, COUNT(DISTINCT sourceIp) AS distinct_sources,
       COUNT(DISTINCT deviceId) AS active_devices
FROM alerts GROUP BY dt ORDER BY dt NULLS FIRST""",
    "top_destination_ports": """
SELECT destinationPort, COUNT(*) AS alert_count
FROM alerts WHERE destinationPort IS NOT NULL
GROUP BY destinationPort ORDER BY alert_count DESC, destinationPort LIMIT 50""",
    "total_alerts": "SELECT COUNT(*) AS total_alerts FROM alerts",
}

_ISO_US = "'%Y-%m-%dT%H:%M:%S.%fZ'"
_ISO_S = "'%Y-%m-%dT%H:%M:%SZ'"

_LAKE_PARSE = f"""
SELECT alertId, deviceId, "timestamp", "type", severity, protocol, sourceIp, destinationIp,
       sourcePort, destinationPort, packetCount, bytesCount, windowSeconds, description,
       acknowledged, createdAt, strftime(kafka_ts, {_ISO_US}) AS kafka_ts,
       strftime(event_ts, {_ISO_US}) AS event_ts, dt
FROM alerts"""

# Detector events: blank/null source dropped, text defaults applied.
_EV = """
ev AS (
  SELECT sourceIp, COALESCE(deviceId, '') AS deviceId, COALESCE("type", '') AS "type",
         COALESCE(severity, 'LOW') AS severity, "timestamp", event_ts, alertId,
         epoch_ms(kafka_ts) AS arr_ms, CAST(alertId AS BIGINT) % 3 AS arr_part,
         CAST(alertId AS BIGINT) AS arr_off
  FROM alerts WHERE sourceIp IS NOT NULL AND sourceIp <> ''
)"""

_DETECTOR_PARSE = 'SELECT sourceIp, deviceId, "type", severity, "timestamp" FROM ev'

_WIN_US = 86_400 * 1_000_000


def _anomaly_ctes(extra_having: str = "", win_us: int = _WIN_US, one_window: bool = False) -> str:
    start = "TIMESTAMP '2000-01-01'" if one_window else f"make_timestamp((epoch_us(event_ts) // {win_us}) * {win_us})"
    return f"""
b AS (
  SELECT *, {start} AS ws FROM ev
  WHERE {'true' if one_window else 'event_ts IS NOT NULL'}
),
agg AS (
  SELECT ws, sourceIp, COUNT(*) AS alertCount,
         CASE WHEN bool_or(upper(severity) IN ('CRITICAL', 'HIGH')) THEN 'CRITICAL'
              WHEN bool_or(upper(severity) = 'MEDIUM') THEN 'HIGH' ELSE 'MEDIUM' END AS severity
  FROM b GROUP BY ws, sourceIp
  HAVING COUNT(*) >= 3 {extra_having}
),
dev AS (
  SELECT ws, sourceIp, deviceId, MIN((arr_ms, arr_part, arr_off)) AS f FROM b WHERE deviceId <> ''
  GROUP BY ws, sourceIp, deviceId
),
devl AS (
  SELECT ws, sourceIp, list(deviceId ORDER BY f, deviceId) AS deviceIds FROM dev
  GROUP BY ws, sourceIp
),
typ AS (
  SELECT ws, sourceIp, "type", MIN((arr_ms, arr_part, arr_off)) AS f FROM b WHERE "type" <> ''
  GROUP BY ws, sourceIp, "type"
),
typl AS (
  SELECT ws, sourceIp, list("type" ORDER BY f, "type") AS alertTypes FROM typ
  GROUP BY ws, sourceIp
),
anom AS (
  SELECT 'ESCALATED_SOURCE' AS "type", a.sourceIp,
         COALESCE(d.deviceIds[1], '') AS deviceId,
         COALESCE(d.deviceIds, []::VARCHAR[]) AS deviceIds,
         CAST(a.alertCount AS INTEGER) AS alertCount, a.severity,
         strftime(a.ws, {_ISO_S}) AS windowStart,
         strftime(a.ws + to_microseconds({win_us}), {_ISO_S}) AS windowEnd,
         COALESCE(t.alertTypes, []::VARCHAR[]) AS alertTypes
  FROM agg a
  LEFT JOIN devl d ON d.ws = a.ws AND d.sourceIp = a.sourceIp
  LEFT JOIN typl t ON t.ws = a.ws AND t.sourceIp = a.sourceIp
)"""


_ANOM_FLAT = """
SELECT "type", sourceIp, deviceId, array_to_string(deviceIds, ',') AS deviceIdList,
       alertCount, severity, windowStart, windowEnd,
       array_to_string(alertTypes, ',') AS alertTypeList
FROM anom"""

_ANOM_PROCESSING = """
SELECT "type", sourceIp, deviceId, array_to_string(deviceIds, ',') AS deviceIdList,
       alertCount, severity, array_to_string(alertTypes, ',') AS alertTypeList
FROM anom"""

_ANOM_JSON = """
SELECT CAST(json_object('type', "type", 'sourceIp', sourceIp, 'deviceId', deviceId,
                        'deviceIds', deviceIds, 'alertCount', alertCount,
                        'severity', severity, 'windowStart', windowStart,
                        'windowEnd', windowEnd, 'alertTypes', alertTypes) AS VARCHAR) AS value
FROM anom"""

# Append-mode stream: only windows whose end is at or before the final
# watermark (max event time - 1 minute) have been emitted.
_STREAM_HAVING = (
    "AND ws + INTERVAL 1 DAY <= (SELECT MAX(event_ts) FROM ev) - INTERVAL 1 MINUTE"
)

# Page p holds hours p and p + 1. A page's mark is the latest instant of the pages
# before it, so of hour p only what is past or at it and unseen is new.
_NEW_OVER_PAGES = f"""
SELECT alertId, strftime(event_ts, {_ISO_US}) AS cursor_ts FROM alerts"""

_LATEST = """
SELECT alertId, deviceId, "timestamp", sourceIp, severity
FROM alerts ORDER BY event_ts DESC NULLS LAST, alertId LIMIT 200"""

_PAGE_UNNEST = """
SELECT alertId, deviceId, "timestamp", "type", severity, protocol, sourceIp, destinationIp,
       sourcePort, destinationPort, packetCount, bytesCount, windowSeconds, description,
       acknowledged, createdAt
FROM alerts"""

_PUBLISH_KEY = """
SELECT alertId, CASE WHEN deviceId IS NOT NULL AND trim(deviceId) <> '' THEN deviceId
                     ELSE 'unknown' END AS publish_key
FROM alerts"""

# Incremental load: the first poll covered alerts before (day of newest
# alert - 7 days); its mark is (latest instant, ids at it).
_MARK = """
cut AS (SELECT date_trunc('day', MAX(event_ts)) - INTERVAL 7 DAY AS cutoff FROM alerts),
m AS (SELECT MAX(event_ts) AS mts FROM alerts, cut WHERE event_ts < cutoff),
mids AS (SELECT alertId FROM alerts, m WHERE event_ts = m.mts),
newrows AS (
  SELECT alertId, event_ts FROM alerts, m
  WHERE event_ts IS NULL OR m.mts IS NULL OR event_ts > m.mts
     OR (event_ts = m.mts AND alertId IS NOT NULL AND alertId NOT IN (SELECT alertId FROM mids))
)"""

_NEW_SINCE = f"SELECT alertId, strftime(event_ts, {_ISO_US}) AS cursor_ts FROM newrows"

_NEXT_MARK = f"""
SELECT strftime(event_ts, {_ISO_US}) AS mark_ts, alertId AS mark_id
FROM (SELECT alertId, event_ts FROM newrows UNION ALL
      SELECT alertId, event_ts FROM alerts, m WHERE event_ts = m.mts)
WHERE event_ts = (SELECT MAX(event_ts) FROM (SELECT event_ts FROM newrows UNION ALL
                                            SELECT mts FROM m))
GROUP BY 1, 2"""


_REPORT_KEYS = {
    "top_source_ips": "sourceIp",
    "alerts_per_device": "deviceId",
    "severity_distribution": "severity",
    "type_distribution": '"type"',
    "daily_trend": "dt",
    "top_destination_ports": "destinationPort",
}

_WRITTEN_REPORTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS report, CAST({key} AS VARCHAR) AS key, alert_count "
    f"FROM ({_REPORT_SQL[name]})"
    for name, key in _REPORT_KEYS.items()
)

_NEW_SINCE_STORED = f"""
SELECT alertId, strftime(event_ts, {_ISO_US}) AS cursor_ts
FROM alerts, m WHERE event_ts IS NULL OR m.mts IS NULL OR event_ts >= m.mts"""


# The dirty mapping, as the lake and as the detector read it (event_id % 16).
_DIRTY_LAKE = _ALERTS.replace("alerts AS (", "clean AS (", 1) + """,
alerts AS (
  SELECT * REPLACE (
    CASE k WHEN 2 THEN '  ' || sourceIp || ' ' || chr(9) WHEN 3 THEN '   ' ELSE sourceIp END AS sourceIp,
    CASE k WHEN 4 THEN ' ' || lower(severity) || ' ' WHEN 5 THEN NULL ELSE severity END AS severity,
    CASE k WHEN 6 THEN '42' WHEN 7 THEN '{"a":1}' WHEN 8 THEN NULL ELSE deviceId END AS deviceId,
    CASE k WHEN 9 THEN 'not a time' WHEN 10 THEN NULL ELSE "timestamp" END AS "timestamp",
    CASE WHEN k NOT IN (9, 10) THEN event_ts END AS event_ts,
    CASE WHEN k NOT IN (9, 10) THEN dt END AS dt)
  FROM (SELECT *, CAST(alertId AS BIGINT) % 16 AS k FROM clean) WHERE k NOT IN (0, 1, 11)
)"""
_DIRTY_EV = _ALERTS.replace("alerts AS (", "clean AS (", 1) + """,
ev AS (
  SELECT sourceIp, CASE k WHEN 6 THEN '42' WHEN 7 THEN '' WHEN 8 THEN '' ELSE coalesce(deviceId, '') END AS deviceId,
         coalesce("type", '') AS "type",
         CASE k WHEN 5 THEN 'LOW' WHEN 4 THEN coalesce(lower(severity), 'LOW') ELSE coalesce(severity, 'LOW') END AS severity,
         CASE k WHEN 9 THEN 'not a time' WHEN 10 THEN '' ELSE coalesce("timestamp", '') END AS "timestamp",
         CASE WHEN k NOT IN (9, 10) THEN event_ts END AS event_ts, alertId,
         epoch_ms(kafka_ts) AS arr_ms, CAST(alertId AS BIGINT) % 3 AS arr_part, CAST(alertId AS BIGINT) AS arr_off
  FROM (SELECT *, CAST(alertId AS BIGINT) % 16 AS k FROM clean)
  WHERE k NOT IN (0, 1, 3) AND sourceIp IS NOT NULL AND sourceIp <> ''
)"""

# The unreliable sender: one alert in ten never gets through, one at the third try.
_DELIVERED = """
SELECT alertId, CAST(alertId AS BIGINT) % 10 <> 3 AS delivered,
       CAST(CASE CAST(alertId AS BIGINT) % 10 WHEN 3 THEN 4 WHEN 5 THEN 3 ELSE 1 END AS INTEGER) AS attempts,
       CASE WHEN CAST(alertId AS BIGINT) % 10 = 3 THEN 'refused' END AS error
FROM alerts"""

_PARTIAL_MARK = f"""
SELECT strftime(event_ts, {_ISO_US}) AS mark_ts, alertId AS mark_id
FROM (SELECT alertId, event_ts FROM newrows WHERE CAST(alertId AS BIGINT) % 10 <> 3 UNION ALL
      SELECT alertId, event_ts FROM alerts, m WHERE event_ts = m.mts) x
WHERE event_ts = (SELECT MAX(event_ts) FROM (
        SELECT event_ts FROM newrows WHERE CAST(alertId AS BIGINT) % 10 <> 3 UNION ALL SELECT mts FROM m))
GROUP BY 1, 2"""

# Alerts without a time (id % 16 = 10) are new at either poll; the others by the mark.
_REPLAYED_POLLS = """
SELECT 0 AS poll, alertId, deviceId AS publish_key FROM alerts, cut WHERE event_ts < cutoff
UNION ALL
SELECT 1, alertId, deviceId FROM alerts, timed
WHERE CAST(alertId AS BIGINT) % 16 = 10 OR mts IS NULL OR event_ts > mts"""
_TIMED = """
cut AS (SELECT date_trunc('day', MAX(event_ts)) - INTERVAL 7 DAY AS cutoff FROM alerts),
timed AS (SELECT MAX(event_ts) AS mts FROM alerts, cut
          WHERE event_ts < cutoff AND CAST(alertId AS BIGINT) % 16 <> 10)"""

_PARSE_OUTCOMES = """
SELECT parse, outcome, CAST(n AS BIGINT) AS n FROM (
  SELECT 'lake' AS parse, 'messages' AS outcome, count(*) AS n FROM kinds
  UNION ALL SELECT 'lake', 'dropped', count(*) FROM kinds WHERE k IN (0, 1, 11)
  UNION ALL SELECT 'detector', 'messages', count(*) FROM kinds
  UNION ALL SELECT 'detector', 'not_objects', count(*) FROM kinds WHERE k IN (0, 1)
  UNION ALL SELECT 'detector', 'without_source', count(*) FROM kinds
            WHERE k NOT IN (0, 1) AND (k = 3 OR coalesce(sourceIp, '') = '')
)"""
_KINDS = "kinds AS (SELECT sourceIp, CAST(alertId AS BIGINT) % 16 AS k FROM alerts)"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    out = {name: _with(_ALERTS, sql) for name, sql in _REPORT_SQL.items()}
    for name in _REPORT_SQL:
        if name != "total_alerts":
            out[f"sql_{name}"] = out[name]
    out["lake_parse"] = _with(_ALERTS, _LAKE_PARSE)
    out["lake_roundtrip"] = _with(_ALERTS, _LAKE_PARSE)
    out["lake_daily_trend"] = out["daily_trend"]
    out["detector_parse"] = _with(_ALERTS + "," + _EV, _DETECTOR_PARSE)
    out["source_anomalies"] = _with(_ALERTS + "," + _EV + "," + _anomaly_ctes(), _ANOM_FLAT)
    out["anomaly_json"] = _with(_ALERTS + "," + _EV + "," + _anomaly_ctes(), _ANOM_JSON)
    out["source_anomalies_6h"] = _with(
        _ALERTS + "," + _EV + "," + _anomaly_ctes(win_us=6 * 3600 * 1_000_000), _ANOM_FLAT
    )
    out["source_anomalies_stream"] = _with(
        _ALERTS + "," + _EV + "," + _anomaly_ctes(_STREAM_HAVING), _ANOM_FLAT
    )
    out["source_anomalies_processing"] = _with(
        _ALERTS + "," + _EV + "," + _anomaly_ctes(one_window=True), _ANOM_PROCESSING
    )
    out["source_anomalies_timed"] = out["source_anomalies_processing"]
    lake_rows = _ALERTS.replace("date_trunc('millisecond', ts) AS kafka_ts", "ts AS kafka_ts")
    out["compacted_lake_parse"] = _with(lake_rows, _LAKE_PARSE)
    out["new_since_damaged_mark"] = _with(_ALERTS + "," + _MARK, _NEW_SINCE)
    out["latest_alerts"] = _with(_ALERTS, _LATEST)
    out["new_since_mark_pages"] = _with(_ALERTS, _NEW_OVER_PAGES)
    out["page_unnest"] = _with(_ALERTS, _PAGE_UNNEST)
    out["publish_key"] = _with(_ALERTS, _PUBLISH_KEY)
    out["new_since_mark"] = _with(_ALERTS + "," + _MARK, _NEW_SINCE)
    out["next_mark"] = _with(_ALERTS + "," + _MARK, _NEXT_MARK)
    out["written_reports"] = _with(_ALERTS, _WRITTEN_REPORTS)
    out["new_since_stored_mark"] = _with(_ALERTS + "," + _MARK, _NEW_SINCE_STORED)
    out["dirty_lake_parse"] = _with(_DIRTY_LAKE, _LAKE_PARSE)
    out["dirty_top_source_ips"] = _with(_DIRTY_LAKE, _REPORT_SQL["top_source_ips"])
    out["dirty_severity_distribution"] = _with(_DIRTY_LAKE, _REPORT_SQL["severity_distribution"])
    out["dirty_detector_parse"] = _with(_DIRTY_EV, _DETECTOR_PARSE)
    out["dirty_source_anomalies"] = _with(_DIRTY_EV + "," + _anomaly_ctes(), _ANOM_FLAT)
    for name in ("top_source_ips", "alerts_per_device", "daily_trend"):
        out[f"rolled_{name}"] = out[name]
    for name in ("top_source_ips", "alerts_per_device"):
        out[f"streamed_{name}"] = out[name]
    out["parse_outcomes"] = _with(_ALERTS + "," + _KINDS, _PARSE_OUTCOMES)
    out["versioned_reports"] = out["written_reports"]
    later = _ALERTS.replace("alerts AS (", "every AS (", 1) + """,
alerts AS (SELECT * FROM every WHERE dt > (SELECT min(dt) FROM every))"""
    out["damaged_lake_trend"] = _with(later, _REPORT_SQL["daily_trend"])
    out["delivered_alerts"] = _with(_ALERTS, _DELIVERED)
    out["partial_next_mark"] = _with(_ALERTS + "," + _MARK, _PARTIAL_MARK)
    out["replayed_polls"] = _with(_ALERTS + "," + _TIMED, _REPLAYED_POLLS)
    out["replayed_anomalies"] = out["source_anomalies_stream"]
    if llm_queries is not None:
        out |= llm_queries.ORACLE_SQL
    return out
