"""Adapters from the driver's ``events`` table to alert-shaped inputs.

The reference's inputs (a topic of alert JSON, a Parquet lake, a paged
HTTP body) are not available here, so every query reads ``events`` and
maps each row to one alert. The mapping is a pure projection: Catalyst
prunes it down to the event columns a query actually uses, and the
mapped predicates (``sourceIp IS NOT NULL`` …) still reach the scan.
The same mapping is written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.functions.time import ISO_MICROS_FORMAT
from alertscope.schema import ALERT_FIELDS, ALERT_SCHEMA, LAKE_COLUMNS

# The events → alert mapping.
SEVERITY_BY_EVENT = {"error": "CRITICAL", "purchase": "HIGH", "click": "MEDIUM", "signup": "LOW"}
DEVICES = 7  # deviceId = 'dev-' || event_id % 7
DEST_HOSTS = 64  # destinationIp = '192.168.1.' || event_id % 64
NULL_SOURCE_USER_MOD = 50  # sourceIp null when user_id % 50 = 49
NULL_PORT_K_MOD = 25  # destinationPort null when k % 25 = 0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def alerts_from_events(events: DataFrame) -> DataFrame:
    """One lake-shaped alert (19 columns, lake order) per event row."""
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    sev = None
    for ev, level in SEVERITY_BY_EVENT.items():
        sev = (F.when if sev is None else sev.when)(F.col("event_type") == ev, F.lit(level))
    ts_text = F.date_format(ts, ISO_MICROS_FORMAT)
    cols = {
        "alertId": F.col("event_id").cast("string"),
        "deviceId": F.concat(F.lit("dev-"), (F.col("event_id") % DEVICES).cast("string")),
        "timestamp": ts_text,
        "type": F.when(F.col("event_type") != "view", F.upper("event_type")),
        "severity": sev,
        "protocol": F.lit("TCP"),
        "sourceIp": F.when(
            F.col("user_id") % NULL_SOURCE_USER_MOD != NULL_SOURCE_USER_MOD - 1,
            F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")),
        ),
        "destinationIp": F.concat(
            F.lit("192.168.1."), (F.col("event_id") % DEST_HOSTS).cast("string")
        ),
        "sourcePort": (F.lit(40000) + F.col("event_id") % 20000).cast("int"),
        "destinationPort": F.when(k % NULL_PORT_K_MOD != 0, k),
        "packetCount": (F.col("event_id") % 1000 + 1).cast("bigint"),
        "bytesCount": ((F.col("event_id") % 1000 + 1) * 512).cast("bigint"),
        "windowSeconds": F.lit(60).cast("int"),
        "description": F.col("event_type"),
        "acknowledged": F.col("event_id") % 2 == 0,
        "createdAt": ts_text,
        "kafka_ts": ts,
        "event_ts": ts,
        "dt": F.to_date(ts),
    }
    return events.select(*[cols[c].alias(c) for c in LAKE_COLUMNS])


def load_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_from_events(read_table(spark, sf_dir, "events"))


def alert_json() -> F.Column:
    """JSON text of the 16 message fields of an alert row (nulls omitted)."""
    return F.to_json(F.struct(*[F.col(c) for c in ALERT_FIELDS]))


def messages_from_alerts(
    alerts: DataFrame, topic: str = "ids.alerts", value: F.Column | None = None
) -> DataFrame:
    """Kafka-row-shaped frame: key = device, value = alert JSON, broker time.

    Broker time has millisecond precision, as a broker records it.

    ``partition``/``offset`` are derived from the alert id so that arrival
    order is defined and stable (``kafka_ts``, partition, offset).
    """
    aid = F.col("alertId").cast("long")
    return alerts.select(
        F.col("deviceId").cast("binary").alias("key"),
        (alert_json() if value is None else value).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.coalesce(aid, F.lit(0)) % 3).cast("int").alias("partition"),
        F.coalesce(aid, F.lit(0)).alias("offset"),
        F.date_trunc("millisecond", F.col("kafka_ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


# What is wrong with the alert of event_id % DIRT_KINDS.
DIRT_KINDS = 16
(CUT_OFF, ARRAY_ROOT, PADDED_SOURCE, BLANK_SOURCE, PADDED_SEVERITY, NO_SEVERITY, NUMBER_DEVICE,
 OBJECT_DEVICE, NO_DEVICE, BAD_TIME, NO_TIME, NO_ID) = range(12)


def dirty_messages(alerts: DataFrame) -> DataFrame:
    """Topic rows of all alerts, three quarters of them with one thing wrong each:
    text cut off, an array root, a padded or blank source, severity padded in
    lower case or missing, a device that is a number, an object or missing, a bad
    or missing time, a missing id. Keys, order and broker time stay as they were.
    """
    kind = F.col("alertId").cast("long") % DIRT_KINDS
    is_ = lambda k: kind == k
    nothing = F.lit(None).cast("string")
    changed = {
        "sourceIp": F.when(is_(PADDED_SOURCE), F.concat(F.lit("  "), "sourceIp", F.lit(" \t")))
        .when(is_(BLANK_SOURCE), F.lit("   "))
        .otherwise(F.col("sourceIp")),
        "severity": F.when(is_(PADDED_SEVERITY), F.concat(F.lit(" "), F.lower("severity"), F.lit(" ")))
        .when(is_(NO_SEVERITY), nothing)
        .otherwise(F.col("severity")),
        "deviceId": F.when(is_(NO_DEVICE), nothing).otherwise(F.col("deviceId")),
        "timestamp": F.when(is_(BAD_TIME), F.lit("not a time"))
        .when(is_(NO_TIME), nothing)
        .otherwise(F.col("timestamp")),
        "alertId": F.when(is_(NO_ID), nothing).otherwise(F.col("alertId")),
    }
    text = F.to_json(F.struct(*[changed.get(c, F.col(c)).alias(c) for c in ALERT_FIELDS]))
    device = lambda value: F.regexp_replace(text, '"deviceId":"[^"]*"', f'"deviceId":{value}')
    text = (
        F.when(is_(CUT_OFF), F.substring(text, F.lit(1), F.length(text) - 1))
        .when(is_(ARRAY_ROOT), F.concat(F.lit("["), text, F.lit("]")))
        .when(is_(NUMBER_DEVICE), device("42"))
        .when(is_(OBJECT_DEVICE), device('{"a":1}'))
        .otherwise(text)
    )
    return messages_from_alerts(alerts.withColumn("_dirty", text), value=F.col("_dirty"))


def messages_from_events(events: DataFrame, topic: str = "ids.alerts") -> DataFrame:
    return messages_from_alerts(alerts_from_events(events), topic)


def pages_from_alerts(alerts: DataFrame, page_size: int = 200) -> DataFrame:
    """Paged API bodies ``{"data":{"content":[alert,…]}}`` of ``page_size`` alerts.

    Pages are cut by (numeric, unique) alert id range, so every page holds
    at most ``page_size`` alerts whatever the key distribution: the array
    built per page is bounded. Each page also carries one ``null`` element, which the
    unnest must skip like any non-object element.
    """
    seq = F.coalesce(
        F.col("alertId").cast("long"), F.raise_error(F.lit("pages are cut by numeric alertId"))
    )
    page = F.floor(seq / F.lit(page_size))
    item = F.struct(seq.alias("o"), alert_json().alias("j"))
    grouped = alerts.groupBy(page.alias("page_no")).agg(F.collect_list(item).alias("items"))
    content = F.array_join(
        F.transform(F.array_sort("items"), lambda s: s["j"]), ","
    )
    body = F.concat(F.lit('{"data":{"content":['), content, F.lit(',null]}}'))
    return grouped.select(F.col("page_no"), body.alias("body"))


# Re-export for callers that need the typed message schema.
__all__ = [
    "ALERT_SCHEMA",
    "alert_json",
    "alerts_from_events",
    "dirty_messages",
    "load_alerts",
    "messages_from_alerts",
    "messages_from_events",
    "pages_from_alerts",
    "read_table",
]
