"""Schemas shared by the lake, the detector and the topic adapters."""

from __future__ import annotations

from pyspark.sql import types as T

# The typed alert record, field order as stored in the lake.
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alertId", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("sourceIp", T.StringType()),
        T.StructField("destinationIp", T.StringType()),
        T.StructField("sourcePort", T.IntegerType()),
        T.StructField("destinationPort", T.IntegerType()),
        T.StructField("packetCount", T.LongType()),
        T.StructField("bytesCount", T.LongType()),
        T.StructField("windowSeconds", T.IntegerType()),
        T.StructField("description", T.StringType()),
        T.StructField("acknowledged", T.BooleanType()),
        T.StructField("createdAt", T.StringType()),
    ]
)

ALERT_FIELDS = [f.name for f in ALERT_SCHEMA.fields]

# The lake appends broker time, typed event time and the partition date.
LAKE_COLUMNS = ALERT_FIELDS + ["kafka_ts", "event_ts", "dt"]

LAKE_SCHEMA = T.StructType(
    list(ALERT_SCHEMA.fields)
    + [
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("dt", T.DateType()),
    ]
)

# Shape of a row from Spark's Kafka source; adapters accept any frame of it.
KAFKA_ROW_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# The detector's loose five-field projection of a message.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sourceIp", T.StringType(), False),
        T.StructField("deviceId", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("timestamp", T.StringType(), False),
    ]
)

# Anomaly record, wire (JSON) field order.
ANOMALY_FIELDS = [
    "type",
    "sourceIp",
    "deviceId",
    "deviceIds",
    "alertCount",
    "severity",
    "windowStart",
    "windowEnd",
    "alertTypes",
]

ANOMALY_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType(), False),
        T.StructField("sourceIp", T.StringType(), False),
        T.StructField("deviceId", T.StringType(), False),
        T.StructField("deviceIds", T.ArrayType(T.StringType(), False), False),
        T.StructField("alertCount", T.IntegerType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("windowStart", T.StringType(), False),
        T.StructField("windowEnd", T.StringType(), False),
        T.StructField("alertTypes", T.ArrayType(T.StringType(), False), False),
    ]
)

# Incremental-load mark in long form: one row per id seen at the mark
# instant, or a single row with a null id when that set is empty.
MARK_SCHEMA = T.StructType(
    [
        T.StructField("mark_ts", T.TimestampType()),
        T.StructField("mark_id", T.StringType()),
    ]
)
