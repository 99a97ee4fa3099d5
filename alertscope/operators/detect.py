"""Windowed source-anomaly detection (event time), as a two-level aggregate.

Per (tumbling window, source): alert count, the first-seen-ordered lists
of distinct non-blank device ids and alert types, and the escalated
severity; only groups with ``count >= threshold`` are emitted.

Level 1 is one aggregate over two grouping sets, (window, source, device)
and (window, source, type): every measure is algebraic (count, min of the
arrival order, two severity flags), so Spark combines map-side before the
shuffle and a hot source is spread over its devices and types. Level 2
groups by (window, source): the count and flags come from the device-set
rows (each alert is in exactly one), and each list is collected from its
own set's already-distinct rows — so what level 2 holds per group is
exactly the device list plus the type list it emits, never the alerts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertscope.functions.anomaly import anomaly_json, anomaly_struct
from alertscope.functions.severity import ESCALATE_MID, ESCALATE_TOP, escalate_flags
from alertscope.functions.severity import normalised_severity
from alertscope.functions.time import iso_instant


# Digit widths of the packed arrival order — broker time in
# milliseconds, partition, offset — 14 + 5 + 19 = 38 digits.
_MS_DIGITS, _PARTITION_DIGITS, _OFFSET_DIGITS = 14, 5, 19


def arrival_order(ts: Column | str, partition: Column | str, offset: Column | str) -> Column:
    """(broker time, partition, offset) packed into one ``decimal(38,0)``.

    Ordering the decimal is ordering the triple, and ``min`` over a decimal
    keeps a fixed-width aggregation buffer, so the level-1 aggregate stays
    a hash aggregate (a struct ``min`` would fall back to a sort-based
    aggregate). Broker timestamps carry milliseconds. Every value has a place:
    a null or pre-1970 time, partition or offset comes first, one beyond the
    widths last, and the next part of the triple decides between such rows.
    """
    c = lambda x: F.col(x) if isinstance(x, str) else x

    def digits(value: Column, width: int, below: int) -> Column:
        # 0 is kept for what comes first; a long has 19 digits and needs no cap
        shifted = F.greatest(F.coalesce(value, F.lit(-1)), F.lit(-1)) + F.lit(1)
        if width < 19:
            shifted = F.least(shifted, F.lit(10**width - 1))
        place = F.lit(Decimal(10**below)).cast(f"decimal({below + 1},0)")
        return shifted.cast(f"decimal({width},0)") * place

    offset_ = F.least(c(offset).cast("long"), F.lit((1 << 63) - 2))
    order = (
        digits(F.unix_millis(c(ts)), _MS_DIGITS, _PARTITION_DIGITS + _OFFSET_DIGITS)
        + digits(c(partition).cast("long"), _PARTITION_DIGITS, _OFFSET_DIGITS)
        + digits(offset_, _OFFSET_DIGITS, 0)
    )
    return order.cast("decimal(38,0)")


def window_spec(time_col: Column | str, window_seconds: int) -> Column:
    """Epoch-aligned tumbling window ``[start, end)`` of ``window_seconds``."""
    col = F.col(time_col) if isinstance(time_col, str) else time_col
    return F.window(col, f"{int(window_seconds)} seconds")


def ordered_distinct(pairs: Column, value: str) -> Column:
    """Distinct values of an array of ``(first, value)`` structs, by first-seen order."""
    return F.array_distinct(F.transform(F.array_sort(pairs), lambda s: s[value]))


def anomaly_partials(events: DataFrame, window: Column, order: Column) -> DataFrame:
    """Level 1: per (window, source, device) and per (window, source, type).

    ``by_device`` marks rows of the first grouping set.
    """
    sev = normalised_severity("severity")
    staged = events.select(
        window.alias("window"),
        "sourceIp",
        "deviceId",
        "type",
        order.alias("_order"),
        F.coalesce(sev.isin(*ESCALATE_TOP), F.lit(False)).alias("_top"),
        F.coalesce(sev == F.lit(ESCALATE_MID), F.lit(False)).alias("_mid"),
    )
    w, src, dev, typ = (F.col(c) for c in ("window", "sourceIp", "deviceId", "type"))
    return staged.groupingSets([[w, src, dev], [w, src, typ]], w, src, dev, typ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_order").alias("first"),
        F.bool_or("_top").alias("top"),
        F.bool_or("_mid").alias("mid"),
        (F.grouping("type") == 1).alias("by_device"),
    )


def merge_partials(partials: DataFrame, threshold: int) -> DataFrame:
    """Level 2: merge level-1 rows per (window, source) and apply the threshold."""
    by_dev = F.col("by_device")
    device = F.when(by_dev & (F.col("deviceId") != ""), F.struct("first", "deviceId"))
    kind = F.when(~by_dev & (F.col("type") != ""), F.struct("first", "type"))
    merged = partials.groupBy("window", "sourceIp").agg(
        F.sum(F.when(by_dev, F.col("n"))).alias("alertCount"),
        ordered_distinct(F.collect_list(device), "deviceId").alias("deviceIds"),
        ordered_distinct(F.collect_list(kind), "type").alias("alertTypes"),
        escalate_flags(
            F.bool_or(by_dev & F.col("top")), F.bool_or(by_dev & F.col("mid"))
        ).alias("severity"),
    )
    return merged.filter(F.col("alertCount") >= F.lit(int(threshold)))


def detect_anomalies(
    events: DataFrame,
    window_seconds: int,
    threshold: int,
    time_col: str = "event_ts",
    order: Column | None = None,
) -> DataFrame:
    """Anomalies from detector events with an event-time column.

    ``events`` has ``sourceIp, deviceId, type, severity`` (as from
    ``parse_events``) and ``time_col``. ``order`` defines arrival order
    for the first-seen lists (default: the event time). Rows without an
    event time cannot be placed in a window and are dropped. Works on a
    static frame and, after ``withWatermark(time_col, …)``, on a stream in
    append mode.
    """
    order = F.col(time_col) if order is None else order
    placed = events.filter(F.col(time_col).isNotNull())
    partials = anomaly_partials(placed, window_spec(time_col, window_seconds), order)
    return anomaly_rows(merge_partials(partials, threshold))


def anomaly_rows(merged: DataFrame) -> DataFrame:
    """Flatten merged groups to the anomaly record fields (plus ``window``)."""
    record = anomaly_struct(
        F.col("sourceIp"),
        F.col("deviceIds"),
        F.col("alertCount"),
        F.col("severity"),
        iso_instant(F.col("window.start")),
        iso_instant(F.col("window.end")),
        F.col("alertTypes"),
    )
    return merged.select(F.col("window"), record.alias("anomaly")).select(
        "window", "anomaly.*"
    )


def to_anomaly_json(anomalies: DataFrame) -> DataFrame:
    """Anomaly rows → one ``value`` JSON string per anomaly (topic payload)."""
    from alertscope.schema import ANOMALY_FIELDS

    return anomalies.select(anomaly_json(F.struct(*ANOMALY_FIELDS)).alias("value"))
