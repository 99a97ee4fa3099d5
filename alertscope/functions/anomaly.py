"""Anomaly record construction and its JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertscope.schema import ANOMALY_FIELDS

# The anomaly record's constant type.
ANOMALY_TYPE = "ESCALATED_SOURCE"


def anomaly_struct(
    source_ip: Column,
    device_ids: Column,
    alert_count: Column,
    severity: Column,
    window_start: Column,
    window_end: Column,
    alert_types: Column,
) -> Column:
    """The 9-field record in wire order; ``deviceId`` is the first device or ''."""
    fields = {
        "type": F.lit(ANOMALY_TYPE),
        "sourceIp": source_ip,
        "deviceId": F.coalesce(F.try_element_at(device_ids, F.lit(1)), F.lit("")),
        "deviceIds": device_ids,
        "alertCount": alert_count.cast("int"),
        "severity": severity,
        "windowStart": window_start,
        "windowEnd": window_end,
        "alertTypes": alert_types,
    }
    return F.struct(*[fields[name].alias(name) for name in ANOMALY_FIELDS])


# Escape forms of the anomaly wire format that differ from
# Spark's JSON writer — backspace and form feed as \u escapes, and the
# hex digits of \u escapes in lower case (only control characters reach
# \u escapes here: 0x0B, 0x0E, 0x0F and 0x1A-0x1F carry letters).
_WIRE_ESCAPES = [
    ("b", "u0008"),
    ("f", "u000c"),
    ("u000B", "u000b"),
    ("u000E", "u000e"),
    ("u000F", "u000f"),
    ("u001A", "u001a"),
    ("u001B", "u001b"),
    ("u001C", "u001c"),
    ("u001D", "u001d"),
    ("u001E", "u001e"),
    ("u001F", "u001f"),
]
# An escape starts at a backslash preceded by an even number of backslashes.
_ESCAPE_START = r"(?<!\\)((?:\\\\)*)\\"


def anomaly_json(record: Column | str = "anomaly") -> Column:
    """Compact JSON text of an anomaly struct, in the wire format's bytes.

    ``to_json`` keeps the field order and already writes quotes, backslash,
    newline, return and tab as short escapes and non-ASCII text as is; only
    the escapes listed above are rewritten, and only in text that holds a
    backslash at all (almost none does), so the rewrite costs next to nothing.
    """
    col = F.col(record) if isinstance(record, str) else record
    text = F.to_json(col)
    rewritten = text
    for spark_form, wire_form in _WIRE_ESCAPES:
        rewritten = F.regexp_replace(
            rewritten, _ESCAPE_START + spark_form, "$1\\\\" + wire_form
        )
    # Only text holding an escape can differ; the rest skips the rewrite.
    return F.when(text.contains("\\"), rewritten).otherwise(text)
