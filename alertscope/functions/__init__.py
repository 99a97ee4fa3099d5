"""Column-level helpers (scalar and aggregate expressions)."""

from alertscope.functions.anomaly import ANOMALY_TYPE, anomaly_json, anomaly_struct
from alertscope.functions.severity import (
    escalate_flags,
    escalated_severity,
    normalised_severity,
    severity_rank,
)
from alertscope.functions.text import (
    default_if_blank,
    is_blank,
    non_blank,
    unicode_trim,
    variant_text,
)
from alertscope.functions.time import iso_instant, lenient_timestamp, strict_instant

__all__ = [
    "ANOMALY_TYPE",
    "anomaly_json",
    "anomaly_struct",
    "default_if_blank",
    "escalate_flags",
    "escalated_severity",
    "is_blank",
    "iso_instant",
    "lenient_timestamp",
    "non_blank",
    "normalised_severity",
    "severity_rank",
    "strict_instant",
    "unicode_trim",
    "variant_text",
]
