"""Timestamp parsing and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertscope.functions.text import _col

# An ISO-8601 instant with seconds and an explicit zone
# ('Z' or +HH:MM[:SS]; letters in either case), the only shape the
# incremental loader accepts.
STRICT_INSTANT_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?([Zz]|[+-]\d{2}:\d{2}(:\d{2})?)\z"
)

END_OF_DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}[Tt]24:00:00(\.0+)?[^.\d]"

# Instant text for whole-second instants, UTC.
ISO_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def lenient_timestamp(c: Column | str) -> Column:
    """Any text Spark can read as a timestamp; unreadable text → null.

    The lake uses this form so one malformed row cannot fail the stream.
    """
    return F.try_to_timestamp(_col(c))


def strict_instant(c: Column | str) -> Column:
    """Full date-time with zone only; date-only, zone-less or bad text → null."""
    col = _col(c)
    midnight = col.rlike(END_OF_DAY_PATTERN)  # 24:00 is the next day's start
    plain = F.when(midnight, F.regexp_replace(col, "[Tt]24:", "T00:")).otherwise(col)
    at = F.try_to_timestamp(F.upper(plain))
    at = F.when(midnight, at + F.expr("INTERVAL 1 DAY")).otherwise(at)
    return F.when(col.rlike(STRICT_INSTANT_PATTERN), at)


def iso_instant(c: Column | str, micros: bool = False) -> Column:
    """Render a timestamp as UTC ISO-8601 text (session zone must be UTC)."""
    return F.date_format(_col(c), ISO_MICROS_FORMAT if micros else ISO_SECONDS_FORMAT)
