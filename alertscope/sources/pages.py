"""Paged alert-API bodies and the newest-N fetch, as Spark sources.

The reference polls an HTTP endpoint; here a page body is a row (from
landed files or a stream) and unnesting is a narrow ``explode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertscope.operators.parse import emit_if
from alertscope.session import DEFAULT_PAGE_SIZE

# The envelope, with each content element as its text and as a typed value.
_TEXT_SCHEMA = "data struct<content: array<string>>"
_VALUE_SCHEMA = "data struct<content: array<variant>>"


def unnest_pages(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """Page bodies ``{"data":{"content":[…]}}`` → one row per object element.

    A body that is not JSON, has no ``data`` object or no ``content``
    array gives zero rows (not an error); elements that are not objects,
    text that looks like one included, are skipped. Each alert keeps its own
    text (``json``, in the source's key order, as it is published) beside the
    value read from it (``alert``, a variant: unknown fields pass through); of
    a key given twice in an alert the last value counts. Other columns of
    ``pages`` are carried.
    """
    # a setting of the JSON reader: a repeated key keeps its last value
    pages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    body = F.col(body_col)
    pairs = F.arrays_zip(
        F.from_json(body, _TEXT_SCHEMA)["data"]["content"].alias("json"),
        F.from_json(body, _VALUE_SCHEMA)["data"]["content"].alias("alert"),
    )
    carried = [c for c in pages.columns if c != body_col]
    items = pages.select(*carried, F.explode(pairs).alias("_p")).select(*carried, "_p.json", "_p.alert")
    is_object = F.schema_of_variant("alert").startswith("OBJECT")
    return emit_if(items, is_object, F.struct(*carried, "alert", "json"))


def latest(alerts: DataFrame, n: int = DEFAULT_PAGE_SIZE, ts_col: str = "event_ts",
           id_col: str = "alertId") -> DataFrame:
    """The newest ``n`` alerts by time (descending), id as the tie-break.

    Plans as ``TakeOrderedAndProject``: each task keeps its own top ``n``,
    so only ``n`` rows per task reach the final merge.
    """
    return alerts.orderBy(F.desc_nulls_last(ts_col), F.asc(id_col)).limit(n)
