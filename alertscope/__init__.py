"""alertscope: security-alert analytics as Spark DataFrame functions.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column``
expression) that runs unchanged on a static table and on a Structured
Streaming source. I/O lives at the edges (``sources``, ``plans``,
``streaming``); the relational work is left to Catalyst.
"""

from alertscope.schema import ALERT_SCHEMA, LAKE_COLUMNS

__all__ = ["ALERT_SCHEMA", "LAKE_COLUMNS"]
