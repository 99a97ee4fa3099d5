"""Message parsing: the typed lake parse and the detector's loose parse.

Both are narrow (map-only) transformations: no shuffle, whole-stage
codegen around the JSON expressions, so they scale with the input
partitions of the topic or file source. Each message is parsed once:
the parse result is projected as its own column before fields are read
from it, so Catalyst does not inline the parser into every field.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertscope.functions.text import WHITESPACE_CHARS, node_text, unicode_trim
from alertscope.functions.time import lenient_timestamp
from alertscope.schema import ALERT_FIELDS, ALERT_SCHEMA, LAKE_COLUMNS


def decode_messages(messages: DataFrame) -> DataFrame:
    """Kafka row → ``(json string, kafka_ts)``."""
    return messages.select(
        F.col("value").cast("string").alias("json"), F.col("timestamp").alias("kafka_ts")
    )


def parse_alerts(messages: DataFrame, observe: Observation | str | None = None) -> DataFrame:
    """Topic rows → typed lake rows (19 columns, lake order).

    ``from_json`` is permissive: malformed text, a non-object root or a
    missing ``alertId`` give a null id and the row is dropped; a field of
    the wrong type becomes null and the row is kept. Event time uses
    ``try_to_timestamp``, so bad text lands in the null ``dt`` partition
    instead of failing the stream. ``observe`` (an observation of a batch, or the name
    of one of a stream) counts ``messages`` and those ``dropped`` in passing.
    """
    typed = decode_messages(messages).select(
        F.from_json("json", ALERT_SCHEMA).alias("a"), "kafka_ts"
    )
    if observe is not None:
        dropped = F.count_if(F.col("a.alertId").isNull())
        typed = typed.observe(observe, F.count(F.lit(1)).alias("messages"), dropped.alias("dropped"))
    record = F.struct(*[F.col("a")[f].alias(f) for f in ALERT_FIELDS], F.col("kafka_ts"))
    parsed = emit_if(typed, F.col("a.alertId").isNotNull(), record)
    with_time = parsed.withColumn("event_ts", lenient_timestamp("timestamp"))
    return with_time.withColumn("dt", F.to_date("event_ts")).select(*LAKE_COLUMNS)


# The fields the detector reads, with the text used when a
# field is missing or null.
EVENT_DEFAULTS = {"sourceIp": "", "deviceId": "", "type": "", "severity": "LOW", "timestamp": ""}
# Text that is no JSON is told by the column that holds it then.
_BROKEN = "_broken"
_EVENT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (*EVENT_DEFAULTS, _BROKEN)])

# A field read as text that may have been a container, or a number that a tree-model
# reader prints in another way than it was written: only there the node's kind counts.
_UNCLEAR = r"^([\[{]|-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$)"


def parse_events(
    messages: DataFrame, keep: tuple[str, ...] = (), observe: Observation | str | None = None
) -> DataFrame:
    """Topic rows → detector events ``(sourceIp, deviceId, type, severity, timestamp)``.

    Drops null/blank values, malformed JSON and non-object roots; reads each
    field as text (numbers and booleans as their literal text, containers as
    empty text, missing or null as the default), trims Unicode whitespace,
    and drops rows whose ``sourceIp`` is then empty. ``severity`` falls back
    to ``LOW`` when blank. Input columns named in ``keep`` (e.g. broker
    time, partition and offset, which define arrival order) are carried.

    One struct parse reads the five fields as they are written; of a key given
    twice the last value counts. Few texts leave open what kind of node they were,
    and for those messages only a variant parse tells. ``observe`` counts ``messages``,
    those that are ``not_objects`` and objects ``without_source`` in passing.
    """
    text = F.col("_text")
    parsed = messages.select(F.col("value").cast("string").alias("_text"), *keep).select(
        "*", F.from_json(text, _EVENT_SCHEMA, {"columnNameOfCorruptRecord": _BROKEN}).alias("_s")
    )
    unclear = {n: F.coalesce(F.col("_s")[n].rlike(_UNCLEAR), F.lit(False)) for n in EVENT_DEFAULTS}
    flagged = parsed.select("*", *[c.alias(f"_u_{n}") for n, c in unclear.items()])
    some = functools.reduce(lambda x, y: x | y, [F.col(f"_u_{n}") for n in EVENT_DEFAULTS])
    staged = flagged.select("*", F.when(some, F.try_parse_json(text)).alias("_v"))
    nodes = staged.select(
        "*",
        *[
            F.when(F.col(f"_u_{n}"), F.try_variant_get("_v", f"$.{n}", "variant")).alias(f"_n_{n}")
            for n in EVENT_DEFAULTS
        ],
    )
    is_object = F.ltrim(text, F.lit(WHITESPACE_CHARS)).startswith("{") & F.col("_s").isNotNull() & F.col("_s")[_BROKEN].isNull()

    def field(name: str) -> F.Column:
        default = EVENT_DEFAULTS[name]
        kind = F.col(f"_u_{name}") & F.col("_v").isNotNull()
        told = node_text(F.col(f"_n_{name}"), default, F.get_json_object(text, f"$.{name}"))
        return unicode_trim(F.when(kind, told).otherwise(F.coalesce(F.col("_s")[name], F.lit(default))))

    texts = nodes.select(
        *[field(n).alias(n) for n in EVENT_DEFAULTS],
        *[F.col(k) for k in keep],
        F.coalesce(is_object, F.lit(False)).alias("_ok"),
    )
    sourced = F.col("sourceIp") != F.lit("")
    if observe is not None:
        texts = texts.observe(
            observe,
            F.count(F.lit(1)).alias("messages"),
            F.count_if(~F.col("_ok")).alias("not_objects"),
            F.count_if(F.col("_ok") & ~sourced).alias("without_source"),
        )
    sev = F.col("severity")
    event = F.struct(
        "sourceIp",
        "deviceId",
        "type",
        F.when(sev == "", F.lit("LOW")).otherwise(sev).alias("severity"),
        "timestamp",
        *[F.col(k) for k in keep],
    )
    return emit_if(texts, F.col("_ok") & sourced, event)


def emit_if(df: DataFrame, condition: F.Column, record: F.Column) -> DataFrame:
    """Zero or one output row per input row: ``record`` fields where ``condition``.

    A flat-map through ``explode`` of a 0/1-element array. Unlike a
    ``Filter`` over derived columns, it is not pushed below the projection
    that computes its inputs, so the message is parsed once per row and
    Catalyst never inlines the parser into the predicate.
    """
    rows = F.when(F.coalesce(condition, F.lit(False)), F.array(record))
    return df.select(F.explode(rows).alias("_e")).select("_e.*")


def detector_events(messages: DataFrame, observe: Observation | str | None = None) -> DataFrame:
    """Topic rows → detector events carrying arrival order and event time.

    Adds ``kafka_ts``, ``partition``, ``offset`` (arrival order) and
    ``event_ts`` (the alert's own timestamp, leniently parsed; null when
    unreadable) to the five detector fields.
    """
    events = parse_events(
        messages.withColumnRenamed("timestamp", "kafka_ts"),
        keep=("kafka_ts", "partition", "offset"),
        observe=observe,
    )
    return events.withColumn("event_ts", lenient_timestamp("timestamp"))
