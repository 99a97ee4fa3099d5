"""Topic adapters (Spark's Kafka source and sink).

The jobs take any DataFrame of the Kafka-row shape, so they run on file
streams and tables too; these helpers only build the reader/writer with
the reference's options. The Kafka connector jar must be on the classpath
to use them against a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.session import DEFAULT_ALERTS_TOPIC, DEFAULT_ANOMALIES_TOPIC, DEFAULT_BOOTSTRAP


def source_options(
    servers: str = DEFAULT_BOOTSTRAP,
    topic: str = DEFAULT_ALERTS_TOPIC,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    group_id: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options: subscribe one topic from the earliest offset.

    On restart the streaming checkpoint's offsets win; ``startingOffsets``
    applies to the first run only. ``min_partitions`` splits topic
    partitions into at least that many Spark tasks per micro-batch (no
    shuffle), so a topic with few partitions still parses on every core.
    ``max_offsets_per_trigger`` bounds each micro-batch, so a first run from
    ``earliest`` over a large backlog proceeds in sized steps instead of
    one batch holding the whole topic.
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra)
    return opts


def read_topic_stream(spark: SparkSession, **kwargs: str) -> DataFrame:
    reader = spark.readStream.format("kafka")
    for key, value in source_options(**kwargs).items():
        reader = reader.option(key, value)
    return reader.load()


def producer_options(servers: str = DEFAULT_BOOTSTRAP, **extra: str) -> dict[str, str]:
    """Writer options for keyed alert publishing: acks=all, 3 retries, 10 s to deliver."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.delivery.timeout.ms": "10000",
        "kafka.request.timeout.ms": "5000",
        "kafka.linger.ms": "0",
    }
    opts.update(extra)
    return opts


def publish_frame(
    raw: DataFrame, key_col: str = "publish_key", value_col: str = "json"
) -> DataFrame:
    """Rows → ``(key, value)`` strings for the topic writer."""
    return raw.select(
        F.col(key_col).cast("string").alias("key"), F.col(value_col).cast("string").alias("value")
    )


def publish(raw: DataFrame, topic: str = DEFAULT_ALERTS_TOPIC, **kwargs: str) -> None:
    """Batch-write keyed alert JSON to a topic (fails the batch on error)."""
    writer = publish_frame(raw).write.format("kafka").option("topic", topic)
    for key, value in producer_options(**kwargs).items():
        writer = writer.option(key, value)
    writer.save()


def anomaly_sink_options(
    servers: str = DEFAULT_BOOTSTRAP, topic: str = DEFAULT_ANOMALIES_TOPIC, **extra: str
) -> dict[str, str]:
    """Streaming sink options for anomaly JSON (value only, no key)."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    opts.update(extra)
    return opts
