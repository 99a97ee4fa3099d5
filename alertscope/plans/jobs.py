"""Job entry points configured from the environment (blank value = unset).

``python -m alertscope.plans.jobs ingest|lake|reports|detector`` runs one job
against a Kafka topic and a shared folder; the Kafka connector must be on
the classpath for the topic jobs.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope import session as S
from alertscope.operators.parse import parse_events
from alertscope.plans.ingest_job import start_poller
from alertscope.plans.lake_job import start_lake
from alertscope.plans.report_job import run_reports
from alertscope.sources import kafka
from alertscope.operators.detect import to_anomaly_json
from alertscope.streaming.event_time import detector_stream
from alertscope.streaming.ledger import Ledger
from alertscope.streaming.progress import ProgressTotals
from alertscope.streaming.processing_time import start_processing_time_detector


@dataclass(frozen=True)
class DetectorParams:
    """Detector settings; each falls back to its default and is clamped."""

    bootstrap: str = S.DEFAULT_BOOTSTRAP
    alerts_topic: str = S.DEFAULT_ALERTS_TOPIC
    anomalies_topic: str = S.DEFAULT_ANOMALIES_TOPIC
    window_seconds: int = S.DEFAULT_WINDOW_SECONDS
    threshold: int = S.DEFAULT_ALERT_THRESHOLD
    checkpoint_interval_ms: int = S.DEFAULT_CHECKPOINT_INTERVAL_MS
    checkpoint_dir: str = ""
    mode: str = "processing"  # or "event"
    watermark_delay: str = "1 minute"

    @classmethod
    def from_env(cls) -> "DetectorParams":
        return cls(
            bootstrap=S.param("KAFKA_BOOTSTRAP", S.DEFAULT_BOOTSTRAP),
            alerts_topic=S.param("ALERTS_TOPIC", S.DEFAULT_ALERTS_TOPIC),
            anomalies_topic=S.param("ANOMALIES_TOPIC", S.DEFAULT_ANOMALIES_TOPIC),
            window_seconds=S.int_param("WINDOW_SECONDS", S.DEFAULT_WINDOW_SECONDS, 1),
            threshold=S.int_param("ALERT_THRESHOLD", S.DEFAULT_ALERT_THRESHOLD, 1, bits=32),
            checkpoint_interval_ms=S.int_param(
                "CHECKPOINT_INTERVAL_MS", S.DEFAULT_CHECKPOINT_INTERVAL_MS, 1000
            ),
            checkpoint_dir=S.param("CHECKPOINT_DIR", ""),
            mode=S.param("DETECTOR_MODE", "processing"),
            watermark_delay=S.param("WATERMARK_DELAY", "1 minute"),
        )


def run_detector(
    spark: SparkSession,
    messages: DataFrame,
    p: DetectorParams,
    sink_format: str = "kafka",
    **sink_options: str,
):
    """Start the detector on topic-shaped ``messages``.

    Anomalies go to the anomalies topic as JSON values by default; another
    sink format (with its options, e.g. ``path``) receives the same values. In either
    mode a batch's values are kept in a ledger beside the checkpoint before they are
    sent and marked as sent after: a batch that is run again sends the same values,
    and none once it is marked.
    """
    checkpoint = p.checkpoint_dir or f"{S.checkpoint_root(spark)}/anomaly-detector"
    trigger = {"processingTime": f"{p.checkpoint_interval_ms} milliseconds"}
    options = sink_options or kafka.anomaly_sink_options(p.bootstrap, p.anomalies_topic)
    ledger_folder = f"{checkpoint.rstrip('/')}-ledger"

    def to_sink(anomalies: DataFrame, batch_id: int) -> None:
        ledger = Ledger(anomalies.sparkSession, ledger_folder)
        values = ledger.keep("anomalies", batch_id, lambda: to_anomaly_json(anomalies))
        writer = values.write.format(sink_format).mode("append").options(**options)
        ledger.once("sent", batch_id, writer.save)
        for kind in ("anomalies", "sent"):  # a stream replays its last batch only
            ledger.forget(kind, batch_id - 1)

    if p.mode == "event":
        anomalies = detector_stream(messages, p.window_seconds, p.threshold, p.watermark_delay)
        writer = anomalies.writeStream.foreachBatch(to_sink).outputMode("append")
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    events = parse_events(
        messages.withColumnRenamed("timestamp", "kafka_ts"),
        keep=("kafka_ts", "partition", "offset"),
    )
    return start_processing_time_detector(
        events, p.window_seconds, p.threshold, to_sink, checkpoint, trigger=trigger
    )


def start_ingest(spark: SparkSession, publish=None, trigger: dict | None = None):
    """Poll landed page bodies (one file per fetched page, ``PAGES_PATH``)
    against the mark store and publish new alerts to the alerts topic."""
    root = S.checkpoint_root(spark)
    landed = spark.readStream.option("maxFilesPerTrigger", str(S.int_param("PAGES_PER_TRIGGER", 1000, 1))).text(
        S.param("PAGES_PATH", f"{root}/pages"), wholetext=True
    )
    # pages are polled in the order in which they landed
    seq = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    pages = landed.select(F.col("value").alias("body"), seq.alias("page_seq"))
    if publish is None:
        servers = S.param("KAFKA_BOOTSTRAP", S.DEFAULT_BOOTSTRAP)
        topic = S.param("ALERTS_TOPIC", S.DEFAULT_ALERTS_TOPIC)

        def publish(new: DataFrame) -> None:
            kafka.publish(new, topic, servers=servers)

    interval = S.int_param("POLL_INTERVAL_MS", 5000, 1)
    return start_poller(
        pages,
        S.param("MARK_PATH", f"{root}/alert-mark"),
        publish,
        S.param("INGEST_CHECKPOINT", f"{root}/_checkpoints/ingest"),
        trigger=trigger or {"processingTime": f"{interval} milliseconds"},
    )


# State store for the long-running detector. Window state is
# keyed by (window, source, device, type); RocksDB keeps it off the JVM heap.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def main(argv: list[str]) -> int:
    job = argv[1] if len(argv) > 1 else ""
    spark = S.session(f"alertscope-{job or 'job'}")
    # the state's partitions are fixed when a checkpoint is made
    partitions = S.int_param("STATE_PARTITIONS", 0, 0)
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    key = "spark.sql.streaming.stateStore.providerClass"
    if job == "detector" and not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, S.param("STATE_STORE_PROVIDER", ROCKSDB_PROVIDER))
    if job in ("lake", "detector", "ingest"):
        spark.streams.addListener(ProgressTotals())
    if job == "lake":
        messages = kafka.read_topic_stream(
            spark,
            servers=S.param("KAFKA_BOOTSTRAP", S.DEFAULT_BOOTSTRAP),
            topic=S.param("ALERTS_TOPIC", S.DEFAULT_ALERTS_TOPIC),
            min_partitions=S.int_param("KAFKA_MIN_PARTITIONS", 0, 0) or None,
            max_offsets_per_trigger=S.int_param("KAFKA_MAX_OFFSETS_PER_TRIGGER", S.DEFAULT_MAX_OFFSETS, 1),
            group_id=S.param("KAFKA_GROUP_ID", S.DEFAULT_GROUP_ID) if job == "detector" else None,
        )
        root = S.checkpoint_root(spark)
        q = start_lake(
            S.spread(messages),
            S.param("LAKE_PATH", f"{root}/alerts"),
            S.param("LAKE_CHECKPOINT", f"{root}/_checkpoints/alerts"),
            dedupe_within=S.param("LAKE_DEDUPE_WITHIN", "") or None,
        )
        q.awaitTermination()
    elif job == "reports":
        root = S.checkpoint_root(spark)
        status = run_reports(
            spark,
            S.param("LAKE_PATH", f"{root}/alerts"),
            S.param("REPORTS_PATH", f"{root}/reports"),
            since=S.param("REPORTS_SINCE", "") or None,
            until=S.param("REPORTS_UNTIL", "") or None,
            dedupe=S.param("REPORTS_DEDUPE", "false").strip().lower() == "true",
        )
        for name, state in status.items():
            print(f"[alertscope] report {name}: {state}")
    elif job == "ingest":
        start_ingest(spark).awaitTermination()
    elif job == "detector":
        p = DetectorParams.from_env()
        messages = kafka.read_topic_stream(
            spark,
            servers=p.bootstrap,
            topic=p.alerts_topic,
            min_partitions=S.int_param("KAFKA_MIN_PARTITIONS", 0, 0) or None,
            max_offsets_per_trigger=S.int_param("KAFKA_MAX_OFFSETS_PER_TRIGGER", S.DEFAULT_MAX_OFFSETS, 1),
            group_id=S.param("KAFKA_GROUP_ID", S.DEFAULT_GROUP_ID) if job == "detector" else None,
        )
        run_detector(spark, S.spread(messages), p).awaitTermination()
    else:
        print("usage: python -m alertscope.plans.jobs ingest|lake|reports|detector")
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
