"""Session settings, job parameters and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from alertscope.functions.text import WHITESPACE_CHARS

# Job defaults.
DEFAULT_WINDOW_SECONDS = 60
DEFAULT_ALERT_THRESHOLD = 3
DEFAULT_CHECKPOINT_INTERVAL_MS = 10_000
DEFAULT_PAGE_SIZE = 200
DEFAULT_ALERTS_TOPIC = "ids.alerts"
DEFAULT_ANOMALIES_TOPIC = "traffic-anomalies"
DEFAULT_BOOTSTRAP = "localhost:9092"
DEFAULT_GROUP_ID = "anomaly-detector"
DEFAULT_REGION = "eu-central-1"
#: Messages in one micro-batch of a topic job, so that a first run goes in steps.
DEFAULT_MAX_OFFSETS = 5_000_000


def param(key: str, default: str) -> str:
    """Environment value for ``key``; a missing or blank value means ``default``."""
    value = os.environ.get(key)
    if value is None or value.strip(WHITESPACE_CHARS) == "":
        return default
    return value


def int_param(key: str, default: int, minimum: int, bits: int = 64) -> int:
    """Integer parameter: text that is not a plain signed integer of ``bits``
    bits (spaces, decimals, overflow) falls back to ``default``; then clamp."""
    raw = param(key, str(default))
    value = int(raw) if re.fullmatch(r"[+-]?[0-9]+", raw) else default
    if not -(2 ** (bits - 1)) <= value < 2 ** (bits - 1):
        value = default
    return max(value, minimum)


def spread(messages: DataFrame) -> DataFrame:
    """``messages`` dealt over ``PARSE_PARTITIONS`` tasks before they are parsed, whatever
    their size; as they come if the parameter is unset. For input in fewer pieces than
    there are cores, such as one large file of one row group; a topic is better split by
    ``KAFKA_MIN_PARTITIONS``, which needs no shuffle."""
    n = int_param("PARSE_PARTITIONS", 0, 0)
    return messages.repartition(n) if n else messages


def session(app: str = "alertscope", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here assumes (UTC, AQE on, no UI)."""
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER", "").strip() or None
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        # remove reliable-checkpoint files once their DataFrame is gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    # object-store region for s3a:// lake and checkpoint paths
    settings["spark.hadoop.fs.s3a.endpoint.region"] = param("AWS_REGION", DEFAULT_REGION)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> None:
    """Alert semantics are UTC (partition date, ISO instants, zone-less text):
    pin the session time zone before plans are built, as the jobs do."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a folder every executor
    can reach). Only a local-mode session without one gets a fresh folder
    under the system temp dir, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="alertscope-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        handle, path = tempfile.mkstemp(prefix="alertscope-", suffix=".zip")
        os.close(handle)
        atexit.register(lambda: os.path.exists(path) and os.remove(path))  # served to executors until then
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, files in os.walk(package):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever Spark's file systems reach; a missing one is fine."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one run of ``name``."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
