"""Topic → date-partitioned Parquet lake (streaming), and reading it back.

The parse is stateless and narrow, so the query needs no output-mode
choice, no watermark and no shuffle: each micro-batch task writes its own
files into the ``dt=`` folders of the dates it holds. The job does not
``repartition("dt")``: in a live stream almost every row of a batch has the
same date, so that would funnel the batch into one task. File size is
bounded by ``maxRecordsPerFile`` instead, and compaction is a separate
batch job if wanted.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertscope.operators.parse import parse_alerts
from alertscope.schema import LAKE_SCHEMA


#: Name of the parse's observation in the progress of the lake stream.
PARSE = "lake_parse"


def start_lake(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_records_per_file: int = 5_000_000,
    dedupe_within: str | None = None,
) -> StreamingQuery:
    """Append parsed alerts to ``path`` partitioned by ``dt``; resume from ``checkpoint``.

    Rows whose event time cannot be read land in
    ``dt=__HIVE_DEFAULT_PARTITION__`` (read back as a null ``dt``).
    ``dedupe_within`` (e.g. ``"1 hour"``) drops re-sent copies of an
    ``alertId`` arriving within that delay of each other (broker time);
    the dedupe state is evicted by the watermark, so it stays bounded. Each batch
    reports messages read and dropped as the observation ``PARSE``.
    """
    alerts = parse_alerts(messages, observe=PARSE)
    if dedupe_within:
        alerts = alerts.withWatermark("kafka_ts", dedupe_within).dropDuplicatesWithinWatermark(
            ["alertId"]
        )
    writer = (
        alerts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", str(max_records_per_file))
        .partitionBy("dt")
        .outputMode("append")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _files(frame: DataFrame) -> set[str]:
    return {r[0] for r in frame.select("_metadata.file_path").distinct().collect()}


def _opens(spark: SparkSession, files: list[str]) -> bool:
    try:
        spark.read.schema(LAKE_SCHEMA).parquet(*files).count()
        return True
    except AnalysisException:
        return False
    except Exception as exc:
        if UNREADABLE not in str(exc) and "ParquetFileReader" not in str(exc):
            raise  # not about a file: a lost executor, no memory
        return False


#: How Spark's file readers name a file that they cannot read.
UNREADABLE = "FAILED_READ_FILE"


def damaged_files(spark: SparkSession, path: str) -> list[str]:
    """Files of the lake that do not open, by name; none if there is no lake.

    One pass over the footers says which files have rows. The others are empty or
    damaged; they are opened together, and in halves as long as that fails, so few
    damaged ones among many cost few tries. File names, not rows, reach the driver.
    """
    try:
        names = _lake_files(spark, path)
        good = spark.read.schema(LAKE_SCHEMA).option("ignoreCorruptFiles", "true").parquet(path)
        doubtful = sorted(names - _files(good))
    except AnalysisException:
        return []
    lost: list[str] = []
    halves = [doubtful] if doubtful else []
    while halves:
        some = halves.pop()
        if _opens(spark, some):
            continue
        if len(some) == 1:
            lost += some
        else:
            halves += [some[: len(some) // 2], some[len(some) // 2 :]]
    return sorted(lost)


def read_lake(spark: SparkSession, path: str, without: list[str] | None = None) -> DataFrame | None:
    """The lake table, or None when nothing readable is at ``path``.

    Uses the lake schema rather than inference, so ``dt`` is a date and a
    ``dt`` predicate prunes folders. Files named in ``without`` are never opened.
    """
    try:
        lake = spark.read.schema(LAKE_SCHEMA).parquet(path)
    except AnalysisException as exc:
        print(f"[alertscope] no readable lake at {path}: {exc}")
        return None
    if not without:
        return lake
    if len(without) == len(_lake_files(spark, path)):
        return None
    return lake.filter(~F.col("_metadata.file_path").isin(without))


def _lake_files(spark: SparkSession, path: str) -> set[str]:
    return _files(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path))
