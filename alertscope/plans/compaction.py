"""Few large files instead of many small ones, for days of the lake that are over.

The lake stream writes at least one file per batch and date, and its file log names
them, so they cannot be replaced in place. A compacted day is a copy in a ledger
beside the lake, with the list of the files it was made from, and becomes visible
with its commit. ``compacted_lake`` reads a committed day from there and, of the lake
itself, only files that no commit names: late alerts of a compacted day included.
"""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.plans.lake_job import read_lake
from alertscope.schema import LAKE_SCHEMA
from alertscope.streaming.ledger import Ledger

#: Size that a file of a compacted day is made for.
FILE_BYTES = 256 << 20
_LISTS = "sources"


def _part(day: datetime.date | None) -> int:
    return -1 if day is None else day.toordinal()


def _of(lake: DataFrame, day: datetime.date | None) -> DataFrame:
    return lake.filter(F.col("dt").isNull() if day is None else F.col("dt") == F.lit(day))


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """``(dt, file, bytes)`` of the lake's files that hold rows."""
    lake = read_lake(spark, path)
    if lake is None:
        return spark.createDataFrame([], "dt date, file string, bytes long")
    return lake.select(
        "dt", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).distinct()


def compact_day(
    spark: SparkSession, path: str, store: str, day: datetime.date | None, file_bytes: int = FILE_BYTES
) -> bool:
    """Copy the rows of a closed day to files of about ``file_bytes``; False if that is
    done, which changes nothing. ``day`` None is the folder of alerts without a date.

    The list of files is committed first and the copy is made of exactly those, so
    files that come in between stay where they are. Rows are dealt out round robin:
    no key decides the size of a file.
    """
    ledger, part = Ledger(spark, store), _part(day)
    if ledger.has("days", part):
        return False
    sources = ledger.keep(_LISTS, part, lambda: _of(day_files(spark, path), day))
    files = [r["file"] for r in sources.select("file").collect()]
    size = sources.agg(F.sum("bytes")).first()[0] or 0

    def rows() -> DataFrame:
        mine = _of(read_lake(spark, path), day).filter(F.col("_metadata.file_path").isin(files))
        return mine.repartition(max(1, -(-size // file_bytes)))

    if files:
        ledger.keep("days", part, rows)
    return bool(files)


def compact_closed(
    spark: SparkSession,
    path: str,
    store: str,
    before: datetime.date,
    most_files: int = 8,
    file_bytes: int = FILE_BYTES,
    parallel: int = 4,
) -> list[datetime.date | None]:
    """Compact the days before ``before`` that lie in more than ``most_files`` files,
    ``parallel`` at a time."""
    days = day_files(spark, path).groupBy("dt").agg(F.count(F.lit(1)).alias("files"))
    many = days.filter((F.col("files") > most_files) & (F.col("dt").isNull() | (F.col("dt") < F.lit(before))))
    found = sorted((r["dt"] for r in many.select("dt").collect()), key=lambda d: (d is not None, d or before))
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        done = list(pool.map(lambda d: compact_day(spark, path, store, d, file_bytes), found))
    return [d for d, new in zip(found, done) if new]


def compacted_lake(spark: SparkSession, path: str, store: str) -> DataFrame | None:
    """The lake as ``read_lake`` gives it, compacted days from ``store``. What a reader
    sees is fixed when this returns: a day compacted later is read from its old files."""
    ledger, lake = Ledger(spark, store), read_lake(spark, path)
    done = ledger.committed("days")
    if lake is None or not done:
        return lake
    replaced = [r["file"] for r in ledger.read_some(_LISTS, done).select("file").collect()]
    days = [datetime.date.fromordinal(p) for p in done if p >= 0]
    compacted = F.col("dt").isin(days) if -1 not in done else F.col("dt").isNull() | F.col("dt").isin(days)
    compacted = F.coalesce(compacted, F.lit(False))
    late = lake.filter(compacted & ~F.col("_metadata.file_path").isin(replaced))
    copies = ledger.read_some("days", done).select(*[F.col(f.name).cast(f.dataType) for f in LAKE_SCHEMA.fields])
    return lake.filter(~compacted).unionByName(late).unionByName(copies)
