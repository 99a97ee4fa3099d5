"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from alertscope.session import scratch_path

# The word separators of every contract here: space and tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
# Shuffle files of a query go as soon as it has ended, not when the driver's JVM
# next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows in an Arrow batch: 1,000 whole documents, so that a run of very long
# texts stays within a Python worker's memory.
ARROW_ROWS = 1000

_prepared: set[str] = set()
_scratch: list[tuple[SparkSession, str]] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors and bound Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _prepared:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        handle, path = tempfile.mkstemp(prefix="alertscope-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, files in os.walk(package):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(path)
        _prepared.add(app)
    return spark


def is_latin1(text: str) -> bool:
    """No character beyond Latin-1; a copy of the text at most."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(jvm_path, True)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, with options of the Parquet
    writer, and read it back.

    It cuts the lineage: an executor lost later costs a file read, not the
    work above. Nothing reads the write's shuffle files again, so they go with its
    end. ``release`` removes the folder early; what is left goes when the driver's
    Python ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    _scratch.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_folder = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the folders of materialized frames that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_scratch_folder", None)
        for entry in [e for e in _scratch if e[1] == path]:
            _scratch.remove(entry)
            _delete(*entry)


@atexit.register
def _release_all() -> None:
    while _scratch:
        spark, path = _scratch.pop()
        try:
            if spark._jsc.sc().isStopped():
                continue
            _delete(spark, path)
        except Exception:  # the gateway is gone with the JVM
            continue
