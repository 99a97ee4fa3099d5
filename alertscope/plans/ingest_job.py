"""Incremental alert ingest: page bodies → new alerts → topic → advanced mark.

A batch is worked set-at-a-time: it is unnested, each page is tested against
the mark that the pages before it leave, the new alerts are published, and only
then is the next mark written, over those that were delivered. A publisher that
raises fails the batch and leaves the mark; one that reports on each record moves
it partly. A batch's new alerts and their outcomes are kept in a ledger under its
id, so that a replay sends nothing that is known to be delivered.

The mark is stored as a small Parquet table with two slots (double
buffering): version ``v`` overwrites slot ``v % 2`` only, and readers take
the highest version present. A write that dies half-way leaves the other
slot — the previous mark — intact, so the worst case is a re-send, never a
loss, and storage stays at two tiny partitions however long the poller
runs. The ids at the mark instant are stored too, so a restart does not
re-send alerts at exactly that instant (pass ``timestamp_only=True`` to
read it the way a timestamp-only store would).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertscope.operators.incremental import (
    cursor_fields,
    empty_mark,
    new_over_pages,
    new_since_mark,
    next_mark,
    timestamp_only as ts_only_mark,
)
from alertscope.session import checkpoint_root, delete_path, scratch_path
from alertscope.sources.pages import unnest_pages
from alertscope.streaming.ledger import Ledger

MARK_SLOTS = 2
STORED_SCHEMA = "mark_ts timestamp, mark_id string, version long"


def load_new(batch: DataFrame, mark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(new rows, next mark)`` for rows with cursor fields: page after page if they
    have a ``page_seq``, else as one poll."""
    paged = "page_seq" in batch.columns
    new = new_over_pages(batch, mark) if paged else new_since_mark(batch, mark)
    return new, next_mark(new, mark)


def _slot(spark: SparkSession, path: str, slot: int) -> tuple[int, DataFrame] | None:
    """Version and rows of one slot, read whole; None when missing or unreadable."""
    try:
        stored = spark.read.schema(STORED_SCHEMA).parquet(f"{path}/slot={slot}")
        version = stored.select(F.max("version")).first()[0]
        if version is None:
            return None
        rows = stored.filter(F.col("version") == version).select("mark_ts", "mark_id")
        return int(version), rows.checkpoint()
    except AnalysisException:
        return None
    except Exception as exc:  # a damaged file: the other slot may still be good
        print(f"[alertscope] unreadable mark slot {slot} at {path}: {type(exc).__name__}")
        return None


def stored_mark(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """``(version, mark)`` of the newest readable slot; version -1 and an empty mark
    when there is none."""
    checkpoint_root(spark)
    found = [s for s in (_slot(spark, path, k) for k in range(MARK_SLOTS)) if s is not None]
    return max(found, key=lambda s: s[0]) if found else (-1, empty_mark(spark))


def mark_version(spark: SparkSession, path: str) -> int:
    """Highest readable mark version, or -1 when there is none."""
    return stored_mark(spark, path)[0]


def read_mark(spark: SparkSession, path: str, timestamp_only: bool = False) -> DataFrame:
    """Newest readable mark; a missing or unreadable store means "no mark"."""
    mark = stored_mark(spark, path)[1]
    return ts_only_mark(mark) if timestamp_only else mark




def write_mark(mark: DataFrame, path: str, version: int) -> None:
    """Write ``mark`` as ``version`` into slot ``version % 2``, leaving the other slot."""
    (
        mark.select(
            "mark_ts",
            "mark_id",
            F.lit(int(version)).cast("long").alias("version"),
            F.lit(int(version) % MARK_SLOTS).alias("slot"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slot")
        .parquet(path)
    )


def _outcomes(new: DataFrame, publish: Callable[[DataFrame], DataFrame | None]) -> DataFrame:
    """``new`` with ``delivered`` for every row; a publisher that gives back no rows has
    delivered all or raised."""
    out = publish(new)
    return out if isinstance(out, DataFrame) else new.withColumn("delivered", F.lit(True))


def poll_batch(
    spark: SparkSession,
    pages: DataFrame,
    mark_path: str,
    publish: Callable[[DataFrame], DataFrame | None],
    ledger: Ledger,
    batch_id: int,
    resend: bool = False,
) -> int:
    """Poll a batch of page bodies; returns the number of alerts delivered.

    With a ``page_seq`` column the pages are polled in its order, each against the
    mark that the pages before it leave; without one the batch is a single poll.
    ``publish`` may give back the rows with a ``delivered`` flag (``deliver`` does):
    the mark then covers the delivered ones only. An undelivered alert at or below
    the mark is not new at the next poll; with ``resend`` the ones that the batch
    before left undelivered are published again together with the new ones.

    What is new, and what became of it, is kept in the ledger under the batch id. A
    batch that is run again publishes the same rows, none if their outcomes were
    committed, whatever the mark says by then; alerts without an instant, which no
    mark holds back, are not sent twice. Moving the mark twice changes nothing.
    """
    version, mark = stored_mark(spark, mark_path)

    def find() -> DataFrame:
        rows = cursor_fields(unnest_pages(pages)).drop("alert")
        raw = ledger.keep("raw", batch_id, lambda: rows)  # read several times
        new = load_new(raw, mark)[0]
        before = [i for i in ledger.committed("outcomes") if i < batch_id] if resend else []
        if not before:
            return new
        left = ledger.read("outcomes", before[-1]).filter(~F.col("delivered"))
        return new.unionByName(left.select(*[c for c in new.columns if c in left.columns]), allowMissingColumns=True)

    new = ledger.keep("new", batch_id, find)
    outcomes = ledger.keep("outcomes", batch_id, lambda: _outcomes(new, publish))
    delivered = outcomes.filter("delivered")
    try:
        write_mark(next_mark(delivered, mark), mark_path, version + 1)
    except Exception as exc:  # the next poll re-reads the old mark: re-send, never loss
        print(f"[alertscope] could not persist mark to {mark_path}: {exc}")
    for kind in ("raw", "new", "outcomes"):  # a stream replays its last batch only
        ledger.forget(kind, batch_id - 1)
    return delivered.count()


def poll_once(
    spark: SparkSession,
    pages: DataFrame,
    mark_path: str,
    publish: Callable[[DataFrame], DataFrame | None],
) -> int:
    """``poll_batch`` on its own: its ledger is deleted at the end."""
    folder = scratch_path(spark, "poll")
    try:
        return poll_batch(spark, pages, mark_path, publish, Ledger(spark, folder), 0)
    finally:
        delete_path(spark, folder)


def start_poller(
    pages_stream: DataFrame,
    mark_path: str,
    publish: Callable[[DataFrame], DataFrame | None],
    checkpoint: str,
    trigger: dict | None = None,
    resend: bool = False,
) -> StreamingQuery:
    """Run ``poll_batch`` per micro-batch of a stream of page bodies, with a ledger
    beside the checkpoint."""

    def each(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, f"{checkpoint.rstrip('/')}-ledger")
        poll_batch(batch.sparkSession, batch, mark_path, publish, ledger, batch_id, resend)

    writer = pages_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
