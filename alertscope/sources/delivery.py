"""Keyed publishing with an outcome for every record.

Spark's topic sink fails a whole batch or none of it. ``deliver`` sends the records
of each Arrow batch through a ``Sender`` of the task's own and gives every row back
with what became of it, as an ordinary DataFrame: written by Spark's file commit,
only the winning attempt of a task leaves its outcomes, however often executors
are lost. A record may then have been sent more than once, never less than its
outcome says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertscope.session import ship_package

#: Times a record is sent again after its first failure.
RETRIES = 3

Record = tuple[str, str]


class Sender(Protocol):
    """One connection to a topic. It is made in the task, so it need not be picklable."""

    def send(self, records: list[Record]) -> list[str | None]:
        """Send (key, value) records in order; for each the error, or None."""

    def close(self) -> None: ...


def attempt(sender: Sender, records: list[Record], retries: int) -> list[tuple[bool, int, str | None]]:
    """(delivered, times sent, last error) of each record. Only failed ones are sent
    again. A call that raises is a failure of all its records."""
    out: list[tuple[bool, int, str | None]] = [(False, 0, None)] * len(records)
    open_ = list(range(len(records)))
    for turn in range(1, retries + 2):
        if not open_:
            break
        try:
            errors = sender.send([records[i] for i in open_])
            if len(errors) != len(open_):
                raise RuntimeError(f"{len(errors)} outcomes for {len(open_)} records")
        except Exception as exc:
            errors = [f"{type(exc).__name__}: {exc}"] * len(open_)
        for i, error in zip(open_, errors):
            out[i] = (error is None, turn, error)
        open_ = [i for i in open_ if not out[i][0]]
    return out


def deliver(
    raw: DataFrame,
    connect: Callable[[], Sender],
    key_col: str = "publish_key",
    value_col: str = "json",
    retries: int = RETRIES,
) -> DataFrame:
    """``raw`` with ``delivered``, ``attempts`` and ``error`` (of the last attempt; null
    when delivered). Write the result once: each reading of it sends the records.

    A null value is sent as an empty one. A column of ``raw`` with the name of an
    outcome is replaced.
    """
    ship_package(raw.sparkSession)
    outcome = ["delivered", "attempts", "error"]
    carried = [c for c in raw.columns if c not in outcome]
    names = ["_key", "_value"]
    rows = raw.select(
        F.col(key_col).cast("string").alias("_key"),
        F.coalesce(F.col(value_col).cast("string"), F.lit("")).alias("_value"),
        F.struct(*carried).alias("_row"),
    )
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, delivered boolean, attempts int, error string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = None
        try:
            for batch in batches:
                if sender is None:
                    sender = connect()
                records = list(zip(*(batch.column(n).to_pylist() for n in names)))
                done = attempt(sender, records, retries)
                columns = [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.bool_(), pa.int32(), pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("_row"), *columns], ["_row", *outcome])
        finally:
            if sender is not None:
                sender.close()

    return rows.mapInArrow(work, schema).select("_row.*", *outcome)
