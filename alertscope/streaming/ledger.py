"""A ledger of what the batches of a stream produced, each kept exactly once.

A micro-batch that fails after it has written something is run again with the
same batch id. ``Ledger.keep`` writes a batch's rows to a new folder and commits
them with a small file named after the batch, which is moved into place only if
there is none yet: of several attempts one wins, a replay reads what the winner
wrote, and a folder without a commit is never read. So rows that are computed from
state which has moved on in the meantime (a mark, a clock) stay as they were.

A ledger lies in a folder that all executors share; ``kind`` separates what one
batch keeps for different purposes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from alertscope.session import delete_path


class Ledger:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)

    def committed(self, kind: str) -> list[int]:
        """Ids of the batches that are committed, in order."""
        at = self._path(f"{self.folder}/{kind}/commits")
        if not self._fs.exists(at):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(at))

    def has(self, kind: str, batch_id: int) -> bool:
        return self._fs.exists(self._path(f"{self.folder}/{kind}/commits/{batch_id}"))

    def _name(self, kind: str, batch_id: int) -> str:
        stream = self._fs.open(self._path(f"{self.folder}/{kind}/commits/{batch_id}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _commit(self, kind: str, batch_id: int, name: str) -> bool:
        """Move the commit file into place; False if another attempt was first."""
        jvm = self.spark._jvm
        root = self._path(f"{self.folder}/{kind}/commits")
        self._fs.mkdirs(root)
        staged = self._path(f"{self.folder}/{kind}/{uuid.uuid4().hex}.commit")
        out = self._fs.create(staged)
        out.write(bytearray(name.encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(staged, self._path(f"{self.folder}/{kind}/commits/{batch_id}"), no_overwrite)
            return True
        except Exception:
            self._fs.delete(staged, False)
            if self.has(kind, batch_id):
                return False
            raise

    def keep(self, kind: str, batch_id: int, make: Callable[[], DataFrame]) -> DataFrame:
        """The rows committed for the batch; without any, those that ``make`` gives are
        written and committed first. ``make`` is not called for a committed batch."""
        if not self.has(kind, batch_id):
            name = f"{batch_id}-{uuid.uuid4().hex[:12]}"
            make().write.parquet(f"{self.folder}/{kind}/data/{name}")
            if not self._commit(kind, batch_id, name):
                delete_path(self.spark, f"{self.folder}/{kind}/data/{name}")
        return self.read(kind, batch_id)

    def once(self, kind: str, batch_id: int, act: Callable[[], None]) -> bool:
        """Run ``act`` unless the batch is committed, then commit it. An attempt that
        dies between the two is repeated: at least once, and never again after."""
        if self.has(kind, batch_id):
            return False
        act()
        self._commit(kind, batch_id, "")
        return True

    def read(self, kind: str, batch_id: int | None = None) -> DataFrame | None:
        """Committed rows of one batch, or of all; None if nothing is committed."""
        ids = self.committed(kind) if batch_id is None else [batch_id] * self.has(kind, batch_id)
        return self.read_some(kind, ids) if ids else None

    def read_some(self, kind: str, batch_ids: list[int]) -> DataFrame:
        """Rows of committed batches, all of which have the same columns."""
        paths = [f"{self.folder}/{kind}/data/{self._name(kind, i)}" for i in batch_ids]
        return self.spark.read.parquet(*paths)

    def last(self, kind: str) -> DataFrame | None:
        """Rows of the newest committed batch."""
        ids = self.committed(kind)
        return self.read(kind, ids[-1]) if ids else None

    def forget(self, kind: str, before: int) -> None:
        """Delete batches below ``before``: the commit first, so that no reader finds
        a commit without its rows."""
        for batch_id in self.committed(kind):
            if batch_id < before:
                name = self._name(kind, batch_id)
                self._fs.delete(self._path(f"{self.folder}/{kind}/commits/{batch_id}"), False)
                if name:
                    delete_path(self.spark, f"{self.folder}/{kind}/data/{name}")
