"""Token counts by source, language and tokenizer version, kept by deltas.

A batch of changes (inserts, deletes, revised counts) becomes signed rows that
are summed per key and committed under the batch's id. Totals are the sum of
all committed batches. A commit is one folder that counts once its success
marker is there: a batch that failed half-way is written anew, and one that
was committed is not applied again. ``compact`` folds batches into a base that
names them, so that reading stays cheap.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.llm.common import prepare
from alertscope.llm.token_cache import counter

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens"]
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def count_tokens(
    docs: DataFrame, vocabularies: dict[str, str], texts: dict[str, Column], wanted: list[tuple[str, str]], keep: list[str]
) -> DataFrame:
    """``keep`` columns plus a long column ``<tokenizer>_<text>`` for each wanted pair of
    a vocabulary and a text column.

    Null and empty texts have no tokens; repeated rows are counted alike; an empty table
    gives an empty result. A text that equals the first of its row is not encoded again
    for the same vocabulary. Columns of ``docs`` that are not kept cannot clash; a kept
    one with the name of a count is an error.
    """
    spark = prepare(docs.sparkSession)
    names = [f"{v}_{t}" for v, t in wanted]
    if clash := set(names) & set(keep):
        raise ValueError(f"kept columns have names of counts: {sorted(clash)}")
    shared = spark.sparkContext.broadcast(vocabularies)
    rows = docs.select(
        F.struct(*keep).alias("kept"), F.struct(*[t.cast("string").alias(n) for n, t in texts.items()]).alias("texts")
    )
    schema = f"kept {rows.schema['kept'].dataType.simpleString()}, " + ", ".join(f"`{n}` long" for n in names)
    order, first = list(texts), next(iter(texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(1).field(i).to_pylist() for i, n in enumerate(order)}
            counts: dict[tuple[str, str], list[int]] = {}
            for vocabulary, name in wanted:
                count, same = counter(shared.value[vocabulary]).count, counts.get((vocabulary, first))
                counts[vocabulary, name] = [
                    same[i] if same and t == columns[first][i] else count(t) for i, t in enumerate(columns[name])
                ]
            found = [pa.array(counts[pair], pa.int64()) for pair in wanted]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["kept", *names])

    return rows.mapInArrow(work, schema).select("kept.*", *names)


def signed(changes: DataFrame) -> DataFrame:
    """``changes(op, <keys>, n_tokens, old_tokens)`` → signed rows.

    ``insert`` adds a document, ``delete`` takes one away, ``revise`` replaces
    ``old_tokens`` by ``n_tokens`` and leaves the number of documents. Another
    op, or a null one, is an error, as it would spoil the totals silently.
    """
    op = F.col("op")
    known = F.coalesce(op.isin("insert", "delete", "revise"), F.lit(False))
    op = F.when(known, op).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))))
    return changes.select(
        *KEYS,
        F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0).cast("long").alias("n_docs"),
        F.when(op == "insert", F.coalesce("n_tokens", F.lit(0)))
        .when(op == "delete", -F.coalesce("n_tokens", F.lit(0)))
        .otherwise(F.coalesce("n_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0)))
        .cast("long")
        .alias("n_tokens"),
    )


def inserted(docs: DataFrame, tokenizer: str, tokens: str, op: str = "insert") -> DataFrame:
    """Changes of one kind for the rows of ``docs(source, lang, <tokens>)``."""
    return docs.select(
        F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
        F.col(tokens).alias("n_tokens"), F.lit(0).cast("long").alias("old_tokens"),
    )


class TokenRollups:
    """The committed batches below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = prepare(spark), folder.rstrip("/")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _done(self, kind: str) -> list[str]:
        """Names below ``kind`` that have a success marker, sorted."""
        fs, at = self._fs(f"{self.folder}/{kind}")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(n for n in names if fs.exists(path(f"{self.folder}/{kind}/{n}/_SUCCESS")))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it was applied before, which changes nothing.

        Sums are taken per key before the shuffle, so a source with a third of
        all rows is one row per task. A null source or language is a key.
        """
        if not batch_id or "/" in batch_id or batch_id.startswith(("_", ".")):
            raise ValueError(f"unfit batch id: {batch_id!r}")
        if batch_id in self._done("batches") or batch_id in self._base()[1]:
            return False
        sums = signed(changes).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums.write.mode("overwrite").parquet(f"{self.folder}/batches/{batch_id}")
        return True

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches folded into it."""
        bases = self._done("bases")
        if not bases:
            return None, set()
        names = self.spark.read.text(f"{self.folder}/folded/{bases[-1]}").collect()
        return bases[-1], {r["value"] for r in names}

    def totals(self) -> DataFrame:
        """Sums per key over all batches; a key whose documents all went stays, with zeros."""
        base, folded = self._base()
        paths = [f"{self.folder}/batches/{b}" for b in self._done("batches") if b not in folded]
        paths += [f"{self.folder}/bases/{base}"] if base else []
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths)
        return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])

    def compact(self) -> str:
        """Fold every batch into a new base. The list of what it holds is written
        first and the base's success marker counts, so a crash loses nothing."""
        base, folded = self._base()
        name = f"{int(base or 0) + 1:09d}"
        batches = sorted(folded | set(self._done("batches")))
        self.spark.createDataFrame([(b,) for b in batches], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.folder}/folded/{name}"
        )
        self.totals().write.mode("overwrite").parquet(f"{self.folder}/bases/{name}")
        return name
