"""Best-two-fit packing of token sequences.

Documents become id sequences, longer ones are cut, and the pieces go into
bins of ``capacity`` ids. A bin is filled greedily with the longest piece that
still fits. If a gap is left, the bin's smallest piece is taken out when two
unpacked pieces fit the expanded gap more tightly.

Only a piece's length matters, so the packing is done on the histogram of
lengths, which has at most ``capacity`` entries whatever the corpus size: the
plan is a list of bin patterns, each with a repeat count. Pieces then find
their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare
from alertscope.llm.token_cache import encoder

#: Ranks are counted within (length, group); a group is a hash of the piece's
#: key, so that a length that a third of all pieces have is not one task.
RANK_GROUPS = 512

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, row_group int, ids binary"


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if
    asked for, ``ids`` (little-endian unsigned 32-bit)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode
        end = np.uint32(end_id).tobytes()
        step = 4 * capacity
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    crc = zlib.crc32(part)
                    row = (doc_id, piece, at // 4, len(part) // 4, crc,
                           (hash((doc_id, piece)) ^ crc) % RANK_GROUPS, part if with_ids else None)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    pieces = rows.mapInArrow(work, PIECE_SCHEMA)
    return pieces if with_ids else pieces.drop("ids")


def best_two_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Bin patterns ``(repeats, lengths in the bin)`` that use up ``histogram``.

    A pattern is repeated while every length in it lasts; each step uses up or
    nearly uses up a length, so the steps depend on ``capacity``, not on the
    number of pieces. Ties go to the longer piece.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    grid = np.arange(capacity + 1)
    patterns = []

    def floor_of(counts: np.ndarray) -> np.ndarray:
        """For each size the longest piece left that fits it, 0 if none."""
        return np.maximum.accumulate(np.where(counts > 0, grid, 0))

    while left.any():
        counts = left.copy()
        fits, bin_, gap = floor_of(counts), [], capacity
        while gap and (longest := int(fits[gap])):
            # as many of it as fit and are there
            n = min(gap // longest, int(counts[longest]))
            bin_ += [longest] * n
            gap -= n * longest
            counts[longest] -= n
            if not counts[longest]:
                fits = floor_of(counts)
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            room = gap + smallest
            first = grid[1:room][counts[1:room] > 0]
            if len(first):
                second = fits[room - first]
                # two of the same length need two of them
                lone = (second == first) & (counts[first] < 2)
                if lone.any():
                    second[lone] = fits[first[lone] - 1]
                total = np.where(second > 0, first + second, 0)
                best = int(total.max())
                if best > smallest:
                    k = len(total) - 1 - int(np.argmax(total[::-1]))
                    bin_ = bin_[:-1] + [int(first[k]), int(second[k])]
        used = Counter(bin_)
        repeats = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= repeats * n
        patterns.append((repeats, sorted(bin_, reverse=True)))
    return patterns


def _places(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, end rank, first bin, per bin, offset)`` per pattern and length."""
    rows, taken, bins = [], Counter(), 0
    for repeats, lengths in patterns:
        offset = 0
        for length, per_bin in Counter(lengths).items():
            n = repeats * per_bin
            rows.append((length, taken[length], taken[length] + n, bins, per_bin, offset))
            taken[length] += n
            offset += per_bin * length
        bins += repeats
    return rows


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``length`` and ``row_group``."""
    spark = pieces.sparkSession
    per_group = pieces.groupBy("length", "row_group").agg(F.count("*").alias("n"))
    # at most capacity rows, each a length and its count
    histogram = {r["length"]: r["n"] for r in per_group.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        _places(best_two_fit(histogram, capacity)),
        "length long, first long, end long, bin long, per_bin long, base long",
    )
    before = Window.partitionBy("length").orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_group.select("length", "row_group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "row_group").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("r", F.row_number().over(within))
        .join(starts, ["length", "row_group"])
        .withColumn("rank", F.col("ahead") + F.col("r") - 1)
    )
    # The places follow the distinct lengths and bins' patterns: bounded by the
    # capacity, so each task can hold them.
    at = F.broadcast(places.withColumnRenamed("length", "at_length"))
    hit = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    turn = F.col("rank") - F.col("first")
    return ranked.join(at, hit).select(
        *[c for c in pieces.columns if c != "row_group"],
        (F.col("bin") + F.floor(turn / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(turn, F.col("per_bin")) * F.col("length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences.

    Null and empty texts are the end id alone. A text of more than ``capacity``
    ids is cut into pieces of ``capacity``, the last shorter. Repeated rows are
    packed as often as they occur; pieces that tie in every column may swap
    places. An empty table gives no rows. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    pieces = token_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids)
    return pack(materialize(pieces, "pieces"), capacity)
