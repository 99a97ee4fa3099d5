"""Token ids in raw binary shards with a minimal perfect hash index.

A shard is a block of documents in ascending id order: a header, the ids'
directory (document key and length of each) and the raw ids, two bytes each
when the vocabulary allows it, else four. Blocks are written with Spark's text
writer, one block a line, so any store that Spark writes to will do and a
lost executor's blocks are written again under the commit protocol.

The index maps a document key in constant time to its shard and slot. Keys are
hashed into parts of bounded size; each part holds a minimal perfect hash over
its keys (levels of bit arrays: a key owns the first level where it collides
with no other; its number is the rank of its bit), a stored fingerprint per key
that tells strangers from members, and the places of the key's records.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare
from alertscope.llm.token_cache import encoder

# Fixed values of the file format.
MAGIC = b"TOKBLK01"
HEADER = struct.Struct("<8sIIQ")  # magic, bytes per id, documents, ids
NO_KEY = -(1 << 63)  # stands for a null document key
#: A block is closed at so many bytes of ids; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: Mean number of keys in a part of the index.
PART_KEYS = 2048

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    """splitmix64 of int64 keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + _MIX[0] * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys with 32-bit fingerprints."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray) -> None:
        self.levels, self.prints = levels, prints  # levels: rank + 1 of a set bit, else 0

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left, ranked = [], keys, 0
        while len(left):
            at = (_hash(left, len(levels)) % np.uint64(2 * len(left))).astype(np.int64)
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            rank = np.where(alone, np.cumsum(alone) + ranked, 0)
            levels.append(rank)
            ranked += int(alone.sum())
            left = left[~alone[at]]
        out = cls(levels, np.zeros(len(keys), dtype=np.uint32))
        out.prints[out._number(keys)] = cls._print(keys)
        return out

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (_hash(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)

    def _number(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        for n, ranks in enumerate(self.levels):
            open_ = np.flatnonzero(out == 0)
            if not len(open_):
                break
            out[open_] = ranks[(_hash(keys[open_], n) % np.uint64(len(ranks))).astype(np.int64)]
        return out - 1

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, or -1 for a key whose fingerprint differs."""
        number = self._number(keys)
        known = number >= 0
        known[known] = self.prints[number[known]] == self._print(keys[known])
        return np.where(known, number, -1)

    def to_bytes(self) -> bytes:
        out = [struct.pack("<II", len(self.prints), len(self.levels))]
        for ranks in self.levels:
            bits = ranks > 0
            out += [struct.pack("<I", len(bits)), np.packbits(bits).tobytes()]
        return b"".join(out) + self.prints.astype("<u4").tobytes()

    @classmethod
    def read(cls, blob: bytes) -> tuple[PerfectHash, int]:
        """The hash, and the bytes it took."""
        (n, n_levels), at, levels, ranked = struct.unpack_from("<II", blob), 8, [], 0
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<I", blob, at)
            packed = np.frombuffer(blob, np.uint8, (size + 7) // 8, at + 4)
            bits = np.unpackbits(packed, count=size).astype(bool)
            levels.append(np.where(bits, np.cumsum(bits) + ranked, 0))
            ranked += int(bits.sum())
            at += 4 + len(packed)
        return cls(levels, np.frombuffer(blob, "<u4", n, at)), at + 4 * n


def block(keys: list[int], parts: list[bytes], width: int) -> bytes:
    lengths = np.array([len(p) // width for p in parts], dtype="<i8")
    head = HEADER.pack(MAGIC, width, len(keys), int(lengths.sum()))
    return b"".join([head, np.array(keys, dtype="<i8").tobytes(), lengths.tobytes(), *parts])


def blocks(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(keys, lengths, ids)`` of each block of a file, in order."""
    at = 0
    while at < len(content):
        magic, width, n_docs, n_ids = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no token block at byte {at}")
        at += HEADER.size
        keys = np.frombuffer(content, "<i8", n_docs, at)
        lengths = np.frombuffer(content, "<i8", n_docs, at + 8 * n_docs)
        at += 16 * n_docs
        yield keys, lengths, np.frombuffer(content, f"<u{width}", n_ids, at)
        at += width * n_ids + 1  # and the line end


def write_shards(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every document and write the blocks in ascending key order."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value)
        width = 2 if max(own.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.uint32(end_id).tobytes()
        keys: list[int] = []
        parts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block(keys, parts, width)], pa.binary())], ["block"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(own.encode(text) + end, "<u4").astype(f"<u{width}").tobytes()
                if held and held + len(ids) > BLOCK_BYTES:
                    yield closed()
                    keys, parts, held = [], [], 0
                keys.append(NO_KEY if key is None else key)
                parts.append(ids)
                held += len(ids)
        if keys:
            yield closed()

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("t"))
    order = ["key", F.xxhash64("t")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(work, "block binary").select(F.col("block").cast("string").alias("value")).write.option(
        "compression", "none"
    ).text(folder)


RECORDS = "key long, shard long, slot int, local_start long, n_tokens long, ids_crc32 long"


def read_records(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The records of all shard files: key, shard (file number and block), slot in
    the block, ids before it in the block, its ids' number and checksum."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k, (keys, lengths, ids) in enumerate(blocks(content.as_py())):
                    wide = ids.astype("<u4")
                    ends = np.cumsum(lengths)
                    spans = [wide[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
                    columns = [
                        pa.array(keys, pa.int64(), mask=keys == NO_KEY),
                        pa.array(np.full(len(keys), (number << 24) + k), pa.int64()),
                        pa.array(np.arange(len(keys)), pa.int32()),
                        pa.array(ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                    ]
                    names = [x.split()[0] for x in RECORDS.split(", ")]
                    if with_ids:
                        columns, names = [*columns, pa.array(spans, pa.binary())], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    files = spark.read.format("binaryFile").load(folder).select(number.alias("number"), "content")
    return files.mapInArrow(work, RECORDS + (", ids binary" if with_ids else ""))


def _part(key, parts: int):
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def build_index(records: DataFrame) -> DataFrame:
    """``(part, parts, blob)``: one row per part of the index.

    Records of one key in one shard are neighbours and make one run, so a key
    has at most as many places as there are shards, however often it repeats.
    """
    runs = records.groupBy(F.coalesce("key", F.lit(NO_KEY)).alias("key"), "shard").agg(
        F.min("slot").alias("slot"), F.count("*").cast("int").alias("n")
    )
    runs = materialize(runs, "index-runs")
    parts = max(1, -(-runs.count() // PART_KEYS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "shard"], kind="stable")
        keys, counts = np.unique(rows["key"].to_numpy(np.int64), return_counts=True)
        own = PerfectHash.build(keys)
        by_number = np.argsort(own.lookup(keys))
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        blob = b"".join([
            own.to_bytes(),
            first[by_number].astype("<i8").tobytes(), counts[by_number].astype("<i8").tobytes(),
            struct.pack("<Q", len(rows)),
            rows["shard"].to_numpy("<i8").tobytes(), rows["slot"].to_numpy("<i4").tobytes(),
            rows["n"].to_numpy("<i4").tobytes(),
        ])
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "parts": [parts], "blob": [blob]})

    return runs.withColumn("part", _part("key", parts)).groupBy("part").applyInPandas(
        build, "part int, parts int, blob binary"
    )


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """``keys(key)`` → ``key, shard, slot``, a row per record of each known key;
    keys that the index does not hold give no row."""
    some = index.select("parts").first()
    parts = some["parts"] if some else 1

    def find(asked: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"key": [], "shard": [], "slot": [], "n": []}).astype("int64")
        if not len(blobs) or not len(asked):
            return empty
        blob = blobs["blob"].iloc[0]
        own, at = PerfectHash.read(blob)
        n = len(own.prints)
        first, counts = (np.frombuffer(blob, "<i8", n, at + 8 * n * i) for i in range(2))
        at += 16 * n
        (n_runs,) = struct.unpack_from("<Q", blob, at)
        shard = np.frombuffer(blob, "<i8", n_runs, at + 8)
        slot = np.frombuffer(blob, "<i4", n_runs, at + 8 + 8 * n_runs)
        length = np.frombuffer(blob, "<i4", n_runs, at + 8 + 12 * n_runs)
        wanted = asked["key"].to_numpy(np.int64)
        number = own.lookup(wanted)
        wanted, number = wanted[number >= 0], number[number >= 0]
        places = counts[number]
        turn = np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        run = np.repeat(first[number], places) + turn
        return pd.DataFrame({"key": np.repeat(wanted, places), "shard": shard[run], "slot": slot[run], "n": length[run]})

    asked = keys.select(F.coalesce(F.col("key"), F.lit(NO_KEY)).alias("key")).distinct()
    runs = (
        asked.withColumn("part", _part("key", parts))
        .groupBy("part")
        .cogroup(index.select("part", "blob").groupBy("part"))
        .applyInPandas(find, "key long, shard long, slot long, n long")
    )
    return runs.select(
        F.when(F.col("key") != NO_KEY, F.col("key")).alias("key"),
        "shard",
        F.explode(F.sequence(F.col("slot").cast("int"), (F.col("slot") + F.col("n") - 1).cast("int"))).alias("slot"),
    )


def indexed_tokens(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write ``docs`` to ``folder`` (shards and index), look every key up and return
    ``doc_id, start, n_tokens, ids_crc32, shard, slot`` as the files hold them.

    Null and empty texts are the end id alone. Repeated keys keep a record
    each, in the order of their texts' hashes; a null key is stored under a
    reserved one and comes first. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    write_shards(docs, vocabulary, f"{folder}/shards", end_id, id_col, text_col)
    records = materialize(read_records(spark, f"{folder}/shards"), "token-records")
    build_index(records.select("key", "shard", "slot")).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    found = lookup(index, docs.select(F.col(id_col).cast("long").alias("key")))
    # a row per shard, of a few megabytes of ids each
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        records.groupBy("shard")
        .agg(F.sum("n_tokens").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    return (
        found.select(F.col("key").alias("doc_id"), "shard", "slot")
        .join(records.drop("key"), ["shard", "slot"])
        .join(base, "shard")
        .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "slot")
    )
