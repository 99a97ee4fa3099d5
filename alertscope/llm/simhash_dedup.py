"""SimHash near-dedup with pigeonring filtering.

Fingerprints of 64 bits are cut into ``segments`` segments on a ring. If two
fingerprints differ in at most t bits, some start has the property that, for
every l, the first l segments from it differ in at most floor(l * t / segments)
bits. The leading segments whose budget is zero are an equality key; the
budgets of the longer chains are checked on the joined rows, before the full
Hamming distance.

A key that many distinct fingerprints share is not joined with itself. Its
members meet at their one-bit neighbours instead (two fingerprints within two
bits share one, and at most 65 fingerprints share any), which finds the same
links with rows in proportion to the members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare, release
from alertscope.llm.components import connected_components

# Fingerprint width and shingle hash seed.
BITS = 64
SEED = 42
#: Shingles hashed and counted at a time, so a very long text stays in memory.
SHINGLE_BLOCK = 1 << 16
#: Distinct fingerprints on a key up to which its members are joined directly.
DIRECT_LIMIT = 32


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    width = min(shingle, len(words))
    spans = list(zip(starts[: len(words) - width + 1], ends[width - 1 :]))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(spans), SHINGLE_BLOCK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans[k : k + SHINGLE_BLOCK]], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(spans)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed 64-bit number; null text is empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t or b"", shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(work, "doc_id long, fp long")


def ring(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, first segment in the top bits."""
    cuts = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(BITS - cuts[i + 1], cuts[i + 1] - cuts[i]) for i in range(segments)]


def chain_masks(segments: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """For each start the (mask, budget) of chains of 1, 2, ... segments."""
    parts = [((1 << w) - 1) << s for s, w in ring(segments)]
    out = []
    for start in range(segments):
        mask, chain = 0, []
        for length in range(1, segments + 1):
            mask |= parts[(start + length - 1) % segments]
            chain.append((mask, length * max_bits // segments))
        out.append(chain)
    return out


def _pick(start: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(_signed(v)).cast("long") for v in values]), start + 1)


def near_links(fps: DataFrame, max_bits: int, segments: int, direct_limit: int = DIRECT_LIMIT) -> DataFrame:
    """Distinct ``fps(fp)`` → links ``(src, dst)`` that connect exactly the
    fingerprints connected by pairs within ``max_bits``."""
    if max_bits >= segments:
        raise ValueError("pigeonring needs more segments than differing bits")
    if max_bits > 2 and direct_limit < (1 << 62):
        raise ValueError("the neighbour route of crowded keys is exact for at most 2 bits")
    chains = chain_masks(segments, max_bits)
    zero = max(n for n in range(segments) if chains[0][n][1] == 0)
    keyed = fps.select(
        "fp",
        F.explode(
            F.array(*[
                F.struct(
                    F.lit(i).alias("start"),
                    F.col("fp").bitwiseAND(F.lit(_signed(chains[i][zero][0])).cast("long")).alias("key"),
                )
                for i in range(segments)
            ])
        ).alias("k"),
    ).select("fp", "k.start", "k.key")
    crowds = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(keyed.join(crowds, ["start", "key"]), "ring-keys")
    few = shared.where(F.col("n") <= direct_limit)
    a, b = few.select("start", "key", F.col("fp").alias("src")), few.select("start", "key", F.col("fp").alias("dst"))
    diff = F.col("src").bitwiseXOR(F.col("dst"))
    links = a.join(b, ["start", "key"]).where(F.col("src") < F.col("dst"))
    for length in range(zero + 1, segments):
        masks, budget = [chains[i][length][0] for i in range(segments)], chains[0][length][1]
        links = links.where(F.bit_count(diff.bitwiseAND(_pick(F.col("start"), masks))) <= budget)
    links = links.where(F.bit_count(diff) <= max_bits).select("src", "dst")
    # crowded keys: star around the least fingerprint of each shared neighbour
    crowded = shared.where(F.col("n") > direct_limit).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(BITS)])
    if max_bits == 2:
        meets = crowded.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("at"))
        groups = meets.groupBy("at").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        stars = groups.select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst"))
    elif max_bits == 1:  # one bit apart: the neighbour is the other fingerprint itself
        near = crowded.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("dst"))
        stars = near.join(crowded.select(F.col("fp").alias("dst")), "dst").select(F.col("fp").alias("src"), "dst")
    else:
        return links
    return links.union(stars.where("src <> dst"))


def _rooted(rows: DataFrame, key: Column, max_bits: int, segments: int, direct_limit: int) -> tuple[DataFrame, DataFrame]:
    """The distinct fingerprints of ``rows`` with the least ``key`` of each, written
    once, and the same as ``(fp, first, root)``, with the component's fingerprint."""
    distinct = materialize(rows.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    links = near_links(distinct.select("fp"), max_bits, segments, direct_limit)
    roots = connected_components(links, "simhash")
    return distinct, distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    segments: int = 5,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits)
    and ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included.

    Null and empty texts have fingerprint zero and link like any other; a
    text of fewer than ``shingle`` words is one shingle. Copies share a
    fingerprint and are collapsed before the join. A row with a null id keeps
    its group's smallest id. Other columns are ignored, so their names cannot
    clash. Ties do not arise: the smallest id is unique.
    """
    prepare(docs.sparkSession)
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct, rooted = _rooted(rows, F.col("doc_id"), max_bits, segments, direct_limit)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(rooted.join(least, "root").select("fp", "component_id"), "simhash-classes")
    release(distinct)
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    segments: int = 5,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """``docs`` with exactly one row of each component of ``simhash_groups``.

    It is the row of the smallest id, a null id coming last; rows of one id are
    told apart by the hash of their text, and rows equal in both by a row number,
    which is written with the rows, so that every reader sees the same. Repeated
    rows, near copies under one id and documents without an id count like any other.
    """
    prepare(docs.sparkSession)
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "simhash-docs")
    prints = fingerprints(numbered, "_row", text_col, shingle).withColumnRenamed("doc_id", "_row")
    ids = numbered.select(
        "_row", F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key")
    )
    rows = materialize(prints.join(ids, "_row"), "simhash")
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "_row")
    distinct, rooted = _rooted(rows, key, max_bits, segments, direct_limit)
    kept = materialize(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first._row"), "simhash-kept")
    release(distinct, rows)
    return numbered.join(kept, "_row", "left_semi").select(*docs.columns)
