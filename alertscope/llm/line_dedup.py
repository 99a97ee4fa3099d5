"""Fuzzy line deduplication.

Lines are normalised (lower case, digits alike, marks as spaces) and get a
128-bit key and a 64-bit SimHash over their distinct words. Equal keys are equal lines,
however short; a line of marks alone has the key of its marks.
Distinct SimHash values that may be within ``max_bits`` agree on some
combination of whole blocks (pigeonhole). Each value goes once to the task of each of
its combinations; the values there are compared with each other, and what is within
the bit distance gives clusters of lines. Inside a cluster, pairs within the bit
distance are verified by edit similarity of the normalised lines, and of each
connected group the first occurrence, by document id and line number, is kept.

A cluster only decides which lines meet. Very many values that share a combination
are divided by the blocks of their other bits before they are compared, and what
still shares most of its bits is linked to one of them; a task sends on a spanning
forest of its pairs. A large cluster is compared block against block in tasks of
bounded size, each of which sends on a spanning star, never its pairs.

Texts stay where they are: only the documents that may hold a line to verify, by a
bitmap of fixed size, are shuffled.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertscope.llm.common import is_latin1, materialize, prepare, release
from alertscope.llm.components import connected_components

#: Normalised characters from which lines are compared: with fewer, one edit is over
#: a fifth of the line, so that only equal lines are similar.
MIN_CHARS = 5
MAX_BITS = 3
#: Blocks of the 64 bits; max_bits differing bits leave blocks - max_bits equal.
BLOCKS = 4
SIMILARITY = 0.8
#: Values on a combination up to which all are compared; more are divided further.
DIRECT_LIMIT = 512
#: Bits left over at which values that are still too many become a star.
STAR_BITS = 32
#: Pairs of values compared, and links held, before they are thinned out.
PAIR_BLOCK = 1 << 20
#: Values in an Arrow batch.
VALUE_ROWS = 100_000
#: Lines in a block of a large cluster.
TILE = 256
#: Words counted at a time.
WORD_BLOCK = 1 << 17
#: Logarithm of the bits in the bitmap of documents that hold a line to verify.
WANTED_BITS = 25
# Bits in a row of Spark's bitmap aggregates.
_BITMAP_ROW = 32_768

_MARK = re.compile(r"[^\w\n]|_")
_DIGIT = re.compile(r"\d")


def _latin1(c: str) -> str:
    return "0" if c.isdecimal() else c.lower() if c.isalnum() or c == "\n" else " "


_LATIN1 = "".join(map(_latin1, map(chr, range(256)))).encode("latin-1")


def _plain(text: str) -> str:
    """Lower case, every digit 0, a space for all else but letters and line ends."""
    if is_latin1(text):
        return text.encode("latin-1").translate(_LATIN1).decode("latin-1")
    return _MARK.sub(" ", _DIGIT.sub("0", text.lower()))


def normalised(line: str) -> list[str]:
    """Lower-case words of a line; every digit is 0."""
    return _plain(line).split()


def simhashes(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of each run of word hashes; ``ends`` are the runs' ends, no run empty."""
    out = np.zeros(len(ends), dtype=np.uint64)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    at = 0
    while at < len(ends):
        # whole runs of at most WORD_BLOCK words, or one longer run in parts
        upto = max(int(np.searchsorted(ends, starts[at] + WORD_BLOCK, "right")), at + 1)
        ones = np.zeros((upto - at, 64), dtype=np.int64)
        lo, hi = int(starts[at]), int(ends[upto - 1])
        for k in range(lo, hi, WORD_BLOCK):
            part = hashes[k : min(k + WORD_BLOCK, hi)]
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            if upto - at == 1:
                ones[0] += bits.sum(axis=0, dtype=np.int64)
            else:
                # eight counts of a byte each in a number, summed over 255 words at most
                sizes = ends[at:upto] - starts[at:upto]
                parts = -(-sizes // 255)
                turn = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                cuts = np.repeat(starts[at:upto] - lo, parts) + 255 * turn
                counts = np.add.reduceat(bits.view(np.uint64), cuts, axis=0).view(np.uint8)
                if len(counts) > upto - at:
                    counts = np.add.reduceat(counts, np.cumsum(parts) - parts, axis=0, dtype=np.int32)
                ones = counts
        half = (ends[at:upto] - starts[at:upto])[:, None] // 2
        out[at:upto] = np.packbits(ones > half, axis=1).view(">u8").reshape(-1).astype(np.uint64)
        at = upto
    return out


def line_simhashes(words: list[str], sizes: np.ndarray) -> np.ndarray:
    """SimHash of the distinct words of each line; ``words`` are those of all lines in
    order, ``sizes`` the lines' numbers of them, none zero."""
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    codes = coded.indices.to_numpy()
    place = np.empty(len(coded.dictionary), dtype=np.int64)
    place[codes] = np.arange(len(codes))  # of one of the words of each code
    known = b"".join([xxhash.xxh64_digest(words[i], 1) for i in place.tolist()])
    # each word once: in a long line the common words would outweigh all others and
    # make it like any long line
    line = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    own = np.sort(line << 32 | codes)
    own = own[np.concatenate(([True], own[1:] != own[:-1]))]
    ends = np.cumsum(np.bincount(own >> 32, minlength=len(sizes)))
    return simhashes(np.frombuffer(known, ">u8")[own & 0xFFFFFFFF], ends)


LINES = "doc_id long, text_key long, line int, key_hi long, key_lo long, simhash long"


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line that is not blank: its place, key and, from ``min_chars`` on, SimHash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, lines, keys, sizes, flat = [], [], [], [], [], []
            for doc_id, text_key, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").split("\n")
                for number, line in enumerate(_plain(text or "").split("\n")):
                    words = line.split()
                    plain = " ".join(words or raw[number].split())
                    if plain:
                        ids.append(doc_id)
                        texts.append(text_key)
                        lines.append(number)
                        keys.append(xxhash.xxh3_128_digest(plain))
                        if words and len(plain) >= min_chars:
                            flat += words
                            sizes.append(len(words))
                        else:
                            sizes.append(0)
            if ids:
                key = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
                sizes = np.array(sizes)
                prints = np.zeros(len(ids), dtype=np.int64)
                if flat:
                    prints[sizes > 0] = line_simhashes(flat, sizes[sizes > 0]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(lines, pa.int32()),
                     pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(prints, mask=sizes == 0)],
                    [x.split()[0] for x in LINES.split(", ")],
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t")
    )
    return rows.mapInArrow(work, LINES)


LINKS = "src long, dst long"


def _masks(bits: list[int], blocks: int, max_bits: int) -> list[int]:
    """The combinations of ``blocks - max_bits`` of the blocks that ``bits`` are cut into."""
    cuts = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[x:y]) for x, y in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(parts, blocks - max_bits)]


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links ``(a, b)`` between ``n`` nodes that connect what all of them do,
    less than ``n``."""
    root, kept, at = np.arange(n), [], np.arange(len(a))
    while True:
        one, two = root[a[at]], root[b[at]]
        apart = one != two
        at, one, two = at[apart], one[apart], two[apart]
        if not len(at):
            return np.concatenate([*kept, at])
        # every root that has a link to a lesser one takes one of them, so no circle arises
        high, first = np.unique(np.maximum(one, two), return_index=True)
        root[high] = np.minimum(one, two)[first]
        kept.append(at[first])
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above


def near_values(values: np.ndarray, mask: int, max_bits: int, blocks: int, direct_limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between distinct ``values`` that connect all pairs within ``max_bits`` that
    agree on the bits of ``mask``; only where over ``direct_limit`` values agree on all
    but ``STAR_BITS`` bits there are links between others too."""
    values = values[np.argsort(values & np.uint64(mask), kind="stable")]
    keys = values & np.uint64(mask)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else [])
    sizes = np.diff(np.append(starts, len(values)))
    free = [b for b in range(64) if not mask >> b & 1]
    many = sizes > direct_limit
    if many.any():
        large = np.repeat(many, sizes)
        if len(free) <= max(STAR_BITS, blocks):
            centre = np.repeat(starts, sizes)[large]
            own = np.flatnonzero(large)
            yield values[centre[centre != own]], values[own[centre != own]]
        else:
            for part in _masks(free, blocks, max_bits):
                yield from near_values(values[large], mask | part, max_bits, blocks, direct_limit)
    # each value with the next one of its run, the one after that, ...
    end = np.repeat(np.where(many, starts, starts + sizes), sizes)
    at, held, step = np.flatnonzero(end > np.arange(len(values)) + 1), [], 1

    def thinned() -> np.ndarray:
        pairs = np.concatenate(held, axis=1)
        return pairs[:, spanning(len(values), *pairs)]

    while len(at):
        for part in np.split(at, range(PAIR_BLOCK, len(at), PAIR_BLOCK)):
            close = part[np.bitwise_count(values[part] ^ values[part + step]) <= max_bits]
            held.append(np.stack([close, close + step]))
        if sum(p.shape[1] for p in held) > PAIR_BLOCK:
            held = [thinned()]
        step += 1
        at = at[end[at] > at + step]
    if held:
        src, dst = thinned()
        yield values[src], values[dst]


def clusters(values: DataFrame, max_bits: int, blocks: int, direct_limit: int = DIRECT_LIMIT) -> DataFrame:
    """Distinct ``values(simhash)`` → ``(node, component)`` of a graph that holds
    every pair within ``max_bits`` (and may hold more)."""
    spark = values.sparkSession
    masks = _masks(list(range(64)), blocks, max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = values.select("simhash", F.explode(F.array(*[F.lit(i) for i in range(len(masks))])).alias("part"))
    mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in signed]), F.col("part") + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in masks]
        for batch in batches:
            prints, part = (c.to_numpy() for c in batch.columns)
            for i, own in enumerate(held):
                own.append(prints[part == i].view(np.uint64))
        for i, own in enumerate(held):
            if own:
                own = np.concatenate(own)
                for src, dst in near_values(own, masks[i], max_bits, blocks, direct_limit):
                    for k in range(0, len(src), VALUE_ROWS):
                        some = [pa.array(x[k : k + VALUE_ROWS].view(np.int64)) for x in (src, dst)]
                        yield pa.RecordBatch.from_arrays(some, ["src", "dst"])

    # the values that agree on a combination meet in one task
    dealt = keyed.repartition(F.xxhash64("part", F.col("simhash").bitwiseAND(mask)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(VALUE_ROWS))
    try:
        near = materialize(dealt.mapInArrow(work, LINKS), "line-near")
    finally:
        prepare(spark)
    found = connected_components(near, "line-clusters")
    release(near)
    return found


def _bitmap(keys: DataFrame, key: Column) -> DataFrame:
    """``(n, bits)``: the bits of ``WANTED_BITS`` that the hashed ``key`` of a row sets."""
    at = F.pmod(key, F.lit(1 << WANTED_BITS)) + 1  # Spark's bitmap buckets begin at one
    return keys.groupBy(F.bitmap_bucket_number(at).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def _maybe(rows: DataFrame, key: Column, bitmap: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose bit is in ``bitmap``, where they are. It is broadcast:
    at most ``2 ** (WANTED_BITS - 3)`` bytes."""
    at = F.pmod(key, F.lit(1 << WANTED_BITS))
    place = F.pmod(at, F.lit(_BITMAP_ROW))
    octet = F.expr("conv(hex(substring(bits, _octet, 1)), 16, 10)").cast("int")
    out = rows.withColumn("_n", F.bitmap_bucket_number(at + 1)).withColumn("_octet", (F.floor(place / 8) + 1).cast("int"))
    out = out.withColumn("_bit", F.pmod(place, F.lit(8)).cast("int"))
    found = out.join(F.broadcast(bitmap), F.col("_n") == F.col("n"))
    return found.where(F.call_function("getbit", octet, F.col("_bit")) == 1).select(*rows.columns)


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by Myers' bit vectors in one long integer, so that a
    line of n characters costs n word-parallel steps."""
    if len(a) < len(b):
        a, b = b, a
    start = 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not b:
        return len(a)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        eq = peq.get(c, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        plus, minus = (down | ~(zero | up)) & full, up & zero
        score += (plus & last > 0) - (minus & last > 0)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
    return score


def similar(a: str, b: str, least: float) -> bool:
    longer = max(len(a), len(b))
    if abs(len(a) - len(b)) > (1 - least) * longer:
        return False
    # words replaced one for one change no more characters than they have
    one, two = a.split(" "), b.split(" ")
    if len(one) == len(two) and sum(max(len(x), len(y)) for x, y in zip(one, two) if x != y) <= (1 - least) * longer:
        return True
    return edit_distance(a, b) <= (1 - least) * longer


def _linked(uid: list[int], prints: np.ndarray, texts: list[str], block: np.ndarray, max_bits: int, least: float, across: bool):
    """``(src, dst)`` of a spanning star per group of similar lines of a tile; lines of
    one block meet in its own tile, so not in one ``across`` blocks."""
    root = list(range(len(uid)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in range(len(uid) - 1):
        close = np.bitwise_count(prints[x + 1 :] ^ prints[x]) <= max_bits
        if across:
            close &= block[x + 1 :] != block[x]
        for y in (np.flatnonzero(close) + x + 1).tolist():
            one, two = find(x), find(y)
            # pairs that are connected already change no group
            if one != two and similar(texts[x], texts[y], least):
                root[max(one, two)] = min(one, two)
    return [(uid[find(x)], uid[x]) for x in range(len(uid)) if find(x) != x]


def _verify(max_bits: int, least: float):
    """Rows ``cluster, i, j, block, uid, simhash, text`` sorted by tile and uid → links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[tuple]) -> list[tuple]:
            _, i, j = rows[0][:3]
            _, _, _, block, uid, prints, texts = zip(*rows)
            plain = [" ".join(normalised(t)) for t in texts]
            prints = np.array(prints, dtype=np.int64).view(np.uint64)
            return _linked(uid, prints, plain, np.array(block), max_bits, least, i != j)

        def out(found: list[tuple]) -> pa.RecordBatch:
            src, dst = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

        held: list[tuple] = []
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[-1][:3]:
                    found += solved(held)
                    held = []
                held.append(row)
            yield out(found)
        if held:
            yield out(solved(held))

    return work


def removed_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, text_key, removed``: the line numbers, from 0, that go, for each
    document that loses any (the least long stands for a null id). ``text_key`` is Spark's ``xxhash64`` of the text.

    Every line that is not blank goes if an equal one (normalised) comes before it;
    lines of at least ``min_chars`` normalised characters also if a similar one does.
    Repeated rows (equal id and text) are one document and lose the same lines. Null
    and empty texts have no lines. A null id sorts first. Ties in first
    occurrence do not arise between different documents. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    # a null id stands as the least number; its text tells it from a real one
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    docs = docs.select(number.alias("doc_id"), F.col(text_col).alias("text"))
    lines = materialize(line_keys(docs, "doc_id", "text", min_chars), "lines")
    place = F.struct("doc_id", "text_key", "line")
    distinct = materialize(
        lines.groupBy("key_hi", "key_lo", "simhash")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("uid"), "*"),
        "lines-distinct",
    )
    compared = distinct.where("simhash is not null")
    found = clusters(compared.select("simhash").distinct(), max_bits, blocks)
    # lines of a SimHash value of their own, near no other value, meet nobody
    clustered = compared.select("uid", "simhash", "first").join(
        found.withColumnRenamed("node", "simhash"), "simhash", "left"
    ).select("uid", "simhash", "first", F.coalesce("component", "simhash").alias("cluster"))
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(
        clustered.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("n") / TILE).cast("int")), "line-clusters"
    )
    # the text of a line is read from the document of its first occurrence
    wanted = met.groupBy("first.doc_id", "first.text_key").agg(
        F.collect_list(F.struct("uid", "simhash", "cluster", "blocks", F.col("first.line").alias("line"))).alias("wanted")
    )
    place_key = F.xxhash64("doc_id", "text_key")
    bitmap = materialize(_bitmap(met.select("first.doc_id", "first.text_key"), place_key), "line-wanted")
    picked = (
        _maybe(docs.withColumn("text_key", F.xxhash64("text")), place_key, bitmap)
        .join(wanted, ["doc_id", "text_key"])
        .dropDuplicates(["doc_id", "text_key"])
        .select(F.explode(F.get(F.transform(
            F.array(F.split("text", "\n")),
            lambda parts: F.transform("wanted", lambda w: F.struct(w.alias("w"), F.get(parts, w["line"]).alias("text"))),
        ), F.lit(0))).alias("x"))
        .select("x.w.*", "x.text")
    )
    # written, so that the documents' shuffle is gone before the lines' begins
    picked = materialize(picked, "line-texts", compression="zstd")
    tiles = picked.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")).withColumn(
        "k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    # a tile has about 2 * TILE lines; many tiles are one task
    tile = ["cluster", "i", "j"]
    links = (
        tiles.select("cluster", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "uid", "simhash", "text")
        .repartition(*tile)
        .sortWithinPartitions(*tile, "uid")
        .mapInArrow(_verify(max_bits, similarity), LINKS)
    )
    groups = connected_components(links, "line-links")
    # the first occurrence of each group, and of each line that repeats alone
    member = groups.select(F.col("node").alias("uid"), "component").union(
        groups.select(F.col("component").alias("uid"), "component").distinct()
    )
    grouped = distinct.join(member, "uid", "left").where("component is not null or n > 1")
    grouped = grouped.withColumn("component", F.coalesce("component", "uid"))
    keep = grouped.groupBy("component").agg(F.min("first").alias("keep"))
    verdict = materialize(grouped.join(keep, "component").select("key_hi", "key_lo", "keep"), "line-keep")
    gone = (
        lines.join(verdict, ["key_hi", "key_lo"])
        .where(place != F.col("keep"))
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("line")).alias("removed"))
    )
    out = materialize(gone, "lines-removed")
    release(lines, distinct, met, bitmap, picked, verdict)
    return out


def _with_removed(docs: DataFrame, removed: DataFrame, id_col: str, text_key: Column) -> DataFrame:
    mine = removed.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), F.col("removed").alias("_removed"))
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    return docs.join(mine, (number == F.col("_d")) & (text_key == F.col("_k")), "left").drop("_d", "_k")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with the same columns, the removed lines gone from ``text_col``.

    A document that loses every line keeps an empty text; a null text stays null.
    """
    joined = _with_removed(docs, removed_lines(docs, id_col, text_col, **limits), id_col, F.xxhash64(text_col))
    kept = F.get(
        F.transform(
            F.array(F.split(text_col, "\n")),
            lambda parts: F.array_join(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_removed")), lambda i: F.get(parts, i)
                ),
                "\n",
            ),
        ),
        F.lit(0),
    )
    text = F.when(F.col("_removed").isNull(), F.col(text_col)).otherwise(kept)
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` (line numbers) for every row of ``docs``."""
    # the texts stay where they are: what is asked of one is known before the join
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("_key"),
        F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)).cast("long").alias("n_lines"),
    )
    joined = _with_removed(narrow, removed_lines(docs, id_col, text_col, **limits), "doc_id", F.col("_key"))
    removed = F.coalesce("_removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))
