"""Exact repeated-substring removal by bounded interval expansion on a BWT.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else
too. Comparing all suffixes of a corpus in one place is out of the question, so
equal strings are first brought together:

* Every window of ``length`` bytes has an anchor, its gram of ``GRAM`` bytes of
  least hash (the leftmost of equals). Equal windows have equal anchors. The
  windows of one anchor occurrence span one short region of text.
* Regions whose anchor occurs once hold no repeat. Equal regions collapse to
  one with a count: all windows of a region that occurs twice repeat.
* What is left is sorted by anchor and cut into batches of bounded size, and
  each batch is one text. Its Burrows-Wheeler transform is expanded breadth
  first: intervals of suffixes are extended backwards by one byte at a time, so
  the common prefixes of neighbouring suffixes come out in increasing value,
  and the expansion stops at ``length``. Neighbours still not told apart then
  share ``length`` bytes.
* An anchor with more regions than ``GROUP`` is dealt over several batches. One
  occurrence of each different window of a batch goes on to a further round,
  keyed by the bytes that all windows of its cell share; a cell is a range of
  distances from window start to anchor. Cells shrink from round to round, until
  groups are small or a cell is one window and the key is the window itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare, release

LENGTH = 400
GRAM = 128
#: Regions of one anchor that are compared in one batch at most.
GROUP = 256
#: Bytes of text in a batch.
BATCH_BYTES = 1 << 20
#: Widths of the cells of the further rounds.
CELLS = (64, 16, 4, 1)
#: Documents' bytes hashed at a time.
CHUNK = 1 << 22

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FINISH = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` bytes of ``data``, by prefix sums."""
    n = len(data) - gram + 1
    with np.errstate(over="ignore"):
        terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(data))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        h = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n)
        h = (h ^ (h >> np.uint64(32))) * _FINISH
        return h ^ (h >> np.uint64(32))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value in each run of ``width`` values."""
    n = len(values)
    # the position breaks ties in the lowest bits that a run needs
    bits = np.uint64(max(1, int(2 * width - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    out = np.empty(n - width + 1, dtype=np.int64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, ~np.uint64(0))
    # ties between values that differ only in the dropped bits go by position too,
    # which depends on the window's bytes alone
    padded[:n] = values | low
    grid = padded.reshape(blocks, width)
    place = np.arange(width, dtype=np.uint64)
    left = np.minimum.accumulate((grid & ~low) | place, axis=1).reshape(-1)
    right = np.minimum.accumulate(((grid & ~low) | place)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    start = np.arange(n - width + 1)
    tail, head = right[start], left[start + width - 1]
    tail_at = (start // width) * width + (tail & low).astype(np.int64)
    head_at = ((start + width - 1) // width) * width + (head & low).astype(np.int64)
    np.copyto(out, np.where((tail & ~low) <= (head & ~low), tail_at, head_at))
    return out


def regions(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, anchor position, first window, last window)`` per anchor
    occurrence. Each window start belongs to exactly one."""
    if len(data) < length:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    hashes = gram_hashes(data, gram)
    at = sliding_argmin(hashes, length - gram + 1)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return hashes[at[first]], at[first], first, last


REGIONS = "anchor long, same long, doc_id long, text_key long, first int, windows int, ahead int"


def region_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The regions of ``docs(doc_id, text_key, data)``; ``same`` is a hash of the
    region's bytes, ``ahead`` the bytes before its anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, text_key, data in zip(*(c.to_pylist() for c in batch.columns)):
                # overlapping chunks: each window lies in one of them whole
                for base in range(0, max(len(data) - length + 1, 0), CHUNK):
                    view = data[base : base + CHUNK + length - 1]
                    anchor, at, first, last = regions(np.frombuffer(view, np.uint8), length, gram)
                    spans = zip(first.tolist(), last.tolist())
                    out[0] += anchor.view(np.int64).tolist()
                    out[1] += [xxhash.xxh3_64_intdigest(view[a : b + length]) - (1 << 63) for a, b in spans]
                    out[2] += [doc_id] * len(first)
                    out[3] += [text_key] * len(first)
                    out[4] += (first + base).tolist()
                    out[5] += (last - first + 1).tolist()
                    out[6] += (at - first).tolist()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            names = [x.split()[0] for x in REGIONS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return docs.mapInArrow(work, REGIONS)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` symbols, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1] + 1
    # the first symbols at once, as many as a key holds; past the end is 0
    bits = int(rank.max()).bit_length()
    span = max(1, 62 // bits)
    symbol = rank
    for k in range(1, span):
        rank = rank << bits
        rank[: n - k] |= symbol[k:]
    order = np.argsort(rank)
    new = np.empty(n, dtype=np.int64)
    new[order] = np.concatenate(([0], np.cumsum(rank[order][1:] != rank[order][:-1])))
    rank = new
    while span < depth and rank[order[-1]] != n - 1:
        after = np.zeros(n, dtype=np.int64)
        after[: n - span] = rank[span:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank, span = new, span * 2
    return order


def common_prefix_breaks(text: np.ndarray, order: np.ndarray, stop: int) -> np.ndarray:
    """For each rank, whether its suffix differs from the one before it within
    the first ``stop`` symbols.

    Breadth-first backward extension on the transform of ``order``. At level v
    the known breaks have common prefixes of less than v symbols. A break found
    at level v splits an interval of suffixes that share v symbols; preceding both
    sides by the same symbol gives two suffixes that share v + 1, so the break is
    carried to the first suffix, from the break on, of each preceding symbol
    that also precedes a suffix before the break.
    """
    n = len(text)
    before = text[order - 1]  # order - 1 is -1 for the first suffix: the last symbol precedes it
    lf = np.empty(n, dtype=np.int64)
    by_symbol = np.argsort(before, kind="stable")
    lf[by_symbol] = np.arange(n)
    # the previous rank with the same preceding symbol
    previous = np.full(n, -1, dtype=np.int64)
    same = before[by_symbol][1:] == before[by_symbol][:-1]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    first = text[order]
    broken = np.concatenate(([True], first[1:] != first[:-1]))  # level 0: the empty prefix
    new = np.flatnonzero(broken)
    # all breaks known, the late few apart, each list closed by n
    known, late = np.append(new, n), np.array([n])
    for _ in range(1, stop):
        if not len(new):
            break
        # the ranks from each new break to the next known break
        end = known[np.searchsorted(known, new, "right")]
        sizes = np.minimum(end, late[np.searchsorted(late, new, "right")]) - new
        rows = np.repeat(new - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        starts = np.repeat(new, sizes)
        hit = rows[(previous[rows] < starts) & (previous[rows] >= 0)]
        hit = lf[hit]
        hit = hit[~broken[hit]]
        if len(hit) > n >> 6:  # many: mark them, else sort them
            found = np.zeros(n, dtype=bool)
            found[hit] = True
            new = np.flatnonzero(found)
        else:
            new = np.unique(hit)
        broken[new] = True
        if len(late) + len(new) > n >> 5:
            known, late = np.append(np.flatnonzero(broken), n), np.array([n])
        else:
            late = np.sort(np.concatenate((late, new)))
    return broken


def repeated_starts(pieces: list[bytes], windows: list[int], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each piece, which of its first ``windows`` starts begin a string of
    ``length`` bytes that another of all these starts begins too, and which are the
    first to begin theirs."""
    # every piece ends in a separator of its own, so no common prefix crosses one
    sizes = np.array([len(p) for p in pieces])
    text = np.empty(int(sizes.sum()) + len(pieces), dtype=np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    for k, (at, p) in enumerate(zip(begin.tolist(), pieces)):
        text[at : at + len(p)] = np.frombuffer(p, np.uint8)
        text[at + len(p)] = 256 + k
    order = suffix_order(text, length)
    group = np.empty(len(text), dtype=np.int64)
    group[order] = np.cumsum(common_prefix_breaks(text, order, length)) - 1
    asked = group[np.concatenate([np.arange(a, a + w) for a, w in zip(begin.tolist(), windows)])]
    many = np.bincount(asked, minlength=len(text))[asked] > 1
    first = np.zeros(len(asked), dtype=bool)
    first[np.unique(asked, return_index=True)[1]] = True
    cuts = np.cumsum(windows)[:-1]
    return list(zip(np.split(many, cuts), np.split(first, cuts)))


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


FOUND = (
    "anchor long, same long, lo int, hi int, rest boolean, key long, part long, bytes binary, ahead int, known boolean"
)


def _expand(length: int, batch_bytes: int, cell: int):
    """Rows sorted by group → runs of repeated windows, and, for groups that were
    dealt out, the cells of the windows that go on to the next round.

    A row is ``anchor, same, slot, lo, dealt, bytes, windows, ahead, known``: the
    windows from ``lo`` on of a region, their bytes, the bytes before the anchor,
    and whether all of them are known to repeat.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[tuple]) -> pa.RecordBatch:
            out: list[list] = [[] for _ in range(10)]

            def put(*row) -> None:
                for column, value in zip(out, row):
                    column.append(value)

            flags = repeated_starts([r[5] for r in rows], [r[6] for r in rows], length)
            for (anchor, same, _, lo, dealt, data, _, ahead, known), (many, first) in zip(rows, flags):
                for a, b in () if known else runs(many):
                    put(anchor, same, lo + a, lo + b, False, None, None, None, None, None)
                for a, b in runs(first) if dealt else ():
                    while a < b:
                        # distances ahead - a down to ahead - b + 1; a cell is a
                        # range of distances, the same for equal windows
                        number = (ahead - a) // cell
                        end = min(b, ahead - number * cell + 1)
                        near, far = number * cell, number * cell + cell - 1
                        shared = data[ahead - near : max(ahead - far + length, 0)]
                        whole = data[a : end - 1 + length]
                        put(anchor, same, lo + a, lo + end, True,
                            xxhash.xxh3_64_intdigest(shared, number) - (1 << 63),
                            xxhash.xxh3_64_intdigest(whole, 7) - (1 << 63), whole, ahead - a, known)
                        a = end
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(),
                     pa.int32(), pa.bool_())
            names = [x.split()[0] for x in FOUND.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

        held: list[tuple] = []
        size, group = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                # a batch ends between groups only
                if size > batch_bytes and row[2] != group:
                    yield solved(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5]) + 1
                group = row[2]
        if held:
            yield solved(held)

    return work


def repeated_windows(docs: DataFrame, length: int, gram: int, group: int, batch_bytes: int) -> DataFrame:
    """``doc_id, text_key, lo, hi``: runs of window starts (hi excluded) that repeat
    in ``docs(doc_id, text_key, data)``, none of them null."""
    rows = materialize(region_rows(docs, length, gram), "regions")
    classes = rows.groupBy("anchor", "same").agg(
        F.count("*").alias("n"), F.max("windows").alias("windows"), F.max("ahead").alias("ahead"),
        F.min(F.struct("doc_id", "text_key", "first")).alias("at"),
    )
    groups = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.sum("n").alias("total"))
    busy = materialize(classes.join(groups.where("total > 1").drop("total"), "anchor"), "region-classes")
    whole = busy.where("n > 1").select("anchor", "same", F.lit(0).alias("lo"), F.col("windows").alias("hi"))
    # the bytes of one region of each class that shares its anchor with another
    wanted = (
        busy.where("classes > 1")
        .groupBy("at.doc_id", "at.text_key")
        .agg(F.collect_list(F.struct(
            "anchor", "same", "classes", "windows", "ahead", F.col("at.first").alias("first"), (F.col("n") > 1).alias("known")
        )).alias("w"))
    )
    todo = (
        docs.join(wanted, ["doc_id", "text_key"])
        .dropDuplicates(["doc_id", "text_key"])
        .select("data", F.explode("w").alias("w"))
        .select(
            "w.anchor", "w.same", F.col("w.anchor").alias("key"), F.lit(0).alias("lo"), "w.classes", "w.windows", "w.ahead",
            "w.known", F.substring("data", F.col("w.first") + 1, F.col("w.windows") + (length - 1)).alias("bytes"),
        )
    )
    found, used = [whole], []
    for cell in CELLS:
        dealt = F.col("classes") > group
        turn = F.when(dealt, F.pmod(F.xxhash64("same", "lo"), F.ceil(F.col("classes") / group))).otherwise(F.lit(0))
        ordered = todo.select(
            "anchor", "same", F.xxhash64("key", turn).alias("slot"), "lo", dealt.alias("dealt"), "bytes", "windows",
            "ahead", "known",
        ).repartition("slot").sortWithinPartitions("slot")
        out = materialize(ordered.mapInArrow(_expand(length, batch_bytes, cell), FOUND), "region-runs")
        used.append(out)
        found.append(out.where("not rest").select("anchor", "same", "lo", "hi"))
        rest = out.where("rest")
        if rest.isEmpty():
            break
        # equal ranges collapse; all windows of a range that occurs twice repeat
        ranges = rest.groupBy("key", "part").agg(
            F.count("*").alias("n"), F.min(F.struct("anchor", "same", "lo")).alias("at")
        )
        again = ranges.where("n > 1").select("key", "part")
        found.append(rest.where("not known").join(again, ["key", "part"]).select("anchor", "same", "lo", "hi"))
        crowd = ranges.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1")
        todo = (
            ranges.join(crowd, "key")
            .select("at.*", "key", "classes", (F.col("n") > 1).alias("twice"))
            .join(rest.drop("part"), ["anchor", "same", "lo", "key"])
            .select("anchor", "same", "key", "lo", "classes", "bytes", (F.col("hi") - F.col("lo")).alias("windows"),
                    "ahead", (F.col("known") | F.col("twice")).alias("known"))
        )
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    placed = rows.join(spans, ["anchor", "same"]).select(
        "doc_id", "text_key", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi")
    )
    result = materialize(placed, "repeated-windows")
    release(rows, busy, *used)
    return result


def _cut(length: int, with_text: bool):
    """Remove the covered bytes; count, and hash what is left."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = batch.num_columns - 2
            sizes, removed, spans, hashes, texts = [], [], [], [], []
            for data, windows in zip(batch.column(keep).to_pylist(), batch.column(keep + 1).to_pylist()):
                data = data or b""
                merged: list[list[int]] = []
                for lo, hi in sorted((w["lo"], w["hi"]) for w in windows or ()):
                    end = hi - 1 + length  # the last window's end
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([lo, end])
                parts, at = [], 0
                for a, b in merged:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                left = b"".join(parts)
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                spans.append(len(merged))
                hashes.append(hashlib.sha256(left).hexdigest())
                # a cut inside a character leaves no valid text: its remains go too
                texts.append(b"".join(p.decode("utf-8", "ignore").encode() for p in parts).decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(hashes, pa.string()), pa.array(texts, pa.string())],
                [*batch.schema.names[:keep], "_n_bytes", "_n_removed", "_n_spans", "_kept_sha256", "_kept_text"],
            )

    return work


def _cut_documents(
    docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, group: int, batch_bytes: int, with_text: bool
) -> DataFrame:
    prepare(docs.sparkSession)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # a null id stands as the least number; its text tells it from a real one
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    windows = repeated_windows(
        docs.select(key.alias("doc_id"), F.xxhash64(data).alias("text_key"), data.alias("data")),
        length, gram, group, batch_bytes,
    )
    listed = windows.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("lo", "hi")).alias("_windows"))
    listed = listed.withColumnsRenamed({"doc_id": "_d", "text_key": "_k"})
    same = (key == F.col("_d")) & (F.xxhash64(data) == F.col("_k"))
    joined = docs.join(listed, same, "left").select(*docs.columns, data.alias("_data"), "_windows")
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return joined.mapInArrow(
        _cut(length, with_text),
        f"{fields}, _n_bytes long, _n_removed long, _n_spans long, _kept_sha256 string, _kept_text string",
    )


def repeat_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    Texts are their UTF-8 bytes, null an empty one. Matches lie within one document
    each; a string that overlaps its other occurrence counts. Repeated rows are
    occurrences of their own, so of a repeated row every window repeats. A null
    id is an id. An empty table gives no rows; other columns are ignored.
    """
    cut = _cut_documents(docs.select(id_col, text_col), id_col, text_col, length, gram, group, batch_bytes, False)
    return cut.select(
        F.col(id_col).alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.col("_kept_sha256").alias("kept_sha256"),
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``docs`` with the same columns, repeated strings cut from ``text_col``. A
    character that is cut in part goes whole; a null text stays null."""
    cut = _cut_documents(docs, id_col, text_col, length, gram, group, batch_bytes, True)
    text = F.when(F.col(text_col).isNull(), F.lit(None)).otherwise(F.col("_kept_text"))
    return cut.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
