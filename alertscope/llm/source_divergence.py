"""Source divergence audit: chi-square like distances between the sources of a language.

Term counts per (language, source) become arrays of (term id, count), sorted by
id and cut into chunks of the language's terms, so that no array grows with the
corpus. Two groups' arrays of a chunk meet in one row per unordered pair of
sources. Its merge gallops through the longer array with blocks of the shorter
one and prices, both ways, the terms of both, the terms of one side only and the
terms of neither. Chunk prices add up to the pair's.

All arithmetic is on whole numbers. ``p`` is at most 10^9 + 1, so a squared
difference and the sum of all prices of a pair fit 64 bits.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare, release

#: Scale of p.
SCALE = 1_000_000_000
#: Kept terms in a chunk, on average; an array has at most about so many entries.
CHUNK_TERMS = 4096
#: Sources of a tile: the rows of one tile and chunk meet those of another in one place.
TILE_SOURCES = 64
#: Distinct (language, term) entries that a task sums before it sends them on.
FLUSH_TERMS = 500_000
#: Words whose places are looked for together in the longer array.
GALLOP_BLOCK = 256
# Letters A-Z go to a-z, bytes of characters beyond ASCII stay, all else separates.
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of UTF-8 ``text``, in order."""
    return text.translate(_FOLD).split()


def _partials(docs: DataFrame) -> DataFrame:
    """``(lang, term, df, sources, counts)``: one row per task and term, more for a
    task with many terms; ``df`` is the number of documents with the term."""

    def rows(tally: dict) -> Iterator[pa.RecordBatch]:
        for lang, (df, by_source) in tally.items():
            places = defaultdict(list)
            for source, counts in by_source.items():
                for term, n in counts.items():
                    places[term].append((source, n))
            terms = list(df)
            for k in range(0, len(terms), 20_000):
                some = terms[k : k + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(some), pa.string()),
                        pa.array([t.decode() for t in some], pa.string()),
                        pa.array([df[t] for t in some], pa.int64()),
                        pa.array([[s for s, _ in places[t]] for t in some], pa.list_(pa.string())),
                        pa.array([[n for _, n in places[t]] for t in some], pa.list_(pa.int64())),
                    ],
                    ["lang", "term", "df", "sources", "counts"],
                )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict = {}
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                df, by_source = tally.setdefault(lang, (Counter(), defaultdict(Counter)))
                words = terms_of(text)
                by_source[source].update(words)
                df.update(set(words))
            if sum(len(df) for df, _ in tally.values()) > FLUSH_TERMS:
                yield from rows(tally)
                tally = {}
        yield from rows(tally)

    return docs.mapInArrow(work, "lang string, term string, df long, sources array<string>, counts array<long>")


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a term with ``count`` of ``total`` occurrences over ``terms`` kept terms."""
    scaled = (count.cast("decimal(19,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, (total + terms).cast("decimal(19,0)")) + 1


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``share`` of many counts: a long division in steps of 1000, so that no
    product passes 64 bits."""
    below = np.int64(max(1, total + terms))  # no terms at all: nothing is priced
    quotient, rest = np.divmod(np.asarray(counts, dtype=np.int64) + 1, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        quotient = quotient * 1000 + digit
    return quotient + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values of two sorted arrays, in either array."""
    here, there, at = [], [], 0
    for k in range(0, len(short), GALLOP_BLOCK):
        block = short[k : k + GALLOP_BLOCK]
        at += int(np.searchsorted(long[at : at + 1], block[0]))  # past a lesser head
        step = 1
        while at + step < len(long) and long[at + step] < block[-1]:
            step *= 2
        window = long[at : at + step + 1]
        place = np.searchsorted(window, block)
        inside = np.flatnonzero(place < len(window))
        same = inside[window[place[inside]] == block[inside]]
        here.append(same + k)
        there.append(place[same] + at)
        at += int(place[-1])
    if not here:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(here), np.concatenate(there)


def merge_prices(a: tuple, b: tuple, terms: int, kept: int) -> tuple[int, int]:
    """Sums of f over a chunk of ``terms`` terms, from a's side and from b's.

    ``a`` and ``b`` are (sorted ids, counts, occurrences of the whole group);
    ``kept`` is the number of kept terms of the language.
    """
    (ids_a, counts_a, total_a), (ids_b, counts_b, total_b) = a, b
    p, q = shares(counts_a, total_a, kept), shares(counts_b, total_b, kept)
    p0, q0 = shares(np.zeros(1), total_a, kept), shares(np.zeros(1), total_b, kept)
    if len(ids_a) <= len(ids_b):
        i, j = gallop(ids_a, ids_b)
    else:
        j, i = gallop(ids_b, ids_a)
    only_a, only_b = np.ones(len(p), dtype=bool), np.ones(len(q), dtype=bool)
    only_a[i], only_b[j] = False, False
    neither = terms - len(p) - len(q) + len(i)
    out = []
    for way in (lambda x, y: price(x, y), lambda x, y: price(y, x)):
        total = int(way(p[i], q[j]).sum()) + int(way(p[only_a], q0).sum()) + int(way(p0, q[only_b]).sum())
        out.append(total + neither * int(way(p0, q0)[0]))
    return out[0], out[1]


def _pair_prices(pairs: DataFrame) -> DataFrame:
    """Rows of two arrays → ``(lang, a, b, ab, ba)``, the chunk's prices."""

    def side(column: pa.ListArray, row: int) -> tuple[np.ndarray, np.ndarray]:
        entries = column[row].values
        if entries is None:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return entries.field("id").to_numpy(zero_copy_only=False), entries.field("n").to_numpy(zero_copy_only=False)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            plain = {n: of[n].to_pylist() for n in ("n_a", "n_b", "terms", "kept")}
            prices = [
                merge_prices(
                    (*side(of["x"], r), plain["n_a"][r]), (*side(of["y"], r), plain["n_b"][r]),
                    plain["terms"][r], plain["kept"][r],
                )
                for r in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [of["lang"], of["a"], of["b"], *(pa.array([v[k] for v in prices], pa.int64()) for k in (0, 1))],
                ["lang", "a", "b", "ab", "ba"],
            )

    return pairs.mapInArrow(work, "lang string, a string, b string, ab long, ba long")


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if most is None else out.where(F.col("rank") <= most)


def divergence_audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 3,
    top_terms: int = 200,
    chunk_terms: int = CHUNK_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` ranks the other
    sources of the language by their distance, part ``term`` the ``top_terms`` terms
    that stand out in the source against its language.

    A term is a run of ASCII letters (lower-cased) and characters beyond ASCII; a
    language keeps those in at least ``min_docs`` of its documents. Null text,
    language and source are the empty string. Ties go by the item's bytes. Repeated
    rows count as often as they occur. A group without terms has its rows of part
    ``pair`` like any other (0 where the language keeps no term at all); an empty
    table gives an empty result. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    # one shuffle, by term, for the document counts and for the counts of the sources
    of_term = Window.partitionBy("lang", "term")
    counts = materialize(
        _partials(rows)
        .withColumn("docs", F.sum("df").over(of_term))
        .where(F.col("docs") >= min_docs)
        .select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
        .groupBy("lang", "term", F.col("e.sources").alias("source"))
        .agg(F.sum("e.counts").alias("n")),
        "divergence-counts",
    )
    groups = materialize(
        rows.select("lang", "source")
        .distinct()
        .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")),
        "divergence-groups",
    )
    kept = materialize(counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang")), "divergence-terms")
    langs = materialize(
        groups.groupBy("lang")
        .agg(F.count("*").alias("n_sources"))
        .join(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total_lang")), "lang", "left")
        .select(
            "lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("total_lang", F.lit(0)).alias("total_lang"),
            F.greatest(F.lit(1), F.ceil(F.col("kept") / chunk_terms)).alias("chunks"),
            F.ceil(F.col("n_sources") / tile_sources).alias("tiles"),
        ),
        "divergence-langs",
    )
    placed = kept.join(langs, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), "chunks"))
    by_chunk = Window.partitionBy("lang", "chunk").orderBy("term")
    ids = materialize(
        placed.withColumn("id", F.row_number().over(by_chunk)).select(
            "lang", "term", "chunk", "id", "n_lang", "kept", "total_lang"
        ),
        "divergence-ids",
    )
    sizes = ids.groupBy("lang", "chunk").agg(F.count("*").alias("terms"))
    numbered = materialize(counts.join(ids, ["lang", "term"]), "divergence-numbered")

    arrays = numbered.groupBy("lang", "source", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries")
    )
    grid = (
        groups.join(langs, "lang")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .join(arrays, ["lang", "source", "chunk"], "left")
        .join(sizes, ["lang", "chunk"], "left")
        .select(
            "lang", "source", "chunk", "total", "kept", F.coalesce("terms", F.lit(0)).alias("terms"), "entries",
            F.pmod(F.xxhash64("source"), "tiles").alias("tile"),
            F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1).alias("others"),
        )
    )
    blocks = materialize(grid, "divergence-blocks")
    met = blocks.withColumn("other", F.explode("others")).select(
        "*", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    )
    key = ["lang", "chunk", "low", "high"]
    a = met.select(*key, F.col("source").alias("a"), F.col("tile").alias("tile_a"), F.col("total").alias("n_a"),
                   "terms", "kept", F.col("entries").alias("x"))
    b = met.select(*key, F.col("source").alias("b"), F.col("tile").alias("tile_b"), F.col("total").alias("n_b"),
                   F.col("entries").alias("y"))
    pairs = (
        a.join(b, key)
        .where("a < b and least(tile_a, tile_b) = low and greatest(tile_a, tile_b) = high")
        .select("lang", "a", "b", "n_a", "n_b", "terms", "kept", "x", "y")
    )
    sums = _pair_prices(pairs).groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))
    ways = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")),
    )
    between = _ranked(sums.select("lang", F.explode(ways).alias("w")).select("lang", "w.*"))

    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("n_lang"), F.col("total_lang"), F.col("kept"))
    told = (
        numbered.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    result = materialize(
        between.withColumn("part", F.lit("pair"))
        .select(*columns)
        .union(_ranked(told, top_terms).withColumn("part", F.lit("term")).select(*columns)),
        "divergence",
    )
    release(counts, groups, kept, langs, ids, numbered, blocks)
    return result
