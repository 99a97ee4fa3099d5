"""Language identification by cross-parsing entropy.

A suffix automaton holds every substring of a language's labelled text. A
document is parsed against it: the longest match from where the last one ended
is the next phrase, a symbol that the text does not have is a phrase of its own.
Phrases times the logarithm of the labelled text's length, per symbol, estimate
the bits the document costs in that language; the cheapest language wins.

Documents are parsed in segments of ``SEGMENT`` symbols from a fresh start, the
same for every language. The segments of many documents advance side by side
through the automata of all languages, one numpy step per symbol.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertscope.llm.common import prepare
from alertscope.llm.double_array import DoubleArray, double_array

#: Bounds of the labelled sample: texts of a language, characters of one text and of all.
FIT_TEXTS, FIT_TEXT_CHARS, FIT_CHARS = 128, 4096, 65_536
#: Parts of the table whose least hashes are found on their own.
PARTS = 256
#: Every ``FOLDS``-th row by the crc32 of its id is held out.
FOLDS = 5
#: Symbols that are parsed from a fresh start, and how many segments advance together.
SEGMENT, SEGMENTS = 512, 4096
#: Characters of a text that are turned into symbols at a time.
BLOCK = 1 << 20
UNKNOWN_LANG = "und"
# Symbols. The end of a segment, a run of anything but letters, a
# letter that no labelled text has; then the letters.
END, GAP, STRANGE, FIRST = 0, 1, 2, 3


def _is_letter(char: str) -> bool:
    return char.isalpha() or unicodedata.category(char).startswith("M")


@dataclass(frozen=True)
class Symbols:
    """Symbol of every code point: letters fold to lower case, marks count as letters."""

    table: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "Symbols":
        letters = sorted({c.lower()[0] for t in texts for c in set(t) if _is_letter(c)})
        codes = {c: FIRST + i for i, c in enumerate(letters)}
        table = np.full(0x110000, GAP, dtype=np.int32)
        for point in range(0x110000):
            char = chr(point)
            if _is_letter(char):
                table[point] = codes.get(char.lower()[0], STRANGE)
        return cls(table)

    @property
    def width(self) -> int:
        return max(FIRST, int(self.table.max()) + 1)

    def encode(self, text: str) -> np.ndarray:
        """Symbols of ``text``, a run of non-letters as one gap."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out = self.table[points]
        again = np.zeros(len(out), dtype=bool)
        again[1:] = (out[1:] == GAP) & (out[:-1] == GAP)
        return out[~again]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state, state 0 first; a walk spells the substrings."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at, last = last, new
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at < 0:
            continue
        old = moves[at][c]
        if length[old] == length[at] + 1:
            link[new] = old
            continue
        split = len(moves)
        moves.append(dict(moves[old]))
        link.append(link[old])
        length.append(length[at] + 1)
        link[old] = link[new] = split
        while at >= 0 and moves[at].get(c) == old:
            moves[at][c] = split
            at = link[at]
    return moves


@dataclass(frozen=True)
class CrossParser:
    """Automata of all languages in one double array, a root state for each."""

    langs: list[str]
    symbols: Symbols
    roots: np.ndarray
    bits: np.ndarray  # of a phrase: the logarithm of the labelled text's length
    moves: DoubleArray
    after_root: np.ndarray  # [language, symbol] → state after a phrase that begins with it
    unseen: np.ndarray  # [language, symbol] → the labelled text does not have it

    @classmethod
    def fit(cls, samples: dict[str, list[str]]) -> "CrossParser":
        langs = sorted(samples)
        symbols = Symbols.of([t for ts in samples.values() for t in ts])
        edges, roots, bits, states = [], [], [], 0
        for lang in langs:
            # texts follow each other with a gap between them
            text = symbols.encode(" ".join(samples[lang]))
            moves = suffix_automaton(text.tolist())
            edges += [(s + states, c, t + states) for s, m in enumerate(moves) for c, t in m.items()]
            roots.append(states)
            bits.append(np.log2(max(2, len(text))))
            states += len(moves)
        parent, code, child = np.array(edges, dtype=np.int64).reshape(-1, 3).T.astype(np.int32)
        array = double_array(parent, code, child, states, symbols.width)
        first, alphabet = np.array(roots, dtype=np.int32)[:, None], np.arange(symbols.width, dtype=np.int32)[None, :]
        hit, after = array.advance(np.broadcast_to(first, (len(langs), symbols.width)), alphabet)
        return cls(langs, symbols, first[:, 0], np.array(bits), array, np.where(hit, after, first), ~hit)

    def phrases(self, segments: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each segment in each language: [language, segment]."""
        order = sorted(range(len(segments)), key=lambda i: -len(segments[i]))
        lengths = np.array([len(segments[i]) for i in order])
        grid = np.zeros((SEGMENT, len(segments)), dtype=np.int32)
        for column, i in enumerate(order):
            grid[: len(segments[i]), column] = segments[i]
        root = self.roots[:, None]
        state = np.repeat(root, len(segments), axis=1)
        count = np.zeros(state.shape, dtype=np.int32)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -step))  # segments longer than this step
            c, at = grid[step, :live], state[:, :live]
            hit, after = self.moves.advance(at, c)
            miss = ~hit
            count[:, :live] += (miss & (at != root)).astype(np.int32) + (miss & self.unseen[:, c])
            state[:, :live] = np.where(hit, after, self.after_root[:, c])
        count += state != root  # the last phrase
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def costs(self, texts: list[str]) -> np.ndarray:
        """Bits a symbol of each text in each language: [text, language]."""
        counts, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        waiting: list[np.ndarray] = []
        owner: list[int] = []

        def parse() -> None:
            np.add.at(counts, np.array(owner, dtype=np.int64), self.phrases(waiting).T)
            waiting.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for k in range(0, len(text), BLOCK):
                codes = self.symbols.encode(text[k : k + BLOCK])
                sizes[i] += len(codes)
                for j in range(0, len(codes), SEGMENT):
                    waiting.append(codes[j : j + SEGMENT])
                    owner.append(i)
                    if len(waiting) == SEGMENTS:
                        parse()
        if waiting:
            parse()
        return counts * self.bits / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text: the runner-up's share of the two least
        costs (0.5 for a tie, which goes to the first name; 1 if there is one language)."""
        langs, scores = [UNKNOWN_LANG] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if self.langs and t and any(map(str.isalpha, t))]
        costs = self.costs([texts[i] for i in known])
        for i, cost in zip(known, costs):
            best = int(np.argmin(cost))
            others = np.delete(cost, best)
            langs[i] = self.langs[best]
            scores[i] = float(others.min() / (others.min() + cost[best])) if len(others) else 1.0
        return langs, scores


def labelled_sample(docs: DataFrame, texts: int = FIT_TEXTS, text_chars: int = FIT_TEXT_CHARS, chars: int = FIT_CHARS) -> dict[str, list[str]]:
    """Bounded labelled text per language of ``docs(lang, text)``: the first
    ``text_chars`` characters of the ``texts`` distinct texts of least hash, up to
    ``chars`` characters in all."""
    hashed = docs.where("lang is not null and text is not null").select("lang", F.xxhash64("text").alias("h"), "text")
    # hashes alone are ranked, each once: of a part of the table first, then of the rest
    ranked = hashed.select("lang", "h").distinct().withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("h")
        ranked = ranked.withColumn("r", F.row_number().over(first)).where(F.col("r") <= texts)
    # smaller than the sample, which the driver holds: ``texts`` hashes per language
    found = (
        hashed.join(F.broadcast(ranked.select("lang", "h", "r")), ["lang", "h"])
        .groupBy("lang", "r")
        .agg(F.min(F.substring("text", 1, text_chars)).alias("text"))
    )
    out: dict[str, list[str]] = {}
    for row in sorted(found.collect(), key=lambda x: (x["lang"], x["r"])):
        taken = out.setdefault(row["lang"], [])
        room = chars - sum(map(len, taken))
        if room > 0:
            taken.append(row["text"][:room])
    return out


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fit_texts: int = FIT_TEXTS,
    fit_text_chars: int = FIT_TEXT_CHARS,
    fit_chars: int = FIT_CHARS,
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``.

    Labels are learned from rows that are not held out and have a language; the
    sample is bounded by ``fit_texts``, ``fit_text_chars`` and ``fit_chars``. A text
    that is null or has no letter is ``und`` with score 0, and so is every text if
    there is nothing to learn from. Rows without an id are held out. Repeated rows
    are predicted alike; an empty table gives an empty result. Whole texts are
    parsed, however long. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0).alias("held_out"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    )
    sample = labelled_sample(rows.where("not held_out"), fit_texts, fit_text_chars, fit_chars)
    shared = spark.sparkContext.broadcast(CrossParser.fit(sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        work, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
