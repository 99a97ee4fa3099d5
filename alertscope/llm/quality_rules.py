"""Quality rules as a short-circuit cascade, DataFrame functions only.

A document first meets the base rules (length, repetition). The further rules
are independent predicates that each reject a document. On a bounded sample
each rule's time is measured and the patterns of rules that reject are
counted; the rules then run in the order of rejection per cost, conditional
on what earlier rules left, and a document stops at its first rejection.
The order decides which rule is named, never whether a document is kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The symbols and limits of the base measures.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Rows of the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 1000
#: Share of rows drawn, partition by partition, until the sample is full.
SAMPLE_SHARE = 0.05


@dataclass(frozen=True)
class Rule:
    """``rejects(text, measures)`` is true for a document to reject."""

    name: str
    rejects: Callable[[Column, dict[str, Column]], Column]


def _share(text: Column, pattern: str) -> Column:
    """Code points that the pattern removes, over all code points."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))) / F.greatest(
        F.char_length(text), F.lit(1)
    )


#: The limits hold for any language: they look at marks, letter case, line
#: shape and word length, not at vocabulary.
DEFAULT_RULES = (
    Rule("symbols", lambda t, m: m["n_symbols"] * 10 > m["n_words"]),
    Rule("word_length", lambda t, m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
    Rule("duplicate_lines", lambda t, m: m["n_dup_lines"] * 10 > m["n_lines"] * 3),
    Rule("upper_case", lambda t, m: _share(t, r"\p{Lu}+") > 0.4),
    Rule("exclamation", lambda t, m: _share(t, r"[!?]+") > 0.05),
    Rule("letters", lambda t, m: _share(t, r"[\p{L}\p{M}]+") < 0.5),
    Rule(
        "ellipsis_lines",
        lambda t, m: F.size(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"(\.\.\.|…)\s*$"))) * 10
        > m["n_lines"] * 3,
    ),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _n_repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more.

    A text whose window hashes are all distinct repeats nothing. Otherwise the
    windows are sorted by (hash, start) and neighbours compared word by word;
    the covered words are summed over the sorted starts. A text of n words
    costs n log n in its own row, and no shuffle.
    """
    at = lambda i: F.get(words, i)
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(
        F.array().cast("array<int>")
    )

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for k in range(3):
            equal = equal & (at(x["i"] + k) == at(y["i"] + k))
        return F.coalesce(equal, F.lit(False))

    def covered(s: Column) -> Column:
        repeated = F.filter(s, lambda x, j: same(x, F.get(s, j + 1)) | same(x, F.get(s, j - 1)))
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["i"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct(
                (acc["n"] + F.least(F.lit(3), p - acc["last"])).cast("long").alias("n"), p.alias("last")
            ),
            lambda acc: acc["n"],
        )

    def counted(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0).cast("long")).otherwise(_let(windows, covered))

    return _let(F.transform(starts, lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))), counted)


def _measured(text: Column) -> Column:
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    lines = F.split(text, "\n")
    return _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{SYMBOLS}]+", "")))
            .cast("long")
            .alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            _let(
                F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            ).alias("n_dup_lines"),
            _n_repeat_words(w).alias("n_repeat_words"),
        ),
    )


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``,
    ``n_dup_lines`` and ``n_repeat_words`` (all long) to ``docs``.

    Null text counts as empty. The measures leave through a generator, so that
    a later filter on them is not pushed below it and computed again.
    """
    return docs.select("*", F.inline(F.array(_let(F.coalesce(F.col(text_col), F.lit("")), _measured))))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _measures() -> dict[str, Column]:
    return {n: F.col(n) for n in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")}


def order_by_rejection_per_cost(costs: list[float], patterns: dict[int, int]) -> list[int]:
    """Greedy order: next comes the rule that rejects most of the sample rows
    still alive per second. ``patterns`` counts rows by the bit set of rules that
    reject them. Rules that reject nothing follow, cheapest first.
    """
    left, order, alive = set(range(len(costs))), [], dict(patterns)
    while left:
        hits = {r: sum(n for bits, n in alive.items() if bits >> r & 1) for r in left}
        best = max(left, key=lambda r: (hits[r] / max(costs[r], 1e-9), -costs[r], -r))
        order.append(best)
        left.remove(best)
        alive = {bits: n for bits, n in alive.items() if not bits >> best & 1}
    return order


def plan_order(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text") -> list[int]:
    """Costs and selectivities of ``rules`` on at most ``SAMPLE_ROWS`` rows."""
    sample = with_measures(
        docs.select(text_col).sample(SAMPLE_SHARE, seed=7).limit(SAMPLE_ROWS), text_col
    ).where(~_base_failed()).persist()
    try:
        sample.count()
        text = F.coalesce(F.col(text_col), F.lit(""))
        rejects = [F.coalesce(r.rejects(text, _measures()), F.lit(False)) for r in rules]
        bits = sum((F.when(x, F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(rejects)), F.lit(0))
        patterns = {r["bits"]: r["count"] for r in sample.groupBy(bits.alias("bits")).count().collect()}
        costs = []
        for x in rejects:
            runs = []
            for _ in range(2):  # the first run compiles
                began = time.perf_counter()
                sample.agg(F.count_if(x)).collect()
                runs.append(time.perf_counter() - began)
            costs.append(min(runs))
        return order_by_rejection_per_cost(costs, patterns)
    finally:
        sample.unpersist()


def quality_cascade(
    docs: DataFrame,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    text_col: str = "text",
    order: list[int] | None = None,
) -> DataFrame:
    """``docs`` plus the measures, ``base_failed``, ``rejected_by`` and ``kept``.

    Null and empty texts have no words, so they fail the base rules. Repeated
    rows get equal verdicts; no other column of ``docs`` is looked at. Columns
    of ``docs`` named like a result are replaced. ``order`` fixes the rules'
    order; by default it is estimated on a sample.
    """
    names = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
             "base_failed", "rejected_by", "kept"}
    docs = docs.drop(*(names - {text_col}))
    order = plan_order(docs, rules, text_col) if order is None else order
    text = F.coalesce(F.col(text_col), F.lit(""))
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for i in order:
        verdict = verdict.when(rules[i].rejects(text, _measures()), F.lit(rules[i].name))
    return (
        with_measures(docs, text_col)
        .withColumn("base_failed", _base_failed())
        .withColumn("rejected_by", verdict)
        .withColumn("kept", F.col("rejected_by").isNull())
    )
