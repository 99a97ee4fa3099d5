"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.llm.collocations import mine_phrases
from alertscope.llm.common import materialize, prepare, table
from alertscope.llm.embedding_dedup import embedding_groups
from alertscope.llm.gumbel_segment import decode_segmentations, sample_segmentations
from alertscope.llm.language_id import identify_languages
from alertscope.llm.line_dedup import line_report
from alertscope.llm.packing import pack_documents
from alertscope.llm.quality_rules import quality_cascade
from alertscope.llm.simhash_dedup import simhash_groups
from alertscope.llm.source_divergence import divergence_audit
from alertscope.llm.suffix_dedup import repeat_report
from alertscope.llm.token_cache import read_vocabulary
from alertscope.llm.token_index import indexed_tokens
from alertscope.llm.token_rollup import TokenRollups, count_tokens, inserted
from alertscope.llm.toxicity import toxicity_scores
from alertscope.session import scratch_path

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    return read_vocabulary(public_tokenizers.path(name))


def op1_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four distinct sampled segmentations of every document, seeded by its id, and
    whether each, decoded again, is the text (a null text is the empty one)."""
    with open(public_tokenizers.path(PIECE_BPE), "rb") as f:
        model = f.read()
    docs = table(spark, sf_dir, "documents")
    drawn = decode_segmentations(sample_segmentations(docs, model, k=4, with_ids=True, keep=("text",)), model)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return drawn.withColumn("decodes", same).drop("text", "decoded")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version after four batches: all
    documents inserted under either tokenizer, the byte tokenizer's counts
    revised to those of texts with runs of white space squeezed, and exact
    copies (all but the smallest id) deleted. The last two are sent twice.
    """
    squeezed = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    docs = table(spark, sf_dir, "documents").withColumn("md5", F.md5(F.coalesce("text", F.lit(""))))
    counts = materialize(
        count_tokens(
            docs,
            {"byte": vocabulary(BYTE_BPE), "word": vocabulary(WORD_BPE)},
            {"raw": F.col("text"), "squeezed": squeezed},
            [("byte", "raw"), ("byte", "squeezed"), ("word", "raw")],
            ["doc_id", "source", "lang", "md5"],
        ),
        "token-counts",
    )
    first = counts.groupBy("md5").agg(F.min("doc_id").alias("first_id"))
    copies = counts.join(first, "md5").where("doc_id <> first_id")
    revised = counts.where("byte_raw <> byte_squeezed").select(
        F.lit("revise").alias("op"), "source", "lang", F.lit("byte_bpe_50k").alias("tokenizer"),
        F.col("byte_squeezed").alias("n_tokens"), F.col("byte_raw").alias("old_tokens"),
    )
    gone = inserted(copies, "byte_bpe_50k", "byte_squeezed", "delete").union(
        inserted(copies, "word_bpe_49k", "word_raw", "delete")
    )
    store = TokenRollups(spark, scratch_path(spark, "token-rollups"))
    store.commit("1-byte", inserted(counts, "byte_bpe_50k", "byte_raw"))
    store.commit("2-word", inserted(counts, "word_bpe_49k", "word_raw"))
    for _ in range(2):
        store.commit("3-squeeze", revised)
        store.commit("4-copies", gone)
    return store.totals()


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality cascade for every document."""
    prepare(spark)
    return quality_cascade(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), capacity=4096, end_id=1)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector, at a cosine of 0.93 within a label."""
    return embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that repeat."""
    return repeat_report(table(spark, sf_dir, "documents"), length=400)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and which of them go as near copies of an earlier one."""
    return line_report(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op10_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to shards, found through the index and read back."""
    return indexed_tokens(
        table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), scratch_path(spark, "token-index"), end_id=2
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of 2 and 3 words that occur 10 times or more."""
    return mine_phrases(table(spark, sf_dir, "documents"), min_count=10, top=2000, inside_percent=50)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by cross-parsing."""
    return identify_languages(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and the terms that set a source apart."""
    return divergence_audit(table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_gumbel_segmentations": op1_gumbel_segmentations,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_index": op10_token_index,
    "op11_collocations": op11_collocations,
    "op12_language_id": op12_language_id,
    "op13_source_divergence": op13_source_divergence,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP4_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
),
starts AS (
  SELECT rn, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3
),
win AS (
  SELECT rn, i, count(*) OVER (PARTITION BY rn, w[i], w[i + 1], w[i + 2]) AS n FROM starts
),
rep AS (
  SELECT rn, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY rn
),
m AS (
  SELECT d.doc_id, d.text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
              AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, lines,
         greatest(length(text), 1) AS len
  FROM d LEFT JOIN rep USING (rn)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR n_symbols * 10 > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR n_dup_lines * 10 > n_lines * 3
            OR (length(text) - length(regexp_replace(text, '\p{{Lu}}+', '', 'g'))) / len > 0.4
            OR (length(text) - length(regexp_replace(text, '[!?]+', '', 'g'))) / len > 0.05
            OR (length(text) - length(regexp_replace(text, '[\p{{L}}\p{{M}}]+', '', 'g'))) / len < 0.5
            OR len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) * 10 > n_lines * 3
       ) AS kept
FROM b"""

_OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text
  FROM documents
),
t AS (
  SELECT rn, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
),
kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rn) >= 3
),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT s.lang, s.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c USING (lang, source) GROUP BY s.lang, s.source
),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + langs.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 1)) // (langs.total + langs.v) AS q
  FROM g JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced ON priced.lang = a.lang AND priced.source = a.source AND priced.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200"""

_OP11_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, text
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS text
    FROM documents
  )
),
w AS (
  SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i
        FROM (SELECT lang, regexp_extract_all(text, '[^\x20\x09]+') AS ws FROM pieces))
),
f1 AS (SELECT lang, x, count(*) AS f FROM w GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM w WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM w WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
around AS (
  SELECT lang, x, y, max(f) AS most
  FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY lang, x, y
),
found AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, l.f AS l, r.f AS r, 1 AS cut
  FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.x = f2.x JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
  LEFT JOIN around o ON o.lang = f2.lang AND o.x = f2.x AND o.y = f2.y
  WHERE o.most IS NULL OR 100 * o.most < 50 * f2.f
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, l.f, r.f, 1
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.x = f3.x
  JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, l.f, r.f, 2
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y
  JOIN f1 r ON r.lang = f3.lang AND r.x = f3.z
),
scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score
  FROM found
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (1000000::HUGEINT * a * a) // (l::HUGEINT * r), cut) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE_SQL: dict[str, str] = {"op4_quality_rules": _OP4_SQL, "op11_collocations": _OP11_SQL, "op13_source_divergence": _OP13_SQL}
