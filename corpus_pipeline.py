"""Corpus preparation as a chain of stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept. ``run`` writes what a stage returns as Parquet and reads it
back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare, release, table
from alertscope.llm.line_dedup import dedup_lines
from alertscope.llm.packing import pack_documents
from alertscope.llm.quality_rules import quality_cascade
from alertscope.llm.queries import WORD_BPE, vocabulary
from alertscope.llm.simhash_dedup import first_of_groups
from alertscope.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality cascade keeps."""
    prepare(spark)
    return quality_cascade(docs).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are near copies of an earlier line. ``n_chars``
    follows the text."""
    return _counted(dedup_lines(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, a document
    without an id only where the group has no other. Rows that share an id, with
    equal texts or not, are one row of the group each."""
    return first_of_groups(docs, shingle=3, max_bits=2).select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 400 bytes that repeat anywhere."""
    return _counted(remove_repeats(docs, length=400))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of 4096 ids."""
    return pack_documents(docs, vocabulary(WORD_BPE), capacity=4096, end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            release(last)
        last = docs
    return docs


#: The stages hash, tokenize and pack, which SQL does not express; tests
#: compare ``run`` with brute force.
ORACLE_SQL = None
