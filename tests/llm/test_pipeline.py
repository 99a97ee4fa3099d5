"""Every stage of the pipeline against a brute-force version, on its own input."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from alertscope.llm import suffix_dedup
from alertscope.llm.common import table
from alertscope.llm.queries import ORACLE_SQL, QUERIES

from conftest import SF_SMALL
from test_line_dedup import brute as brute_lines
from test_simhash_dedup import brute as brute_simhash
from test_suffix_dedup import brute as brute_repeats


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """[(name, input rows, output rows)] as lists of dicts."""
    docs, out = table(spark, SF_SMALL, "documents"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_order_and_columns(steps):
    assert list(steps) == ["quality_rules", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    for name, (_, after) in list(steps.items())[:-1]:
        assert set(after[0]) == set(P.COLUMNS), name


def test_quality_rules(steps):
    before, after = steps["quality_rules"]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = {r[0] for r in con.sql(f"SELECT doc_id FROM ({ORACLE_SQL['op4_quality_rules']}) WHERE kept").fetchall()}
    assert {r["doc_id"] for r in after} == want and 0 < len(want) < len(before)


def test_line_dedup(steps):
    before, after = steps["line_dedup"]
    gone = brute_lines([(r["doc_id"], r["text"]) for r in before])
    have = {r["doc_id"]: r["text"] for r in after}
    for r in before:
        kept = [x for n, x in enumerate(r["text"].split("\n")) if (r["doc_id"], n) not in gone]
        assert have[r["doc_id"]] == "\n".join(kept)
    assert gone and all(r["n_chars"] == len(r["text"]) for r in after)


def test_simhash_near_dedup(steps):
    before, after = steps["simhash_near_dedup"]
    groups = brute_simhash([(r["doc_id"], r["text"]) for r in before])
    want = {d for d, _, component in groups if d == component}
    assert {r["doc_id"] for r in after} == want and len(after) == len(want)


def test_suffix_array_dedup(steps):
    before, after = steps["suffix_array_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before]
    removed = {d: n for d, _, n, _, _ in brute_repeats(rows, 400)}
    have = {r["doc_id"]: r["text"] for r in after}
    assert set(have) == {d for d, _ in rows}
    for d, text in rows:
        if not removed[d]:
            assert have[d] == text
        else:  # a cut character loses its remains: at most three bytes at each end of a span
            left = len(text.encode()) - removed[d]
            assert left - 6 * 50 <= len(have[d].encode()) <= left


def test_best_fit_packing(steps):
    before, after = steps["best_fit_packing"]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in before:
        ids = np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k in range(0, len(ids), 4096):
            want[r["doc_id"], k // 4096] = (k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in after} == want


def test_run_gives_the_last_stage(spark, steps):
    pieces = lambda rows: sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows)
    assert pieces(r.asDict() for r in P.run(spark, SF_SMALL).collect()) == pieces(steps["best_fit_packing"][1])


def test_queries_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    have = QUERIES["op7_suffix_array_dedup"](spark, SF_SMALL).collect()
    assert sorted((tuple(r) for r in have), key=str) == brute_repeats(rows, 400)
    gone = brute_lines(rows)
    lines = QUERIES["op8_line_dedup"](spark, SF_SMALL).collect()
    assert {(r.doc_id, n) for r in lines for n in r.removed} == gone and len(lines) == len(rows)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, []
    for d, text in sorted(rows):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    index = QUERIES["op10_token_index"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in index) == want
    assert suffix_dedup.LENGTH == 400


def test_simhash_near_dedup_of_null_and_repeated_ids(spark):
    words = [f"w{n}" for n in range(400)]
    base = {k: " ".join(words[i::7] * 3) for i, k in enumerate("abcdef")}
    rows = [(None, base["a"]), (1, base["b"]), (1, base["b"]), (None, base["b"]), (2, base["c"]), (2, base["c"] + "\n"),
            (3, base["d"]), (3, base["e"]), (None, base["f"]), (None, base["f"])]
    full = [(d, t, "en", f"s{n}", len(t)) for n, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (df.repartition(3), df.coalesce(1)):
        after = P.simhash_near_dedup(spark, docs, SF_SMALL)
        assert after.columns == P.COLUMNS
        got = [(r.doc_id, r.text.strip()) for r in after.collect()]
        want = [(None, base["a"]), (1, base["b"]), (2, base["c"]), (3, base["d"]), (3, base["e"]), (None, base["f"])]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert P.simhash_near_dedup(spark, df.limit(0), SF_SMALL).count() == 0
