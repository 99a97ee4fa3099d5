"""Shards and index against the library's ids."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from alertscope.llm import token_index as T
from alertscope.llm.token_cache import read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_perfect_hash_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(3)
    for n in (1, 2, 100, 5000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        own, _ = T.PerfectHash.read(T.PerfectHash.build(keys).to_bytes() + b"tail")
        assert sorted(own.lookup(keys).tolist()) == list(range(len(keys)))
        strangers = np.setdiff1d(rng.integers(-(1 << 62), 1 << 62, 2000), keys)
        assert (own.lookup(strangers) >= 0).mean() < 0.005
    assert T.PerfectHash.build(np.array([], dtype=np.int64)).lookup(np.array([5])).tolist() == [-1]


def test_block_round_trip():
    parts = [np.array(x, dtype="<u2").tobytes() for x in ([1, 2, 10], [], [65535])]
    file = T.block([5, 6, T.NO_KEY], parts, 2) + b"\n" + T.block([7], [b""], 2) + b"\n"
    got = [(k.tolist(), n.tolist(), i.tolist()) for k, n, i in T.blocks(file)]
    assert got == [([5, 6, T.NO_KEY], [3, 0, 1], [1, 2, 10, 65535]), ([7], [0], [])]


def test_indexed_tokens(spark, tmp_dir, monkeypatch):
    texts = ["b c", None, "", "line\nbreak \n\n x", "same", "same", "word " * 3000, "<|endoftext|>"]
    rows = [(100 - i, t, "x") for i, t in enumerate(texts)] + [(96, "same", "y"), (96, "other", "y"), (None, "no key", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(3)
    got = T.indexed_tokens(docs, read_vocabulary(PATH), f"{tmp_dir}/out", end_id=2).collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, _ in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    # unknown keys give no row
    index = spark.read.parquet(f"{tmp_dir}/out/index")
    assert T.lookup(index, spark.createDataFrame([(12345,), (100,)], "key long")).select("key").collect() == [(100,)]


def test_many_blocks_and_parts(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(T, "PART_KEYS", 20)
    docs = spark.range(500).selectExpr("id * 7 as doc_id", "repeat(concat('w', id, ' '), int(id)) as text")
    got = T.indexed_tokens(docs, read_vocabulary(PATH), f"{tmp_dir}/out").orderBy("start").collect()
    assert [r.doc_id for r in got] == [i * 7 for i in range(500)]


def test_empty_table(spark, tmp_dir):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.indexed_tokens(docs, read_vocabulary(PATH), f"{tmp_dir}/out").count() == 0
