"""Packing against the library's ids, and against the lower bound on bins."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from alertscope.llm.packing import best_two_fit, pack_documents
from alertscope.llm.token_cache import read_vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_patterns_use_every_piece_once_and_fit():
    rng = np.random.default_rng(1)
    for capacity, n in ((64, 3000), (4096, 20000), (10, 7)):
        lengths = np.minimum(rng.lognormal(np.log(capacity / 5), 1, n).astype(int) + 1, capacity)
        histogram = dict(Counter(lengths.tolist()))
        patterns = best_two_fit(histogram, capacity)
        used = Counter()
        for repeats, bin_ in patterns:
            assert repeats > 0 and sum(bin_) <= capacity
            for x in bin_:
                used[x] += repeats
        assert used == histogram
        bins = sum(r for r, _ in patterns)
        assert bins <= np.ceil(lengths.sum() / capacity) * 1.02 + 1


def test_smallest_is_replaced_by_two_that_fit_more_tightly():
    # greedy: 6 + 3 leaves a gap of 1; 2 + 2 fill the room of the 3
    assert (1, [6, 2, 2]) in best_two_fit({6: 1, 3: 1, 2: 2}, 10)


@pytest.mark.parametrize("capacity", [4096, 50])
def test_pack_documents(spark, capacity):
    texts = ["a b c", None, "", "word " * 5000, "same", "same", "x\ny" * 40, "<|endoftext|> tail"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(4, "same", "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = pack_documents(docs, read_vocabulary(PATH), capacity, with_ids=True).collect()
    plain = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, _ in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity].tobytes()
            want[doc_id, k // capacity, k, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, read_vocabulary(PATH)).count() == 0
