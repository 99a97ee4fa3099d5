"""Repeated strings against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from alertscope.llm import suffix_dedup as S


def brute(rows, length):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, len(data), int(gone.sum()), len(S.runs(gone)), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))


def corpus(seed, n, length):
    rng = random.Random(seed)
    shared = [words(rng, length) [: rng.randint(length // 2, 3 * length)] for _ in range(6)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        parts = [words(rng, rng.randint(0, 40))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage = shared[0] if kind < 0.5 else rng.choice(shared)
            a = rng.choice([0, 0, rng.randrange(len(passage))])
            parts += [passage[a:], words(rng, rng.randint(0, 20))]
        text = rng.choice(["", " "]).join(parts)
        if texts and rng.random() < 0.15:  # a near copy
            text = list(rng.choice(texts))
            for _ in range(3):
                if text:
                    text[rng.randrange(len(text))] = rng.choice("xyz")
            text = "".join(text)
        texts.append(text)
    return texts


@pytest.mark.parametrize(
    "length,gram,group,batch", [(40, 12, 256, 1 << 20), (40, 12, 3, 2000), (30, 30, 2, 500), (50, 8, 1, 100)]
)
def test_equals_brute_force(spark, length, gram, group, batch):
    texts = corpus(length + group, 150, length)
    texts += ["ab" * 100, "a" * 300, "a" * 60, None, "", "short", texts[0], "é" * 90]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, words(random.Random(1), 60))]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, data int, lo string").repartition(5)
    got = S.repeat_report(df, length=length, gram=gram, group=group, batch_bytes=batch).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, length)


def test_text_keeps_whole_characters_and_columns(spark):
    rng = random.Random(9)
    passage = words(rng, 200)
    docs = [(1, "é" + passage + "ü", "a"), (2, "è" + passage + "û", "b"), (3, None, "c"), (4, passage[:100], "d")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in S.remove_repeats(df).collect()}
    # the passage goes, and the last bytes of the characters beside it with it
    assert got == {1: "é", 2: "è", 3: None, 4: passage[:100]} or got == {1: "éü", 2: "èû", 3: None, 4: passage[:100]}
    assert S.remove_repeats(df).columns == ["doc_id", "text", "source"]
    assert S.repeat_report(df.limit(0)).count() == 0 and S.remove_repeats(df.limit(0)).count() == 0


def test_expansion_equals_sorted_suffixes():
    rng = random.Random(4)
    for alphabet in (2, 5, 256):
        data = np.array([rng.randrange(alphabet) for _ in range(400)] * 2 + [300, 301], dtype=np.int64)
        for stop in (1, 2, 7, 60):
            order = S.suffix_order(data, stop)
            broken = S.common_prefix_breaks(data, order, stop)
            heads = [tuple(data[i : i + stop]) for i in order]
            assert heads == sorted(heads)
            assert broken.tolist() == [True] + [a != b for a, b in zip(heads, heads[1:])]


def test_sliding_argmin():
    rng = np.random.default_rng(1)
    for n, width in ((1, 1), (50, 7), (64, 8), (100, 100), (333, 40)):
        values = rng.integers(0, 5, n).astype(np.uint64) << np.uint64(20)
        want = [i + int(np.argmin(values[i : i + width])) for i in range(n - width + 1)]
        assert S.sliding_argmin(values, width).tolist() == want


def test_planted_passages(spark):
    """Passages of over 50 words in two documents: of 400 bytes or more they go, and
    clean documents stay whole."""
    rng = random.Random(11)

    def words(n, low, high):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(low, high))) for _ in range(n))

    long_ones, short_ones = [words(60, 7, 9) for _ in range(5)], [words(52, 3, 5) for _ in range(3)]
    assert min(map(len, long_ones)) >= 400 and max(map(len, short_ones)) < 400
    docs = []
    for p in long_ones + short_ones:
        docs += [(words(40, 4, 9) + " " + p + " " + words(30, 4, 9), p in long_ones) for _ in range(2)]
    docs += [(words(120, 4, 9), False) for _ in range(10)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string")
    rows = {r.doc_id: r for r in S.repeat_report(df).collect()}
    for i, (text, planted) in enumerate(docs):
        assert (rows[i].n_removed >= 400) == planted and (rows[i].n_removed > 0) == planted
        assert rows[i].n_bytes == len(text.encode())
