"""SimHash fingerprints and components against brute force."""

from __future__ import annotations

import random

import pandas as pd
import pytest
import xxhash

from alertscope.llm import simhash_dedup as S

from conftest import SF_SMALL


def plain_fingerprint(text, shingle=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute(rows, max_bits=2):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


def got(df, **limits):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.simhash_groups(df, **limits).collect()), key=str)


def test_odd_texts(spark):
    rows = [(5, None), (3, ""), (4, " \n\t "), (7, "One"), (8, "one"), (9, "one two"), (9, "one two"), (10, "É é A"),
            (None, "one two"), (None, "alone in here"), (11, "w " * 70000), (12, "a b c d"), (13, "a b c d e")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, fp int")
    assert got(df) == brute(rows)
    assert S.simhash_groups(df.limit(0)).count() == 0


def test_shingles_cross_blocks(monkeypatch):
    text = " ".join(f"w{i % 17}" for i in range(500))
    want = plain_fingerprint(text)
    monkeypatch.setattr(S, "SHINGLE_BLOCK", 7)
    assert S.fingerprint(text.encode()) == want


def reach(links):
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        root[find(a)] = find(b)
    return {i: find(i) for i in list(root)}


@pytest.mark.parametrize("max_bits,segments,direct", [(2, 5, 32), (2, 5, 2), (1, 4, 32), (1, 4, 2), (2, 3, 1), (3, 8, 1 << 62)])
def test_links_connect_exactly_the_near_pairs(spark, max_bits, segments, direct):
    rng = random.Random(max_bits * 100 + segments)
    values = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(14):  # chains and crowds around a centre
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, max_bits + 1)))
            values.add(centre)
    values |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2}
    values = sorted(values)
    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= max_bits]
    df = spark.createDataFrame([(S._signed(v),) for v in values], "fp long")
    links = [(r.src % (1 << 64), r.dst % (1 << 64)) for r in S.near_links(df, max_bits, segments, direct).collect()]
    assert all((a ^ b).bit_count() <= max_bits for a, b in links)
    one, two = reach(near), reach(links)
    groups = lambda g: {frozenset(i for i in g if g[i] == r) for r in set(g.values())} - {frozenset([i]) for i in g}
    assert groups(one) == groups(two) and len(groups(one)) > 5


def test_query_equals_brute_force(spark):
    from alertscope.llm.queries import QUERIES

    t = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    rows = list(t[["doc_id", "text"]].itertuples(index=False, name=None))
    have = QUERIES["op9_simhash_near_dedup"](spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in have), key=str) == brute(rows)
