"""Fuzzy line dedup against brute force over all pairs of lines."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from alertscope.llm import line_dedup as L

from conftest import SF_SMALL


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(400):
        a = "".join(rng.choices("abcé", k=rng.randint(0, 80)))
        b = list(a) if rng.random() < 0.6 else rng.choices("abcé", k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 6)):
            if b:
                b[rng.randrange(len(b))] = rng.choice("abx")
                if rng.random() < 0.5:
                    del b[rng.randrange(len(b))]
        assert L.edit_distance(a, "".join(b)) == plain_distance(a, "".join(b))


def plain_simhash(words):
    ones = [0] * 64
    for w in words:
        h = xxhash.xxh64_intdigest(w, 1)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(words))


def test_simhashes(monkeypatch):
    monkeypatch.setattr(L, "WORD_BLOCK", 7)
    rng = random.Random(3)
    runs = [[rng.choice("abcdefgh") for _ in range(rng.randint(1, 25))] for _ in range(60)]
    flat = np.array([xxhash.xxh64_intdigest(w, 1) for r in runs for w in r], dtype=np.uint64)
    got = L.simhashes(flat, np.cumsum([len(r) for r in runs]))
    assert [int(x) for x in got] == [plain_simhash(r) for r in runs]


def brute(docs, max_bits=3, least=0.8):
    """Removed (document, line) places: equal lines, however short, and similar ones of
    at least ``MIN_CHARS`` characters; a line of marks alone equals only itself."""
    places, seen, fuzzy = {}, set(), set()
    for doc_id, text in docs:
        if (doc_id, text) in seen:
            continue
        seen.add((doc_id, text))
        for n, line in enumerate((text or "").split("\n")):
            words = L.normalised(line)
            plain = " ".join(words or line.split())
            if plain:
                places.setdefault(plain, []).append((doc_id, n))
            if words and len(plain) >= L.MIN_CHARS:
                fuzzy.add(plain)
    lines = sorted(places)
    prints = [plain_simhash(set(x.split(" "))) for x in lines]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            if lines[i] not in fuzzy or lines[j] not in fuzzy:
                continue
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                if 1 - plain_distance(lines[i], lines[j]) / max(len(lines[i]), len(lines[j])) >= least:
                    root[find(i)] = find(j)
    groups = {}
    for i, line in enumerate(lines):
        groups.setdefault(find(i), []).extend(places[line])
    return {p for g in groups.values() for p in g if p != min(g)}


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([2, 4, 12, 30, 60]))] for _ in range(25)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(words))
                words[k] = rng.choice(vocabulary + ["7", "8"])
            line = " ".join(words)
            lines.append(rng.choice([line, line.upper(), line + ".", "- " + line, "", "   "]))
        docs.append((i, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("tile,direct", [(256, 32), (4, 2)])
def test_equals_brute_force(spark, monkeypatch, tile, direct):
    monkeypatch.setattr(L, "TILE", tile)
    monkeypatch.setattr(L.clusters, "__defaults__", (direct,))
    docs = corpus(120, 4)
    docs += [(900, docs[3][1]), (900, docs[3][1])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, line string, uid int")
    got = {(r.doc_id, n) for r in L.removed_lines(df).collect() for n in r.removed}
    want = brute(docs)
    assert got == want and len(want) > 50
    kept = {r.doc_id: r.text for r in L.dedup_lines(df).collect()}
    for doc_id, text in docs:
        assert kept[doc_id] == "\n".join(x for n, x in enumerate(text.split("\n")) if (doc_id, n) not in want)
    report = L.line_report(df).collect()
    assert len(report) == len(docs) and {(r.doc_id, n) for r in report for n in r.removed} == want


def test_nulls_repeats_and_long_lines(spark):
    long = " ".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i * i % 23) for i in range(20000))
    docs = [(1, None), (2, ""), (3, "one two three four\nshort\nshort"), (4, "One two, three FOUR!"), (4, "One two, three FOUR!"),
            (None, "one two three four"), (5, long), (6, long + " tail"), (7, "\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in L.dedup_lines(df).collect()), key=str)
    want = [(1, None), (2, ""), (3, "short"), (4, ""), (4, ""), (None, "one two three four"), (5, long), (6, ""), (7, "\n\n")]
    assert got == sorted(want, key=str)
    assert L.dedup_lines(df.limit(0)).count() == 0
    assert L.line_report(df.limit(0)).count() == 0


def test_equal_lines_collapse_however_short(spark):
    paragraph = "日本語の文章には単語の間に空白がないので段落全体が一語になる" * 5
    docs = [(1, "Contents\n\n- a\n---\nab"), (2, "contents:\n\nA\n---\n***\nab!\nac"), (3, paragraph), (4, paragraph + "。"),
            (5, "---\n \t\n* * *\n***\nRead more"), (6, "read MORE\nread less\n7\n8"), (None, "Read more")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for frame in (df.repartition(3), df.coalesce(1)):
        kept = {r.doc_id: r.text for r in L.dedup_lines(frame).collect()}
        assert kept == {1: "Contents\n\n- a\n---\nab", 2: "\n***\nac", 3: paragraph, 4: "",
                        5: " \t\n* * *", 6: "read less\n7", None: "Read more"}


def test_every_equal_line_of_the_table_collapses(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    gone = {(r.doc_id, n) for r in L.removed_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect() for n in r.removed}
    left = [" ".join(L.normalised(x) or x.split()) for d, t in docs for n, x in enumerate((t or "").split("\n")) if (d, n) not in gone]
    left = [x for x in left if x]
    assert len(left) == len(set(left)) and gone


def test_equals_brute_force_on_lines_of_any_length(spark):
    docs = corpus(120, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert {(r.doc_id, n) for r in L.removed_lines(df).collect() for n in r.removed} == want
    short = [(d, n) for d, t in docs for n, x in enumerate(t.split("\n")) if len(L.normalised(x)) < 3]
    assert want & set(short)


def test_many_tiles_meet_in_one_task():
    """Tiles sorted one after the other, cut anywhere by Arrow batches; a tile of two
    blocks links across them only."""
    import pyarrow as pa

    line, other, far = "one two three four five six", "one two three four five sax", "nothing alike in here at all"
    rows = [  # cluster, i, j, block, uid, simhash, text
        (1, 0, 0, 0, 3, 0, line), (1, 0, 0, 0, 5, 1, other), (1, 0, 0, 0, 8, 0, far),
        (1, 0, 1, 0, 3, 0, line), (1, 0, 1, 0, 5, 1, other), (1, 0, 1, 1, 9, 3, line),
        (2, 0, 0, 0, 1, 0, line), (2, 0, 0, 0, 2, -1, line),
    ]
    names = ["cluster", "i", "j", "block", "uid", "simhash", "text"]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    want = {(3, 5), (3, 9), (5, 9)}
    for size in (1, 2, 3, 8):
        found = [x for b in L._verify(3, 0.8)(iter(table.to_batches(max_chunksize=size))) for x in b.to_pylist()]
        found = {(x["src"], x["dst"]) for x in found}
        # the tile across blocks gives a spanning star: 3 links 9, and 5 by it
        assert found <= want and (3, 5) in found and {9} <= {d for _, d in found}, size


def test_simhash_of_long_runs():
    """Counts of over 255 words in one run among others."""
    rng = np.random.default_rng(4)
    sizes = np.array([1, 254, 255, 256, 3, 511, 1000])
    hashes = rng.integers(0, 1 << 62, sizes.sum(), dtype=np.uint64) * np.uint64(3)
    ends = np.cumsum(sizes)
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = []
    for a, b in zip(ends - sizes, ends):
        ones = bits[a:b].sum(axis=0)
        want.append(sum(1 << k for k in range(64) if 2 * int(ones[k]) > b - a))
    assert L.simhashes(hashes.astype(">u8"), ends).tolist() == want


def test_near_values_connect_what_all_pairs_do():
    """Chains of values a few bits apart, among others and in crowds that are divided."""
    rng = np.random.default_rng(8)
    values = list(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    for _ in range(400):
        x = values[rng.integers(len(values))]
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            x ^= np.uint64(1) << np.uint64(b)
        values.append(x)
    values = np.unique(np.array(values))
    close = np.bitwise_count(values[:, None] ^ values) <= 3
    want = list(range(len(values)))
    for i in range(len(values)):
        for j in np.flatnonzero(close[i, :i]):
            a, b = want[i], want[j]
            want = [min(a, b) if x in (a, b) else x for x in want]
    for limit in (1000, 4):  # over 4 values with half their bits the same become a star
        links = [
            np.stack(x)
            for m in L._masks(list(range(64)), 4, 3)
            for k in np.unique(values & np.uint64(m))
            for x in L.near_values(values[values & np.uint64(m) == k], m, 3, 4, limit)
        ]
        src, dst = np.searchsorted(values, np.concatenate(links, axis=1))
        kept = L.spanning(len(values), src, dst)
        if limit > len(values):
            assert close[src, dst].all() and len(kept) == len(values) - len(set(want))
        root = list(range(len(values)))
        for a, b in zip(src[kept].tolist(), dst[kept].tolist()):
            one, two = root[a], root[b]
            assert one != two
            root = [min(one, two) if x in (one, two) else x for x in root]
        assert all(root[a] == root[b] for a, b in zip(*np.nonzero(close)))


def test_values_that_share_half_their_bits_by_chance_stay_apart(spark):
    """Over 32 values on one combination of blocks, none within 3 bits of another."""
    rng = np.random.default_rng(9)
    values = (rng.integers(0, 1 << 31, 200) << 32) | 0x12345678
    near = np.bitwise_count(values[:, None] ^ values) <= 3
    assert near.sum() == len(values)
    df = spark.createDataFrame([(int(v),) for v in values], "simhash long")
    assert L.clusters(df, L.MAX_BITS, L.BLOCKS).collect() == []


def test_only_documents_with_a_line_to_verify_are_shuffled(spark):
    rows = spark.createDataFrame([(i, -i * i, f"t{i}") for i in range(2000)], "doc_id long, text_key long, text string")
    key = L.F.xxhash64("doc_id", "text_key")
    some = L._maybe(rows, key, L._bitmap(rows.where("doc_id % 100 = 0"), key))
    assert some.columns == rows.columns
    found = {r.doc_id for r in some.collect()}
    assert {i for i in range(2000) if i % 100 == 0} <= found and len(found) < 25
