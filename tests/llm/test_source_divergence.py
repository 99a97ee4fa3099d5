"""Source divergence audit against plain whole-number arithmetic."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from alertscope.llm.source_divergence import divergence_audit, gallop, merge_prices, shares, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, value string, rank string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_docs=3, top=200):
    docs = [(l or "", s or "", [w.translate(AZ) for w in TERM.findall(t or "")]) for _, t, l, s, *_ in rows]
    out = []
    for lang in {l for l, _, _ in docs}:
        df = Counter(w for l, _, ws in docs if l == lang for w in set(ws))
        kept = {w for w, n in df.items() if n >= min_docs}
        counts = {}
        for l, s, ws in docs:
            if l == lang:
                counts.setdefault(s, Counter()).update(w for w in ws if w in kept)
        whole = sum(counts.values(), Counter())
        p = lambda c, w: 1 + (10**9 * (c[w] + 1)) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) * (a - b) // b
        for s, c in counts.items():
            pairs = [(sum(f(p(c, w), p(d, w)) for w in kept), o) for o, d in counts.items() if o != s]
            terms = [(f(p(c, w), p(whole, w)), w) for w in kept if c[w] and p(c, w) > p(whole, w)]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(found[:most])]
    return sorted(out)


def got(spark, rows, **kw):
    df = divergence_audit(spark.createDataFrame(rows, SCHEMA), **kw)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n=120, sources=9):
    rnd = random.Random(seed)
    words = ["Az", "été", "naïve", "b", "zz", "日本", "x", "Q", *("w" + chr(97 + i) + "v" for i in range(26))]
    rows = []
    for i in range(n):
        text = rnd.choice([" ", "-", "3", "\n"]).join(rnd.choices(words, weights=range(len(words), 0, -1), k=rnd.randint(0, 40)))
        source = "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(sources)}"
        rows.append((i, rnd.choice([text, text, text, None, "", " 12 "]), rnd.choice(["en", "de", None]), rnd.choice([source, source, source, None]), "v", "r"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("tiling", [{}, {"chunk_terms": 3, "tile_sources": 2}])
def test_equals_brute_force(spark, seed, tiling):
    rows = corpus(seed)
    assert got(spark, rows, **tiling) == brute(rows)
    assert got(spark, rows, top_terms=2, **tiling) == brute(rows, top=2)


def test_empty_tables_groups_without_terms_and_repeats(spark):
    assert got(spark, []) == []
    rows = [(1, None, None, None, "", ""), (2, "", "en", "a", "", ""), (3, "a a", "en", "b", "", "")]
    assert got(spark, rows) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    rows = [(1, "One two", "en", "a", "", "")] * 3 + [(1, "one", "en", "b", "", "")]
    assert got(spark, rows) == brute(rows)


def test_very_long_text_and_one_hot_source(spark):
    rows = [(i, "word " * 200_000 if i == 0 else "word other", "en", "hot" if i % 3 else f"s{i}", "", "") for i in range(30)]
    assert got(spark, rows, chunk_terms=1) == brute(rows)


def test_terms():
    assert terms_of("Año-NUEVO4you ÉTÉ_x\x7fy".encode()) == [w.encode() for w in ("año", "nuevo", "you", "ÉtÉ", "x", "y")]


def test_gallop_and_exact_shares():
    rnd = np.random.default_rng(3)
    for small, large, top in ((0, 50, 90), (5, 4000, 9000), (900, 1000, 1500), (1, 1, 2), (700, 700, 700)):
        a, b = (np.sort(rnd.choice(top, n, replace=False)).astype(np.int64) for n in (small, large))
        i, j = gallop(a, b)
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()
    big = [0, 1, 10**13, 7 * 10**14]
    want = [1 + 10**9 * (n + 1) // (10**15 + 12345) for n in big]
    assert shares(np.array(big), 10**15, 12345).tolist() == want
    none = np.zeros(0, dtype=np.int64)
    assert merge_prices((none, none, 0), (none, none, 0), 0, 0) == (0, 0)
