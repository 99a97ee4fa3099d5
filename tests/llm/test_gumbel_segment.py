"""Gumbel top-k segmentations against the enumerated lattice."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from alertscope.llm import gumbel_segment as G
from alertscope.llm.queries import QUERIES

from conftest import SF_SMALL

with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    MODEL = f.read()


@pytest.fixture(scope="module")
def lattices():
    return G.Lattices(MODEL, 1.0)


def all_segmentations(lattices, text):
    """{ids: probability} over the whole lattice."""
    s = G.SPACE + text.replace(" ", G.SPACE)
    out = {}

    def go(at, ids, score):
        if at == len(s):
            out[ids] = math.exp(score)
            return
        single = False
        for end in range(at + 1, min(len(s), at + lattices.longest) + 1):
            if s[at:end] in lattices.pieces:
                single |= end == at + 1
                i, p = lattices.pieces[s[at:end]]
                go(end, ids + i, score + math.log(p))
        if not single:
            go(at + 1, ids + tuple(lattices.fallback(s[at])), score + math.log(lattices.unknown))

    go(0, (), 0.0)
    total = math.fsum(out.values())
    return {ids: p / total for ids, p in out.items()}


@pytest.mark.parametrize("text", ["ab", "the", "a  b", "é\x01", "in a"])
def test_draws_follow_the_lattice(lattices, text):
    want = all_segmentations(lattices, text)
    n, k = 4000, 3
    rows = G.draw(lattices, [text] * n, list(range(n)), k, 5)
    drawn = {}
    for doc, turn, ids, log_prob, value, score in rows:
        ids = tuple(ids.tolist())
        assert math.isclose(math.exp(log_prob), want[ids], rel_tol=1e-6)
        drawn.setdefault(doc, []).append((turn, ids, value, score))
    first = Counter()
    total = []
    for own in drawn.values():
        assert [t for t, *_ in own] == list(range(1, min(k, len(want)) + 1))
        assert len({ids for _, ids, _, _ in own}) == len(own)
        assert all(a[2] > b[2] for a, b in zip(own, own[1:]))
        first[own[0][1]] += 1
        total.append(sum(want[ids] / score for _, ids, _, score in own))
    # the first draw is a plain sample; weighting by inclusion is unbiased
    for ids, p in want.items():
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    assert abs(np.mean(total) - 1) < 5 * np.std(total) / math.sqrt(n) + 1e-9
    # the second draw, given the first, is in proportion to what is left
    second = Counter((own[0][1], own[1][1]) for own in drawn.values() if len(own) > 1)
    for (a, b), m in second.most_common(4):
        p = want[a] * want[b] / (1 - want[a])
        assert abs(m / n - p) < 5 * math.sqrt(max(p * (1 - p), 0) / n) + 1e-3


def test_few_segmentations_give_all_of_them(lattices):
    text = "\x01\x02"
    want = all_segmentations(lattices, text)
    rows = G.draw(lattices, [text], [1], 50, 0)
    assert {tuple(r[2].tolist()) for r in rows} == set(want) and all(r[5] == 1.0 for r in rows)


def test_repeated_branches_at_one_node(lattices):
    want = all_segmentations(lattices, "then")
    rows = G.draw(lattices, ["then"] * 40, list(range(40)), len(want) + 3, 1)
    for d in range(40):
        assert {tuple(r[2].tolist()) for r in rows if r[0] == d} == set(want)


def test_rows_decode_and_depend_on_their_key_alone(spark):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")[["doc_id", "text"]].head(60)
    rows = [(int(d), t, "x") for d, t in docs.itertuples(index=False)]
    rows += [(1000, None, "x"), (1001, "", "y"), (None, "no key", "z"), (5, "again", "z"), (5, "again", "z"), (7, "x" * 3000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, draw string")
    one = G.sample_segmentations(df.repartition(3), MODEL, k=2, with_ids=True).collect()
    two = G.sample_segmentations(df.coalesce(1), MODEL, k=2, with_ids=True).collect()
    key = lambda r: str((r.doc_id, r.n_ids, r.draw, r.ids_crc32, r.log_prob, r.perturbed, r.inclusion))
    assert sorted(map(key, one)) == sorted(map(key, two))
    texts = Counter((d, t or "") for d, t, _ in rows)
    got = Counter((r.doc_id, G.decode_ids(np.frombuffer(r.ids, "<u4"), MODEL)) for r in one if r.draw == 1)
    assert got == texts
    for r in one:
        assert (r.doc_id, G.decode_ids(np.frombuffer(r.ids, "<u4"), MODEL)) in texts and 0 < r.inclusion <= 1
    pairs = Counter((r.doc_id, r.n_ids, r.ids_crc32) for r in one if r.doc_id not in (5,))
    assert max(pairs.values()) == 1
    assert G.sample_segmentations(df.limit(0), MODEL).count() == 0


def test_query_gives_four_segmentations_that_decode(spark):
    rows = QUERIES["op1_gumbel_segmentations"](spark, SF_SMALL).collect()
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    assert {r.doc_id for r in rows} == set(docs["doc_id"]) and all(r.decodes for r in rows)
    own = Counter(r.doc_id for r in rows)
    assert all(own[d] == 4 for d, t in zip(docs["doc_id"], docs["text"]) if t and len(t) > 20)
    assert len({(r.doc_id, r.ids) for r in rows}) == len(rows)
    texts = dict(zip(docs["doc_id"], docs["text"].fillna("")))
    for r in rows[:200]:
        assert G.decode_ids(np.frombuffer(r.ids, "<u4"), MODEL) == texts[r.doc_id]
        assert len(r.ids) == 4 * r.n_ids


def test_decoder_equals_library(spark, lattices):
    texts = ["", " ", "  a  b ", "é\x01\n\n", "日本 😀 x", "a" * 500]
    blobs = [(n, r[2].astype("<u4").tobytes()) for n, r in enumerate(G.draw(lattices, texts, texts, 4, 3))] + [(-1, None)]
    df = spark.createDataFrame(blobs, "n int, ids binary")
    for r in G.decode_segmentations(df, MODEL).collect():
        assert r.decoded == (None if r.ids is None else G.decode_ids(np.frombuffer(r.ids, "<u4"), MODEL))
    assert G.decode_segmentations(df.limit(0), MODEL).count() == 0


def test_words_together_equal_words_one_by_one():
    """Lattices of many words at once are those of single words to the last bit."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    together, single = G.Lattices(model, 1.0), G.Lattices(model, 1.0)
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")["text"].dropna().tolist()[:30]
    odd = ["a", "x" * 63, "x" * 64, "x" * 65, "qzx" * 21, "kjq" * 20, "日本語", "\U0001f600é", "a\x00b", "กข", " " * 70]
    words = list(dict.fromkeys(w for t in docs + odd for w in together.words(t)))
    together.learn(words[::2])
    together.learn(words[1::2])
    together.settle()
    for word in words:
        single.add(word)
    single.settle()
    ends = [np.cumsum(x.sizes, dtype=np.int64).tolist() for x in (together, single)]
    assert together.n_nodes == single.n_nodes and together.n_edges == single.n_edges
    for word in words:
        a, b = together.start[word], single.start[word]
        for i in range(len(word)):
            ours, theirs = (slice(x.first[k + i], x.first[k + i + 1]) for x, k in ((together, a), (single, b)))
            assert np.array_equal(together.cdf[ours], single.cdf[theirs]) and np.array_equal(together.prob[ours], single.prob[theirs]), word
            to = [[-1 if t < 0 else t - k for t in x.to[s].tolist()] for x, s, k in ((together, ours, a), (single, theirs, b))]
            assert to[0] == to[1], word
            for one, two in zip(range(ours.start, ours.stop), range(theirs.start, theirs.stop)):
                ids = [x.ids[n[e] - int(x.sizes[e]) : n[e]].tolist() for x, n, e in ((together, ends[0], one), (single, ends[1], two))]
                assert ids[0] == ids[1], word


def test_decoder_decodes_rows_together():
    import pyarrow as pa

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    lattices, texts = G.Lattices(model, 1.0), ["a word", "", "日本 \U0001f600", " two  spaces\n"]
    rows = [r for r in G.draw(lattices, texts, list(range(4)), 2, 0)]
    blobs = [r[2].astype("<u4").tobytes() for r in rows] + [None]
    assert G.Decoder(model).texts(pa.array(blobs, pa.binary())).to_pylist() == [texts[r[0]] for r in rows] + [None]


def test_a_batch_looks_each_word_up_once():
    """However often a word occurs, and whatever texts it is in."""

    class Counted(dict):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    lattices = G.Lattices(MODEL, 1.0)
    lattices.start = Counted()
    rows = G.draw(lattices, ["some words again " * 300, "again some"] * 3, list(range(6)), 2, 0)
    assert len(rows) == 12 and Counted.asked <= 8
