"""Delta-maintained rollups against recounting."""

from __future__ import annotations

import pytest

from alertscope.llm.token_rollup import TokenRollups, count_tokens, inserted

CHANGES = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_inserts_deletes_revisions_and_replay(spark, tmp_dir):
    store = TokenRollups(spark, tmp_dir + "/store")
    assert store.totals().count() == 0
    first = spark.createDataFrame(
        [("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, "de", "v1", 7, None),
         ("insert", "a", "en", "v2", 0, None)], CHANGES)
    second = spark.createDataFrame(
        [("delete", "a", "en", "v1", 5, None), ("revise", None, "de", "v1", 9, 7), ("delete", "a", "en", "v2", None, None)], CHANGES)
    assert store.commit("b1", first) and store.commit("b2", second)
    want = sorted([("a", "en", "v1", 1, 10), (None, "de", "v1", 1, 9), ("a", "en", "v2", 0, 0)], key=str)
    assert rows(store.totals()) == want
    assert not store.commit("b1", first) and not store.commit("b2", second)
    assert rows(store.totals()) == want
    # a new store over the same folder sees the same; compaction changes no total
    other = TokenRollups(spark, tmp_dir + "/store")
    other.compact()
    assert rows(other.totals()) == want
    assert not other.commit("b2", second)
    assert other.commit("b3", first)
    other.compact()
    assert rows(other.totals()) == sorted([("a", "en", "v1", 3, 25), (None, "de", "v1", 2, 16), ("a", "en", "v2", 1, 0)], key=str)


def test_a_commit_without_its_marker_is_written_anew(spark, tmp_dir):
    import os

    store = TokenRollups(spark, tmp_dir + "/store")
    one = spark.createDataFrame([("insert", "a", "en", "v", 1, None)], CHANGES)
    store.commit("b", one)
    os.remove(f"{tmp_dir}/store/batches/b/_SUCCESS")
    assert store.totals().count() == 0
    assert store.commit("b", one)
    assert rows(store.totals()) == [("a", "en", "v", 1, 1)]


def test_bad_changes(spark, tmp_dir):
    store = TokenRollups(spark, tmp_dir + "/store")
    for op in ("upsert", None):
        with pytest.raises(Exception, match="unknown change"):
            store.commit("b", spark.createDataFrame([(op, "a", "en", "v", 1, None)], CHANGES))
    assert store.totals().count() == 0
    with pytest.raises(ValueError):
        store.commit("_hidden", inserted(spark.createDataFrame([("a", "en", 1)], "source string, lang string, n long"), "v", "n"))


def test_counts_of_odd_rows(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from alertscope.llm.queries import WORD_BPE, vocabulary

    plain = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    texts = [None, "", "One two", "One two", "x " * 50_000, " \t", "Zoë 日本"]
    df = spark.createDataFrame([(i, t, "s", "k", -1) for i, t in enumerate(texts)], "doc_id long, text string, texts string, kept string, v_raw long")
    cols = {"raw": df.text, "again": df.text, "other": df.texts}
    wanted = [("v", "raw"), ("v", "again"), ("v", "other")]
    got = count_tokens(df, {"v": vocabulary(WORD_BPE)}, cols, wanted, ["doc_id", "text", "kept"])
    assert got.columns == ["doc_id", "text", "kept", "v_raw", "v_again", "v_other"]
    n = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in texts]
    one = len(plain.encode("s", add_special_tokens=False).ids)
    assert [(r.v_raw, r.v_again, r.v_other) for r in got.orderBy("doc_id").collect()] == [(x, x, one) for x in n]
    assert count_tokens(df.limit(0), {"v": vocabulary(WORD_BPE)}, cols, wanted, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        count_tokens(df, {"v": vocabulary(WORD_BPE)}, cols, wanted, ["v_raw"])


def test_query_equals_recount(spark):
    import re
    from collections import Counter

    import pandas as pd
    import public_tokenizers
    from tokenizers import Tokenizer

    from alertscope.llm.queries import QUERIES
    from conftest import SF_SMALL

    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    byte, word = (Tokenizer.from_file(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    n, t = Counter(), Counter()
    seen = {}
    for d in docs.sort_values("doc_id").itertuples():
        text = d.text or ""
        copy = text in seen
        seen[text] = d.doc_id
        for name, tok, body in (("byte_bpe_50k", byte, re.sub(r"[\x20\x09-\x0D]+", " ", text)), ("word_bpe_49k", word, text)):
            key = (d.source, d.lang, name)
            n[key] += not copy
            t[key] += 0 if copy else len(tok.encode(body, add_special_tokens=False).ids)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in QUERIES["op2_token_counts"](spark, SF_SMALL).collect()}
    assert got == {k: (n[k], t[k]) for k in n}
