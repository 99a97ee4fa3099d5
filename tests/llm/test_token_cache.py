"""Cached encoding equals the tokenizers library on whole texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from alertscope.llm.token_cache import PieceEncoder, encoder, read_vocabulary

from conftest import SF_MID

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", " ", "\n", "a  b", "a \n b", "a\n\n\nb ", "  <|endoftext|>x", "don't  I'll\tgo", "x y", "\x1c a\x1cb",
       "a b", "é é", "ΑΣ ΣΑ", "1234 56", "​z", "a\r\nb", " ́x", "日本 語", "😀 😀", "<|startoftext|> a"]


@pytest.mark.parametrize("name", FILES)
def test_equals_library(name):
    vocabulary = read_vocabulary(public_tokenizers.path(name))
    own, plain = encoder(vocabulary), Tokenizer.from_str(vocabulary)
    texts = ODD + pd.read_parquet(f"{SF_MID}/documents.parquet")["text"].fillna("").tolist()
    for text, want in zip(texts, plain.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want.ids, repr(text[:80])
    assert own.encode(None) == b""


@pytest.mark.parametrize("name", FILES)
def test_equals_library_on_any_text(name):
    vocabulary = read_vocabulary(public_tokenizers.path(name))
    own, plain = encoder(vocabulary), Tokenizer.from_str(vocabulary)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\x85 aB'1,.é"), st.characters(codec="utf-8")), max_size=30))
    def check(text):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids

    check()


MIXED = ["a <|ENDOFTEXT|> b", "<|STARTOFTEXT|>", "x<|StartOfText|>y <|EndOfText|>", "<|EndOfText|> <|endoftext|>", "É <|ENDOFTEXT|>",
         "日 <|STARTOFTEXT|> a", "<|STARTOFTEXT|> new1 new2", "<|startoftext|> a <|ENDOFTEXT|>"]


@pytest.mark.parametrize("name", FILES)
def test_special_tokens_in_other_case_are_plain_text(name):
    vocabulary = read_vocabulary(public_tokenizers.path(name))
    own, plain = PieceEncoder(vocabulary), Tokenizer.from_str(vocabulary)
    for text in MIXED + MIXED:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want, text


@pytest.mark.parametrize("name", FILES)
def test_counts_equal_library(name, monkeypatch):
    from alertscope.llm import token_cache

    monkeypatch.setattr(token_cache, "CACHE_PIECES", 3000)  # filled and cleared on the way
    vocabulary = read_vocabulary(public_tokenizers.path(name))
    own, plain = token_cache.PieceCounter(vocabulary), Tokenizer.from_str(vocabulary)
    texts = ODD + MIXED + ["x" * 100 + " y " + "x" * 100] + pd.read_parquet(f"{SF_MID}/documents.parquet")["text"].fillna("").tolist()[:200]
    for text, want in zip(texts, plain.encode_batch(texts, add_special_tokens=False)):
        assert own.count(text) == len(want.ids), repr(text[:80])
    assert own.count(None) == 0 and token_cache.counter(vocabulary) is token_cache.counter(vocabulary)
