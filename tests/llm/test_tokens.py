"""BPE against the public library; packing as an exact round trip."""

from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_fixture import corpus, corpus_rows, nothing  # noqa: F401

from forgeline.llm import bpe, packing


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encode_decode(corpus, corpus_rows, word_tokenizer):
    got = Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe.encode_decode(corpus, block_chars=20000).collect())
    want = Counter()
    for r in corpus_rows:
        ids = word_tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], np.array(ids, "<u4").tobytes(), word_tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(word_tokenizer, texts):
    texts += ["aaaaaaa aaa", "<|startoftext|>x<|endoftext|>", "ΟΔΟΣ İ", "it's we'LL", "\U00031350\x85 "]
    for t, (ids, shown) in zip(texts, bpe.load().encode_block(texts)):
        want = word_tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert shown.decode() == word_tokenizer.decode(want, skip_special_tokens=False)


def test_characters_newer_than_the_library(word_tokenizer):
    """A character that only some of the Unicode tables in use know is split as the library does."""
    texts = [f":{c}a{c}7{c}" for c in "\U0003d000\u0558\u088f\u1acf\U0003fc3f\u0378\U00031350"]
    for t, (ids, _) in zip(texts, bpe.load().encode_block(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == word_tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_byte_ids(byte_tokenizer, text):
    for t in (text, "a<|endoftext|> b" + text):
        assert packing.token_ids(packing.byte_encoder(), t).tolist() == [*byte_tokenizer.encode(t, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("length,windows,fan_in", [(2048, 32, 16), (64, 2, 2), (64, 1, 1)])
def test_packing(corpus, corpus_rows, byte_tokenizer, length, windows, fan_in):
    pieces = packing.pack(corpus, length, windows, fan_in).collect()
    pad = brute.check_packing([r.asDict() for r in pieces], [(r[0], r[1]) for r in corpus_rows], lambda t: byte_tokenizer.encode(t, add_special_tokens=False).ids, length)
    assert pad == 0


def test_nothing(nothing):
    assert packing.pack(nothing).count() == 0 and bpe.encode_decode(nothing).count() == 0
