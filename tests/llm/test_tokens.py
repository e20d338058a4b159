import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyloom.llm._tokens import Encoder
from tallyloom.llm.bpe import Bpe

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab Zé'sdlt,.!\n\r\t  09²ß\xa0\x1c<|endoftext|>"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=6)
FIXED = ["", None, "   ", "it's  we'll\n\n x", "<|endoftext|> a<|endoftext|>", "a\r\n b\t\tc ", "ΣΑΣ İ é", "x" * 5000, "don't 12345 ½", "<|startoftext|>hi<|endoftext|>"]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(BYTES)


@pytest.fixture(scope="module")
def bpe():
    return Bpe(WORDS)


def check_encoder(e, texts):
    ids, offsets = e.encode(texts)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == e.library.encode(t or "", add_special_tokens=False).ids


def check_bpe(b, texts):
    b.library.no_truncation()
    b.library.no_padding()
    ids, offsets = b.encode(texts)
    for i, t in enumerate(texts):
        want = b.library.encode(t or "", add_special_tokens=False).ids
        got = ids[offsets[i] : offsets[i + 1]].tolist()
        assert got == want
        assert b.decode(got) == b.library.decode(want, skip_special_tokens=False)


def test_fixed_texts(encoder, bpe):
    check_encoder(encoder, FIXED)
    check_bpe(bpe, FIXED)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_encoder_is_the_library(encoder, texts):
    check_encoder(encoder, texts)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_bpe_is_the_library(bpe, texts):
    check_bpe(bpe, texts)


def test_forgetting_changes_nothing():
    e = Encoder(BYTES, remembered=3)
    for _ in range(3):
        check_encoder(e, ["one two three four", "five six\n\nseven"])
    b = Bpe(WORDS, remembered=3)
    for _ in range(3):
        check_bpe(b, ["one two three four", "five sixes"])


def test_forced_boundaries_are_in_no_token(bpe):
    inside = {pair for token in bpe.vocabulary for pair in zip(token.removesuffix(bpe.end), token.removesuffix(bpe.end)[1:])}
    for word in ("qzqzword", "hello", "xqj"):
        parts = bpe.cut(word)
        assert "".join(parts) == word
        assert all((a[-1], b[0]) not in inside for a, b in zip(parts, parts[1:]))


def test_no_documents(encoder):
    ids, offsets = encoder.encode([])
    assert len(ids) == 0 and np.array_equal(offsets, [0])
