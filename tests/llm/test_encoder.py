"""Pieces of texts are looked up all at once, and give the ids of whole texts."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from newsloom.llm.encoder import PieceEncoder  # noqa: E402
from newsloom.llm.token_files import tokenizer_path  # noqa: E402


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda texts: [[*e.ids, 0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def coded(encoder, texts):
    ids, sizes = encoder.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def steps(encoder, texts):
    """Calls that Python makes."""
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        encoder.encode(texts)
    finally:
        sys.setprofile(None)
    return calls


def test_known_texts_take_no_steps_of_their_own():
    encoder = PieceEncoder(tokenizer_path(), 0)
    texts = ["The words, of these\ntexts are known. "] * 4_000
    encoder.encode(texts)
    assert steps(encoder, texts) < 1.5 * steps(encoder, texts[:1_000])


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_parts_of_arrow_columns(library, kind):
    texts = [None, "a b", "", "über, größer", None, "a b"]
    encoder = PieceEncoder(tokenizer_path(), 0)
    for a, b in [(0, 6), (1, 3), (4, 5), (2, 2)]:
        ids, sizes = encoder.encode(pa.array(texts, kind).slice(a, b - a))
        assert sizes.tolist() == [len(x) for x in library(texts[a:b])]
        assert ids.tolist() == [i for x in library(texts[a:b]) for i in x]


def test_borders_of_pieces(library):
    odd = [*map(chr, range(0x250)), *"̀٠ ᠎  ​    Ω　中﻿\U0001d400\U0001f600"]
    texts = [f"a{x}b {x}c, {x}{x} ,{x}\n{x} d{x}" for x in odd] + [f"é{x}'s {x}'ll{x}\t{x} x{x}" for x in odd]
    encoder = PieceEncoder(tokenizer_path(), 0)
    assert coded(encoder, texts) == library(texts)


def test_pieces_that_differ_in_length_or_by_zeros(library):
    texts = ["a", "a\0", "a\0\0", "\0", "x" * 14, "x" * 14 + "\0", "x" * 15, "x" * 16, "x" * 17, " " * 40 + "a" + " " * 40]
    encoder = PieceEncoder(tokenizer_path(), 0)
    for _ in range(2):
        assert coded(encoder, texts) == library(texts)


def test_what_is_remembered_of_long_pieces_is_bounded(library):
    rng = random.Random(3)
    encoder = PieceEncoder(tokenizer_path(), 0, 1_000)
    for _ in range(40):
        text = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(2_000))
        assert coded(encoder, [text, text]) == library([text, text])
    assert len(encoder.ids) <= 1 << 16
