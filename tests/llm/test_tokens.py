"""Token ids of words whose letters are composed before they are folded."""

import random

import numpy as np
import pyarrow as pa
import pytest

from vellumark.llm import chunked_bpe, tokens

DECOMPOSED = ["T\u0308x", "H\u0331", "J\u030c", "W\u030a", "Y\u030a", "A\u0308 PLAIN T\u0308x\u00c4", "e\u0301 E\u0301 \u0130I\u0307", "<|endoftext|> T\u0308x"]


def test_decomposed_capitals():
    path = tokens.tokenizer_path()
    library = tokens.encoder(path).library
    for texts in (DECOMPOSED[:-1], DECOMPOSED):
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        for coder in (tokens.WordEncoder(path), chunked_bpe.ChunkEncoder(path)):
            ids, bounds = coder.encode(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want


@pytest.fixture(scope="module")
def library():
    return tokens.encoder(tokens.tokenizer_path()).library


def test_units_equal_the_library_on_random_texts(library):
    """Letters, digits, signs, apostrophes, composing marks and special tokens in any order; words remembered and not."""
    draw = random.Random(5)
    parts = [*"abcXYZ019 \n\t.,;:'’\"<>|()=-_éÀßÿ×÷½ñ̸̈İ日本\x1c\x00\x7f\x85\xa0🙂Σςǅ", "'s", "'T", "T̈", "<|endoftext|>", "<|", "<|EndOfText|>"]
    for _ in range(60):
        texts = ["".join(draw.choices(parts, k=draw.randint(0, 60))) for _ in range(30)]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        ids, bounds = tokens.encoder(tokens.tokenizer_path()).encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want


def test_words_of_one_hash_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(tokens, "span_hashes", lambda body, begins, ends: (ends - begins).astype(np.uint64))
    coder = tokens.WordEncoder(tokens.tokenizer_path())
    for texts in (["some words have equal hash", "here"], ["four five nine same hash some"], ["some here words"]):
        ids, bounds = coder.encode(pa.array(texts))
        assert ids.tolist() == [i for e in library.encode_batch(texts, add_special_tokens=False) for i in e.ids]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte_bpe_50k"):
        tokens.WordEncoder(tokens.tokenizer_path("byte_bpe_50k.json"))
