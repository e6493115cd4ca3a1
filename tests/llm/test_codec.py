"""The codec against the library on texts that tempt it: joins of pieces, odd blanks, special strings, contractions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewake.llm import codec
from tidewake.llm.codec import Codec
from tidewake.llm.text import Texts
from tidewake.llm.token_counts import vocabulary_path

PARTS = [
    " ", " ", " ", "\n", "\n", "  ", "\t", "\r\n", " ", " ", "​", "　", "\x85", "\x1c", "\x7f", "\0", "a", "Bar", "foo", "'s", "'ll", "don't", "1", "23", "456", "!", "...", "é", "é", "ÀÉ", "漢字", "😀", "👩‍👧",
    "<|endoftext|>", "<|startoftext|>", "İ", "ß", "_", "-", "ﬁ", "का", "ก็", "x" * 40,
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("joined", [1, 64, 1 << 13])
def test_random_texts(monkeypatch, name, joined):
    monkeypatch.setattr(codec, "JOINED_BYTES", joined)
    path = vocabulary_path(name)
    own, library, rng = Codec(path), Tokenizer.from_file(path), random.Random(joined)
    for _ in range(12):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 2, 5, 30]))) for _ in range(150)]
        ids, sizes = own.encode(Texts(pa.array(texts)))
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for k, w in enumerate(want):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == w, texts[k]


def test_only_ids_of_bytes_are_joined():
    assert codec.id_bytes(vocabulary_path("word_bpe_49k.json")) is None
    sizes = codec.id_bytes(vocabulary_path("byte_bpe_50k.json"))
    assert len(sizes) == 50257 and sizes.min() == 1 and sizes[50256] == len("<|endoftext|>")
