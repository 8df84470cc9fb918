"""What an encoder remembers is bounded in bytes, and long texts go in parts."""

from __future__ import annotations

import random
import sys

import numpy as np
import pytest
import tiktoken

from shardloom.llm import bpe
from shardloom.llm.queries import tokenizer


@pytest.fixture(scope="module")
def library():
    ranks, pattern = tokenizer()
    return tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def remembered(encoder):
    held = [d for cache in (encoder.units, encoder.pieces) for d in (cache.young, cache.old)]
    return sum(sys.getsizeof(d) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in d.items()) for d in held)


def test_unrepeated_words_do_not_fill_a_worker(library):
    encoder, rng = bpe.Encoder(*tokenizer()), random.Random(2)
    limit = 1.6 * 2 * (bpe.UNIT_BYTES + bpe.PIECE_BYTES)
    for kind in range(24):
        if kind % 3:
            words = [f"{rng.getrandbits(40):x}" for _ in range(60_000)]
        else:  # long units without blanks, of which nothing is kept
            words = ["".join(rng.choices("abcdeé-1", k=700)) for _ in range(600)]
        text = " ".join(words)
        assert np.frombuffer(encoder(text), np.int32).tolist() == library.encode_ordinary(text)
        assert remembered(encoder) < limit
    assert all(len(k) <= bpe.REMEMBERED for k in encoder.units.young | encoder.pieces.young)


def test_remembered_ids_survive_turns(library, monkeypatch):
    monkeypatch.setattr(bpe, "UNIT_BYTES", 4000)
    monkeypatch.setattr(bpe, "PIECE_BYTES", 3000)
    encoder, rng = bpe.Encoder(*tokenizer()), random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "be,ta", "  ", "x\n", "42", f"{rng.random()}"]) for _ in range(60)) for _ in range(300)]
    for at in range(0, 300, 7):
        for t, ids in zip(texts[at : at + 7], encoder.batch(texts[at : at + 7])):
            assert np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(t)


def test_long_texts_in_parts_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 50)
    rng = random.Random(4)
    parts = [" ", " ", "  ", "\n", "\t", "word", "Größe", "1234", "don't", "...", " ", "漢字", "a" * 80]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 120)))
        assert np.frombuffer(ENC(text), np.int32).tolist() == library.encode_ordinary(text)


ENC = bpe.Encoder(*tokenizer())


def test_decoding_in_pieces(monkeypatch):
    import pyarrow as pa

    ranks, _ = tokenizer()
    table = bpe.token_bytes(ranks)
    text = "Some text, with 12 Größen and 漢字. " * 50
    ids = pa.array([np.frombuffer(ENC(text), np.int32)])[0]
    for size in (1, 7, 1 << 18):
        monkeypatch.setattr(bpe, "DECODE_IDS", size)
        assert bpe._decode(ids, *table).decode() == text
