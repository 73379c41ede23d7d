"""What the token caches keep, and that no word comes out differently by them."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import sentencepiece

from fraudspark.llm import sentencepiece_bpe

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_a_full_cache_keeps_what_is_asked_for_again(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CACHE_BYTES", 40_000)
    made = []
    cache = sentencepiece_bpe._Bounded(lambda w: made.append(w) or w.encode())
    for k in range(2_000):
        assert cache["often"] == b"often" and cache[f"w{k}"] == f"w{k}".encode()
    assert made.count("often") == 1
    assert (len(cache) + len(cache._older)) * sentencepiece_bpe.ENTRY_BYTES <= 40_000
    cache["x" * 3_000]
    assert "x" * 3_000 not in cache
    cache.clear()
    assert not cache and not cache._older


def test_words_of_few_tokens_are_the_library(monkeypatch):
    """Long and mixed words, with caches that are full at once."""
    monkeypatch.setattr(sentencepiece_bpe, "CACHE_BYTES", 8_000)
    library, bpe = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentencepiece_bpe.Bpe(MODEL)
    rng = random.Random(5)
    for _ in range(300):
        text = " ".join(
            "".join(rng.choice("thentionésgr0.☃") for _ in range(rng.choice((1, 2, 5, 9, 40)))) for _ in range(30)
        )
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True), text
