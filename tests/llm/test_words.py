"""Hashing of words: whole texts in bounded memory, whatever the pieces."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from fraudspark.llm import words


def laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])


@pytest.mark.parametrize("letters", [False, True])
def test_pieces_change_nothing(monkeypatch, letters):
    rng = random.Random(1)
    for _ in range(100):
        texts = ["".join(rng.choice("ab \n\tÉz1") for _ in range(rng.choice((0, 1, 5, 40, 300)))).encode() for _ in range(rng.randrange(6))]
        data, offsets = laid(texts)
        whole = words.hash_words(data, offsets, True, letters)
        for piece in (1, 7, 64):
            monkeypatch.setattr(words, "PIECE_BYTES", piece)
            cut = words.hash_words(data, offsets, True, letters)
            assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))
        monkeypatch.undo()
        if not letters:
            found = [t.split() for t in texts]
            assert np.diff(whole.first).tolist() == [len(w) for w in found]
            flat = [w.lower() for f in found for w in f]
            same = {}
            for w, h in zip(flat, whole.hashes.tolist(), strict=True):
                assert same.setdefault(w, h) == h
            assert len(set(same.values())) == len(same)


def test_memory_of_one_long_text():
    data, offsets = laid([(b"loremlo ipsumipsum dolordo sitamet " * 2_000_000)[:64_000_000]])
    tracemalloc.start()
    found = words.hash_words(data, offsets, lower=True)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found.first[-1] > 7_000_000 and peak < 230_000_000 and peak - held < 80_000_000
