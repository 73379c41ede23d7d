"""Words, n-grams and their hashes for whole Arrow batches of texts, computed by numpy on the bytes.

A batch's texts lie end to end in one buffer, so every step is one vector operation over all its
documents. Hashes have 64 bits: a word's is a polynomial over random byte values, an n-gram's a
polynomial over mixed word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that are hashed at once; a longer text is a slice of its own.
SLICE_BYTES = 1_000_000
#: Bytes of text whose words are hashed at once, also within one text.
PIECE_BYTES = 1 << 18


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLAIN = mix(np.arange(256, dtype=np.uint64), 11)
_LOWER = _PLAIN.copy()
_LOWER[65:91] = _PLAIN[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


#: Bytes of letters: a-z, A-Z and all of other alphabets.
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


class Words(NamedTuple):
    """Words of several texts: text k has the words ``first[k]`` to ``first[k + 1]``.

    ``chars`` holds the bytes of all words end to end, each beginning at its ``packed``.
    """

    hashes: np.ndarray
    first: np.ndarray
    chars: np.ndarray
    packed: np.ndarray


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _packed_words(data: np.ndarray, offsets: np.ndarray, letters: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's first word, each word's place among the packed bytes, and those bytes, piece by piece."""
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    chars, first = np.empty(len(data), np.uint8), np.zeros(len(offsets), np.int64)
    packed, filled, n_words, open_word = [np.zeros(0, kind)], 0, 0, False
    for a in range(0, len(data), PIECE_BYTES):
        piece = data[a : a + PIECE_BYTES]
        inside = LETTER[piece] if letters else ~_SPACE[piece]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[0] &= not open_word
        low, high = np.searchsorted(offsets, [a, a + len(piece)])
        edges = offsets[low:high] - a
        begins[edges] = inside[edges]
        at = np.flatnonzero(begins)
        first[low:high] = n_words + np.searchsorted(at, edges)
        packed.append((np.cumsum(inside, dtype=np.int32)[at] + (filled - 1)).astype(kind))
        own = piece[inside]
        chars[filled : filled + len(own)] = own
        filled, n_words, open_word = filled + len(own), n_words + len(at), bool(inside[-1])
    first[np.searchsorted(offsets, len(data)) :] = n_words
    return first, np.concatenate(packed), chars[:filled]


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool, letters: bool = False) -> Words:
    """Hash every run of bytes other than ASCII white space, or of letters; texts end at their offsets.

    What is held besides the result is a few dozen bytes per byte of a piece, however long the texts
    or their words are.
    """
    first, packed, chars = _packed_words(data, offsets, letters)
    table = _LOWER if lower else _PLAIN
    hashes, power, begin = np.zeros(len(packed), np.uint64), powers(_BASE, PIECE_BYTES), 0
    while begin < len(packed):
        at = int(packed[begin])
        end = int(np.searchsorted(packed, at + PIECE_BYTES, side="right")) - 1
        end = len(packed) if len(chars) - at <= PIECE_BYTES else max(end, begin + 1)
        stop = int(packed[end]) if end < len(packed) else len(chars)
        if stop - at > PIECE_BYTES:
            total = 0
            for a in range(at, stop, PIECE_BYTES):
                part = table[chars[a : min(a + PIECE_BYTES, stop)]]
                total += int((part * power[: len(part)]).sum()) * pow(int(_BASE), a - at, 1 << 64)
            hashes[begin] = total % (1 << 64)
        else:
            near = packed[begin:end].astype(np.int64) - at
            lengths = np.diff(np.append(near, stop - at))
            place = np.arange(stop - at) - np.repeat(near, lengths)
            hashes[begin:end] = np.add.reduceat(table[chars[at:stop]] * power[place], near)
        hashes[begin:end] = mix(hashes[begin:end], 1)
        begin = end
    return Words(hashes, first, chars, packed)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (one fewer than n words: none), across text borders too."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= _BASE
        out += hashes[k : count + k]
    return mix(out, n)


def inner_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Word indexes at which n consecutive words of one text begin."""
    total = int(first[-1])
    good = np.ones(total, dtype=bool)
    for k in range(1, n):
        tail = first[1:] - k
        good[tail[tail >= first[:-1]]] = False
    return np.flatnonzero(good)


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, or of one longer text."""
    begin, n_texts = 0, len(offsets) - 1
    while begin < n_texts:
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), n_texts)
        yield begin, end
        begin = end
