"""SentencePiece BPE encoding by a prefix table, and decoding.

A vocabulary's BPE result is settled by its neighbours: a token sequence is the result exactly if
every two neighbouring tokens, merged on their own, stay those two tokens. So every prefix of a
piece of text has one last token: of the vocabulary tokens that end there (an Aho-Corasick automaton
reports them), the one that goes with the last token of the prefix in front of it. The table of last
tokens is filled from the left, and the ids are read off it backwards.

Whether two tokens go together is found by undoing merges at their border, latest first, and asking
whether the border's two tokens would have merged earlier than what was undone.

Texts are cut where no token can reach across: before a space, and around characters of no token.
The results for such pieces are kept in a bounded cache, which changes no result. Runs of spaces
share one score; they are merged last and from the left, as the library does.

Defined cases: a null text is empty and has only the begin and end ids; characters of no token
become byte tokens; U+2581 counts as a space; repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from fraudspark.llm import shared

SPACE = "▁"
#: Bytes of results that each cache holds at most, and what an entry costs besides its texts; a pair of tokens is a number.
CACHE_BYTES, ENTRY_BYTES, PAIR_BYTES = 32_000_000, 180, 100
_RUNS = re.compile(" *[^ ]+| +")


class _Bounded(dict):
    """A dictionary that fills itself by a function and holds the results asked for of late.

    When half of its bytes are used it begins anew and keeps what it had as the older half, from which
    results that are asked for again come back; the rest goes at the next such turn. A result of more
    than a 16th of the bytes is not kept.
    """

    def __init__(self, fill, entry: int = ENTRY_BYTES):
        super().__init__()
        self._fill, self._entry, self._older, self._left = fill, entry, {}, CACHE_BYTES // 2

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._fill(key)
        size = self._entry + (2 * len(key) + len(value) if isinstance(key, str) else 0)
        if size > CACHE_BYTES // 16:
            return value
        if size > self._left:
            self._older = dict(self)
            super().clear()
            self._left = CACHE_BYTES // 2
        self._left -= size
        self[key] = value
        return value

    def clear(self) -> None:
        super().clear()
        self._older, self._left = {}, CACHE_BYTES // 2


class Bpe:
    """Encoder and decoder for one model file (BPE, byte fallback, no normalisation)."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        self.bos, self.eos = model.bos_id(), model.eos_id()
        self.bytes = {}
        self.control = {i for i in size if model.is_control(i)}
        self.output = [model.id_to_piece(i).replace(SPACE, " ").encode() for i in size]
        normal = {}
        for i in size:
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.bytes[value], self.output[i] = i, bytes([value])
            elif i in self.control:
                self.output[i] = b""
            elif model.is_unknown(i):
                self.output[i] = " ⁇ ".encode()
            elif not model.is_unused(i):
                normal[model.id_to_piece(i)] = i
        self._number(normal, {i: model.get_score(i) for i in normal.values()})
        self.alphabet = {c for piece in normal for c in piece}
        if len(self.bytes) < 256 or not self.alphabet <= normal.keys() or "\n" in self.alphabet:
            raise ValueError("the model needs byte tokens, a token per character, and no line end")
        self.packed = [struct.pack("<I", i) for i in self.ids]
        self.byte_ids = {v: struct.pack("<I", i) for v, i in self.bytes.items()}
        self._pairs = _Bounded(self._fits, PAIR_BYTES)
        #: Ids of a word after one space, of a word without it, and of other runs, as bytes.
        self.spaced = _Bounded(lambda w: self._pack(self._encode(SPACE + w)))
        self.bare = _Bounded(lambda w: self._pack(self._encode(w)))
        self.runs = _Bounded(self._encode_run)

    def forget(self) -> None:
        """Empty the caches."""
        for cache in (self._pairs, self.spaced, self.bare, self.runs):
            cache.clear()

    def _number(self, normal: dict[str, int], score: dict[int, float]) -> None:
        """Number the tokens in merge order, single characters first, and split each one."""
        blank = {p for p in normal if len(p) > 1 and not p.strip(SPACE)}
        if any(SPACE in p[1:] for p in normal if p not in blank):
            raise ValueError("a token reaches across a space")
        self.blank = {len(p): normal[p] for p in blank}
        merged = sorted((p for p in normal if len(p) > 1 and p not in blank), key=lambda p: -score[normal[p]])
        if len({score[normal[p]] for p in merged}) < len(merged):
            raise ValueError("tokens share a score")
        pieces = [p for p in normal if len(p) == 1] + merged
        self.ids = [normal[p] for p in pieces]
        self.text = pieces
        self.rank = {p: k for k, p in enumerate(pieces)}
        self.split: list[tuple[int, int] | None] = []
        self.lengths = [len(p) for p in pieces]
        self.single = {p: k for k, p in enumerate(pieces) if len(p) == 1}
        #: Tokens of several characters; those of one are at hand wherever none of these fits.
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, piece in enumerate(pieces):
            parts = self._merge(piece, below=k) if len(piece) > 1 else []
            self.split.append((parts[0], parts[1]) if len(parts) == 2 else None)
            if len(parts) == 2 and self.rank.get(piece) == k:
                self.automaton.add_word(piece, k)
        self.automaton.make_automaton()

    def _merge(self, piece: str, below: int) -> list[int]:
        """Merge a short text by tokens numbered below the given one, in order of merging."""
        parts = list(piece)
        while len(parts) > 1:
            best, at = min((self.rank.get(a + b, below), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def _fits(self, pair: int) -> bool:
        """Whether the tokens stay apart: no merge across the border comes in time."""
        left, right = divmod(pair, len(self.text))
        limit = len(self.text)
        while True:
            across = self.rank.get(self.text[left] + self.text[right])
            if across is not None and across < limit:
                return False
            a, b = self.split[left], self.split[right]
            if a is None and b is None:
                return True
            # Undo the later merge. Of equal tokens the left one was merged first.
            if a is not None and (b is None or left > right):
                limit, left = left, a[1]
            else:
                limit, right = right + 1, b[0]

    def _encode(self, piece: str) -> list[int]:
        """Token numbers of a piece without inner spaces; -1 - c for a character of no token.

        Every prefix has exactly one last token, so where no longer one goes with the token before it,
        it is the character itself.
        """
        last = [None, *map(self.single.get, piece)]
        lengths, pairs, many, done = self.lengths, self._pairs, len(self.text), 0
        # The longest match of an end comes first; the start of the piece goes with every token.
        for end, token in self.automaton.iter(piece):
            if end >= done:
                before = last[end + 1 - lengths[token]]
                if before is None or pairs[before * many + token]:
                    done = end + 1
                    last[done] = token
        out, at = [], len(piece)
        while at:
            token = last[at]
            if token is None:
                at -= 1
                out.append(-1 - ord(piece[at]))
            else:
                at -= lengths[token]
                out.append(token)
        return out[::-1]

    def _pack(self, tokens: list[int]) -> bytes:
        packed = self.packed
        return b"".join(
            [packed[t] if t >= 0 else b"".join(self.byte_ids[v] for v in chr(-1 - t).encode()) for t in tokens]
        )

    def _encode_run(self, run: str) -> bytes:
        """Ids of some spaces with the word after them, if any."""
        word = run.lstrip(" ")
        spaces = len(run) - len(word)
        tokens = self._encode((SPACE if spaces else "") + word)
        lone = self.rank[SPACE]
        spaces = max(spaces - 1, 0)
        if tokens and tokens[0] == lone:
            spaces, tokens = spaces + 1, tokens[1:]
        done: list[int] = []
        # The leftmost pair that makes a token, again and again: done holds what stands to the left.
        for _ in range(spaces):
            done.append(1)
            while len(done) > 1 and done[-2] + done[-1] in self.blank:
                done[-2:] = [done[-2] + done[-1]]
        return b"".join(
            self.packed[lone] if n == 1 else struct.pack("<I", self.blank[n]) for n in done
        ) + self._pack(tokens)

    def encode(self, text: str) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit integers."""
        out = [struct.pack("<I", self.bos)]
        text = text.replace(SPACE, " ")
        newline = self.byte_ids[10]
        if text:
            lines = (" " + text).split("\n")
            for k, line in enumerate(lines):
                if k:
                    out.append(newline)
                if "  " in line or line[-1:] == " ":
                    out += map(self.runs.__getitem__, _RUNS.findall(line))
                elif line:
                    first, *rest = line.split(" ")
                    if first:
                        out.append(self.bare[first])
                    out += map(self.spaced.__getitem__, rest)
        out.append(struct.pack("<I", self.eos))
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the text; control ids vanish, a broken byte becomes U+FFFD."""
        ids = [i for i in ids if i not in self.control]
        out = b"".join(map(self.output.__getitem__, ids))
        if ids and self.output[ids[0]][:1] == b" " and ids[0] not in self.bytes.values():
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:
            while True:
                try:
                    out.decode()
                    break
                except UnicodeDecodeError as broken:
                    at = broken.start
                    out = out[:at] + "�".encode() + out[at + 1 :]
        return out


_models: dict[str, Bpe] = {}


def model(path: str) -> Bpe:
    """The model of this worker process, loaded once."""
    if path not in _models:
        _models[path] = Bpe(path)
    return _models[path]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document its ``ids``, begin and end included, their number, the digest of the ids and that
    of the text decoded from them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(model_path)
        for batch in batches:
            # Some hundred texts at a time, so that a batch's ids don't pile up.
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                packed = [bpe.encode(text.as_py() or "") for text in part["text"]]
                ids = np.frombuffer(b"".join(packed), "<i4")
                ends = np.cumsum([0] + [len(p) // 4 for p in packed])
                decoded = [bpe.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"].cast(pa.int64()),
                        "n_tokens": pa.array(np.diff(ends), pa.int64()),
                        "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                        "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in decoded]),
                        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    }
                )
        # The worker goes on to other stages.
        bpe.forget()
        shared.give_back()

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>"
    )


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    return encode(docs, model_path).drop("ids")
