"""Substring deduplication by repeated-phrase automata.

A phrase is ``window`` consecutive words of one document. Every word that lies in a phrase which also
begins in a document of smaller id is removed; phrases are judged on the input.

1. *Candidates.* A phrase's anchor is the smallest hash of its seven-word runs, so equal phrases have
   equal anchors, while neighbouring phrases share one and only a quarter of them is sent. Anchors of
   two documents or more stay.
2. *Confirmed phrases.* Phrases with such an anchor are exchanged by their own hash: 64 bits, and a
   part number from independent bits. Every block learns the smallest document of those of its
   phrases that begin in a smaller document than one of its own.
3. *Automata.* Each block joins its confirmed phrases to passages, the longest runs of them, and
   compiles these, as sequences of words, to an Aho-Corasick automaton, its shard. All documents of
   the block stream through it.

A block's automaton holds only passages of that block, so memory is bounded by the block's size, and
a phrase shared by very many documents counts once per block.

Defined cases: a null text has no words; a text shorter than the window loses nothing; rows without
id count as later than all ids and not as smaller than each other; rows with the same id do not
remove each other's words; repeated rows each get a row; other columns are left out.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import exchange, shared, words

RUN = 7
#: Words are spelled to the automaton in this base.
DIGIT = 64
LAST = np.iinfo(np.int64).max
KEPT = "doc_id bigint, copies bigint, n_words bigint, n_removed bigint, kept string"


class _Block:
    """Windows of a block's documents: word index, owner and anchor of each."""

    def __init__(self, table: pa.Table, window: int):
        self.table = exchange.in_order(table)
        data, offsets = words.texts_of(self.table["text"])
        self.data, self.offsets = data, offsets
        self.words = words.hash_words(data, offsets, lower=False)
        self.at = words.inner_starts(self.words.first, window)
        self.doc = np.searchsorted(self.words.first, self.at, side="right") - 1
        self.ids = self.table["doc_id"].fill_null(LAST).to_numpy().astype(np.int64)
        run = min(RUN, window)
        runs = words.ngrams(self.words.hashes, run)
        least = runs[self.at] if len(self.at) else np.zeros(0, np.uint64)
        for k in range(1, window - run + 1):
            least = np.minimum(least, runs[self.at + k])
        self.anchor = least

    def phrases(self, window: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window and its part, from other bits of the words' hashes."""
        other = words.ngrams(words.mix(self.words.hashes, 77), window)
        part = (other % np.uint64(parts)).astype(np.int32)
        return words.ngrams(self.words.hashes, window)[self.at], part[self.at]


def _least_and_most(keys: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First index of each distinct key (several columns), and the smallest and largest id."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    begins = np.flatnonzero(new)
    if not len(begins):
        return order, ids[:0], ids[:0]
    ordered = ids[order]
    return order[begins], np.minimum.reduceat(ordered, begins), np.maximum.reduceat(ordered, begins)


def _anchors(docs: DataFrame, parts: int, window: int) -> DataFrame:
    def send(table: pa.Table) -> pa.Table:
        shared.give_back()
        block = _Block(table, window)
        keep = np.ones(len(block.at), dtype=bool)
        keep[1:] = (block.anchor[1:] != block.anchor[:-1]) | (block.doc[1:] != block.doc[:-1])
        anchor = block.anchor[keep]
        first, least, most = _least_and_most([anchor], block.doc[keep])
        numbers = np.where(least == most, 1, 2).astype(np.uint8)
        keys = anchor[first]
        return exchange.packed(table["block"][0].as_py(), keys, exchange.part_of(keys, parts), numbers)

    def answer(group: np.ndarray, begins: np.ndarray, part: pa.Table) -> pa.Table:
        recurs = np.bincount(group, exchange.numbers_of(part, np.uint8))[group] >= 2
        return _replies(part, begins, recurs, None)

    return exchange.answered(docs.groupBy("block").applyInArrow(send, exchange.KEYED), answer)


def _replies(part: pa.Table, begins: np.ndarray, wanted: np.ndarray, numbers: np.ndarray | None) -> pa.Table:
    """The wanted keys of each block's row, with the numbers that belong to them."""
    keys, values = [], []
    for row, (a, b) in enumerate(zip(begins[:-1], begins[1:], strict=True)):
        own = np.frombuffer(part["keys"][row].as_py(), np.uint64)
        keys.append(own[wanted[a:b]].tobytes())
        values.append(b"" if numbers is None else numbers[a:b][wanted[a:b]].tobytes())
    return pa.table(
        {"block": part["block"], "part": part["part"], "keys": pa.array(keys, pa.binary()), "numbers": pa.array(values, pa.binary())}
    )


def _received(replies: pa.Table) -> np.ndarray:
    found = [np.frombuffer(k.as_py(), np.uint64) for k in replies["keys"]]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _phrases(docs: DataFrame, anchors: DataFrame, parts: int, window: int) -> DataFrame:
    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        shared.give_back()
        if not table.num_rows:
            return exchange.packed(0, np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros((0, 2), np.int64))
        block = _Block(table, window)
        known = _received(replies)
        at = np.searchsorted(known, block.anchor)
        good = known[np.minimum(at, len(known) - 1)] == block.anchor if len(known) else np.zeros(len(at), bool)
        phrase, part = block.phrases(window, parts)
        phrase, part = phrase[good], part[good]
        first, least, most = _least_and_most([part, phrase], block.ids[block.doc[good]])
        return exchange.packed(
            table["block"][0].as_py(), phrase[first], part[first], np.stack([least, most], axis=1)
        )

    def answer(group: np.ndarray, begins: np.ndarray, part: pa.Table) -> pa.Table:
        numbers = exchange.numbers_of(part, np.int64).reshape(-1, 2)
        least = np.full(int(group.max()) + 1 if len(group) else 0, LAST)
        np.minimum.at(least, group, numbers[:, 0])
        return _replies(part, begins, least[group] < numbers[:, 1], least[group])

    sent = docs.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(send, exchange.KEYED)
    return exchange.answered(sent, answer)


def _letters(codes: np.ndarray, vocabulary: int) -> tuple[str, int]:
    """Word numbers as a string, and the letters per word.

    The automaton searches a node's children one by one, so a word is spelled by digits of a small
    base. The first digit has letters of its own, so that phrases match at word borders only.
    """
    digits = 1
    while DIGIT**digits < vocabulary:
        digits += 1
    spelled = np.empty((len(codes), digits), "<u4")
    for k in range(digits):
        spelled[:, k] = codes // DIGIT ** (digits - 1 - k) % DIGIT + (0x100 if k == 0 else 0x200)
    return spelled.tobytes().decode("utf-32-le"), digits


def _least_of_windows(block: _Block, phrases: pa.Table, parts: int, window: int) -> np.ndarray:
    """Smallest document of each window of the block, as far as confirmed."""
    phrase, part = block.phrases(window, parts)
    least = np.full(len(phrase), LAST)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for row in range(phrases.num_rows):
        known = np.frombuffer(phrases["keys"][row].as_py(), np.uint64)
        if not len(known):
            continue
        p = phrases["part"][row].as_py()
        mine = order[edges[p] : edges[p + 1]]
        sort = np.argsort(known)
        at = np.minimum(np.searchsorted(known[sort], phrase[mine]), len(known) - 1)
        hit = known[sort][at] == phrase[mine]
        least[mine[hit]] = np.frombuffer(phrases["numbers"][row].as_py(), np.int64)[sort][at[hit]]
    return least


def _automaton(block: _Block, text: str, digits: int, least: np.ndarray, window: int):
    """The block's shard, and for each passage the largest of its windows' smallest documents.

    A passage is a longest run of windows of one document that begin in a smaller document each. It
    is gone from every document larger than all of those, among them its own.
    """
    good = least < block.ids[block.doc] if len(block.doc) else np.zeros(0, bool)
    at, doc = block.at[good], block.doc[good]
    if not len(at):
        return None, [], []
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(new)
    lasts = np.append(begins[1:], len(at)) - 1
    largest = np.maximum.reduceat(least[good], begins)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, (a, b) in enumerate(zip(at[begins].tolist(), (at[lasts] + window).tolist(), strict=True)):
        automaton.add_word(text[a * digits : b * digits], k)
    automaton.make_automaton()
    return automaton, largest.tolist(), (at[lasts] + window - at[begins]).tolist()


def _mark(docs: DataFrame, phrases: DataFrame, parts: int, window: int) -> DataFrame:
    def mark(table: pa.Table, replies: pa.Table) -> pa.Table:
        shared.give_back()
        out: dict[str, list] = {"doc_id": [], "copies": [], "n_words": [], "n_removed": [], "kept": []}
        if table.num_rows:
            block = _Block(table, window)
            numbers: dict[bytes, int] = {}
            texts = [
                block.data[a:b].tobytes().split()
                for a, b in zip(block.offsets[:-1], block.offsets[1:], strict=True)
            ]
            codes = np.fromiter(
                (numbers.setdefault(w, len(numbers)) for text in texts for w in text), np.int64, int(block.words.first[-1])
            )
            spelled, digits = _letters(codes, len(numbers))
            least = _least_of_windows(block, replies.combine_chunks(), parts, window)
            automaton, largest, length = _automaton(block, spelled, digits, least, window)
            out["doc_id"] = block.table["doc_id"].to_pylist()
            out["copies"] = block.table["copies"].to_pylist()
            for k, found in enumerate(texts):
                gone = np.zeros(len(found) + 1, np.int32)
                if automaton is not None and len(found) >= window:
                    own, first = int(block.ids[k]), int(block.words.first[k])
                    hits = [
                        (end // digits + 1, length[passage])
                        for end, passage in automaton.iter(spelled[first * digits : (first + len(found)) * digits])
                        if largest[passage] < own
                    ]
                    if hits:
                        ends, lengths = np.array(hits, np.int64).T
                        np.add.at(gone, ends - lengths, 1)
                        np.add.at(gone, ends, -1)
                keep = np.cumsum(gone[:-1]) == 0
                out["n_words"].append(len(found))
                out["n_removed"].append(int(len(found) - keep.sum()))
                kept = found if keep.all() else [found[i] for i in np.flatnonzero(keep).tolist()]
                out["kept"].append(b" ".join(kept).decode("utf-8", "replace"))
        return pa.table(
            {
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "copies": pa.array(out["copies"], pa.int64()),
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "kept": pa.array(out["kept"], pa.string()),
            }
        )

    return docs.groupBy("block").cogroup(phrases.groupBy("block")).applyInArrow(mark, KEPT)


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """Per document the kept words, joined by one space, and the counts of words and removed words."""
    frame, parts = exchange.blocked(docs)
    anchors = _anchors(frame, parts, window)
    return exchange.spread(_mark(frame, _phrases(frame, anchors, parts, window), parts, window))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
