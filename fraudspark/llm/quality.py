"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its character trigrams, the trigrams of its shape (letters, capitals, digits and
blanks each count as one character) and words that repeat the word before; trigrams are hashed to
``HASHED`` columns each. Square roots of the counts, weighted by inverse document frequency and
scaled to length one, are projected on the leading singular vectors of the labelled sample.

The labelled vectors, at most ``2 * SAMPLE`` of ``RANK`` numbers, are broadcast. Every document is
compared with all of them, by cosine, in blocks; the labels of the ``NEIGHBOURS`` most similar ones
are averaged with their similarity as weight. The vectors come from a sample: at most ``SAMPLE`` rows of
each label, by a hash of their id, of texts up to ``toxicity.SAMPLE_CHARS`` characters. Document
frequencies are counted over all documents, in one pass that returns a sum per column and task.
Documents are read whole.

Defined cases: a null or empty text, like any without positive similarity, gets the mean label of
the sample; without labelled rows every score is 0; repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import shared, words
from fraudspark.llm.toxicity import sample

HASHED = 1024
COLUMNS = 2 * HASHED + 1
RANK = 48
NEIGHBOURS = 15
SAMPLE = 1500
THRESHOLD = 0.3
#: Texts whose counts are held as a dense block.
BLOCK = 256

_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[97:123] = _SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[[9, 10, 11, 12, 13]] = 32
_RAW = np.arange(256, dtype=np.uint64)
_RAW[65:91] += np.uint64(32)


def _trigrams(codes: np.ndarray, seed: int) -> np.ndarray:
    key = (codes[:-2] << np.uint64(16)) | (codes[1:-1] << np.uint64(8)) | codes[2:]
    return (words.mix(key, seed) % np.uint64(HASHED)).astype(np.int64)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term counts, one row per text."""
    n = len(offsets) - 1
    out = np.zeros((n, COLUMNS), np.float32)
    if len(data) >= 3:
        owner = np.repeat(np.arange(n), np.diff(offsets))
        whole = owner[:-2] == owner[2:]
        for k, table in enumerate((_RAW, _SHAPE)):
            at = owner[:-2][whole] * HASHED + _trigrams(table[data], 20 + k)[whole]
            found = np.bincount(at, minlength=n * HASHED).reshape(n, HASHED)
            out[:, k * HASHED : (k + 1) * HASHED] = found
    found = words.hash_words(data, offsets, lower=True)
    if len(found.hashes) > 1:
        owner = np.repeat(np.arange(n), np.diff(found.first))
        same = (found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1])
        out[:, -1] = np.bincount(owner[1:][same], minlength=n)
    return out


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many of them each column's term occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last number is that of the documents.
        total = np.zeros(COLUMNS + 1, np.int64)
        for batch in batches:
            data, offsets = words.texts_of(batch["text"])
            total[-1] += batch.num_rows
            for a, b in _blocks(offsets):
                found = counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total[:-1] += np.count_nonzero(found, axis=0)
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(COLUMNS + 1, dtype=np.int32)), "n": pa.array(total)})

    made = docs.select(shared.binary_text()).mapInArrow(work, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(COLUMNS + 1, np.int64)
    for row in made.collect():
        out[row["k"]] = row["n"]
    return int(out[-1]), out[:-1]


class Model:
    """Weights, singular vectors and the labelled vectors of a sample of (label, text).

    ``among`` and ``present`` are the number of documents and of those with each term.
    """

    def __init__(self, rows: list[tuple[int, str]], among: int, present: np.ndarray):
        self.labels = np.array([label for label, _ in rows], np.float32)
        data, offsets = words.texts_of(pa.array([t.encode() for _, t in rows], pa.large_binary()))
        found = np.concatenate(
            [counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in _blocks(offsets)]
        )
        self.weight = np.log((1 + among) / (1 + present)).astype(np.float32) + 1
        weighted = self._weighted(found)
        _, vectors = np.linalg.eigh(weighted.T @ weighted)
        self.axes = np.ascontiguousarray(vectors[:, ::-1][:, :RANK])
        self.vectors = _unit(weighted @ self.axes)

    def _weighted(self, found: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(found) * self.weight)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        near = _unit(self._weighted(counts(data, offsets)) @ self.axes) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        share = np.maximum(np.take_along_axis(near, best, axis=1), 0)
        total = share.sum(axis=1)
        voted = (share * self.labels[best]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, voted, self.labels.mean())


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, b in words.slices(offsets, 2_000_000):
        for begin in range(a, b, BLOCK):
            yield begin, min(begin + BLOCK, b)


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.texts_of(batch["text"])
            found = [np.zeros(0)]
            for a, b in _blocks(offsets):
                ends = offsets[a : b + 1] - offsets[a]
                found.append(
                    sent.value.scores(data[offsets[a] : offsets[b]], ends) if sent.value else np.zeros(b - a)
                )
            scores = np.clip(np.concatenate(found).astype(np.float64), 0, 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"].cast(pa.int64()),
                    "held_out": batch["held_out"],
                    "score": pa.array(scores),
                    "predicted": pa.array((scores >= threshold).astype(np.int32)),
                }
            )

    return docs.select("doc_id", "held_out", shared.binary_text()).mapInArrow(
        judge, "doc_id bigint, held_out boolean, score double, predicted int"
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows that aren't held out and score all rows."""
    held_out = shared.held_out(5, 0)
    rows = sample(docs, labels, "quality", ~held_out, SAMPLE)
    model = Model(rows, *frequencies(docs)) if rows else None
    return score(docs.withColumn("held_out", held_out), model)
