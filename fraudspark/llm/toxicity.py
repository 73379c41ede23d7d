"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

The network reads words. A word's input is the sum of a vector of its own (words that are frequent
in the training sample) and the mean vector of its character trigrams (hashed), so that it also
knows unseen forms of a word. Attention over a window's states picks the words that matter, and a
logistic unit scores the window. All overlapping windows of ``WINDOW`` words, ``STRIDE`` apart, are
scored; a document's score is its highest window's.

Training (numpy, backpropagation through time) sees a bounded sample of labelled rows: at most
``SAMPLE`` of each label, by a hash of their id, of texts up to ``SAMPLE_CHARS`` characters. A label
belongs to a document, not a window: the first steps learn from windows drawn at random, the later
ones from each document's highest window, half of the harmless ones from those that score highest.

Words are runs of letters, A-Z lower-cased. Defined cases: a null or wordless text is scored as a
window of padding; without labelled rows every score is 0; repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import gru, shared, words

UNITS, WIDTH = 8, 12
WINDOW, STRIDE = 48, 24
TRIGRAMS = 4096
MIN_COUNT = 10
SAMPLE, SAMPLE_CHARS = 1200, 20_000
STEPS, RANDOM_STEPS, BATCH, RATE = 800, 300, 64, 0.01
THRESHOLD = 0.3


class Texts:
    """Distinct words of some texts with their trigrams, and the words of each text by number."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        found = words.hash_words(data, offsets, lower=True, letters=True)
        self.first = found.first
        self.hashes, at, self.codes = np.unique(found.hashes, return_index=True, return_inverse=True)
        chars = np.where((found.chars >= 65) & (found.chars <= 90), found.chars + 32, found.chars).astype(np.uint32)
        ends = np.append(found.packed[1:], len(chars))
        begin, length = found.packed[at], (ends - found.packed)[at]
        # The bytes of each distinct word between two marks, and every three in a row.
        size = length + 2
        self.tri_first = np.append(0, np.cumsum(size - 2)).astype(np.int64)
        edge = np.append(0, np.cumsum(size)).astype(np.int64)
        place = np.arange(edge[-1]) - np.repeat(edge[:-1], size)
        source = np.repeat(begin, size) + place - 1
        marked = np.zeros(edge[-1], np.uint32)
        inside = (place > 0) & (place <= np.repeat(length, size))
        marked[inside] = chars[source[inside]]
        three = marked[:-2] * 65599 * 65599 + marked[1:-1] * 65599 + marked[2:] if len(marked) else marked
        keep = place[: len(three)] < np.repeat(length, size)[: len(three)]
        mixed = words.mix(three[keep].astype(np.uint64), 3)
        self.trigrams = (mixed % np.uint64(TRIGRAMS)).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all windows (time, window; padding is -1), and the text of each."""
        count = np.diff(self.first)
        many = np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1)
        owner = np.repeat(np.arange(len(count)), many)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        return self.first[:-1][owner] + within * STRIDE, owner

    def fill(self, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
        at = starts[None, :] + np.arange(WINDOW)[:, None]
        inside = at < self.first[1:][owner][None, :]
        if not len(self.codes):
            return np.full(at.shape, -1)
        return np.where(inside, self.codes[np.minimum(at, len(self.codes) - 1)], -1)


class Model:
    def __init__(self, known: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.known = known
        self.p: gru.Params = {
            "word": gru.normal(rng, len(known) + 1, WIDTH, scale=0.1),
            "char": gru.normal(rng, TRIGRAMS, WIDTH, scale=0.3),
            "attend": gru.normal(rng, 2 * UNITS),
            "out": gru.normal(rng, 2 * UNITS),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("forth", "back"):
            self.p[f"in_{way}"] = gru.normal(rng, WIDTH, 3 * UNITS)
            self.p[f"u_{way}"] = gru.normal(rng, UNITS, 3 * UNITS)
            self.p[f"b_{way}"] = np.zeros(3 * UNITS, np.float32)

    def own(self, texts: Texts) -> np.ndarray:
        """Row of each distinct word in the word table; the last row is for all others."""
        if not len(self.known):
            return np.zeros(len(texts.hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, texts.hashes), len(self.known) - 1)
        return np.where(self.known[at] == texts.hashes, at, len(self.known))

    def inputs(self, texts: Texts) -> np.ndarray:
        """Input vector of each distinct word."""
        own = self.p["word"][self.own(texts)]
        if not len(own):
            return own
        sums = np.add.reduceat(self.p["char"][texts.trigrams], texts.tri_first[:-1], axis=0)
        return own + sums / np.diff(texts.tri_first)[:, None].astype(np.float32)

    def gates(self, inputs: np.ndarray, windows: np.ndarray, way: str) -> np.ndarray:
        table = np.zeros((len(inputs) + 1, 3 * UNITS), np.float32)
        table[:-1] = inputs @ self.p[f"in_{way}"] + self.p[f"b_{way}"]
        table[-1, :UNITS] = gru.HOLD
        return table[windows]

    def forward(self, inputs: np.ndarray, windows: np.ndarray, keep=None):
        """Score of each window, with states, attention and pooled states."""
        states = gru.both_ways(
            self.gates(inputs, windows, "forth"), self.gates(inputs, windows, "back"), self.p, keep
        )
        energy = states @ self.p["attend"]
        energy = np.where(windows < 0, np.float32(-30), energy)
        energy -= energy.max(axis=0)
        share = np.exp(energy)
        share /= share.sum(axis=0)
        pooled = np.einsum("tnu,tn->nu", states, share)
        return gru.sigmoid(pooled @ self.p["out"] + self.p["bias"]), states, share, pooled

    def slopes(self, texts: Texts, windows: np.ndarray, labels: np.ndarray) -> gru.Params:
        keep: tuple[list, list] = ([], [])
        used, inverse = np.unique(windows, return_inverse=True)
        all_inputs = self.inputs(texts)
        score, states, share, pooled = self.forward(all_inputs, windows, keep)
        d = ((score - labels) / len(labels)).astype(np.float32)
        out: gru.Params = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpooled = d[:, None] * self.p["out"]
        dshare = np.einsum("tnu,nu->tn", states, dpooled)
        denergy = share * (dshare - (share * dshare).sum(axis=0))
        denergy[windows < 0] = 0
        out["attend"] = np.einsum("tnu,tn->u", states, denergy)
        dstates = share[:, :, None] * dpooled[None] + denergy[:, :, None] * self.p["attend"]
        forth, back, inner = gru.slopes_both_ways(dstates, self.p, keep)
        dinput = np.zeros_like(all_inputs)
        real = windows >= 0
        for way, g in (("forth", forth), ("back", back)):
            table = np.zeros((len(all_inputs), 3 * UNITS), np.float32)
            np.add.at(table, windows[real], g[real])
            out[f"in_{way}"] = all_inputs.T @ table
            out[f"b_{way}"] = table.sum(axis=0)
            dinput += table @ self.p[f"in_{way}"].T
        out["word"] = np.zeros_like(self.p["word"])
        np.add.at(out["word"], self.own(texts), dinput)
        out["char"] = np.zeros_like(self.p["char"])
        many = np.diff(texts.tri_first)
        np.add.at(out["char"], texts.trigrams, np.repeat(dinput / many[:, None].astype(np.float32), many, axis=0))
        return out | inner

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest window score of each text, and where that window begins (its word)."""
        texts = Texts(data, offsets)
        inputs = self.inputs(texts)
        starts, owner = texts.windows()
        score = np.concatenate(
            [
                self.forward(inputs, texts.fill(starts[a : a + 2048], owner[a : a + 2048]))[0]
                for a in range(0, len(owner), 2048)
            ]
        )
        edge = np.searchsorted(owner, np.arange(len(offsets) - 1))
        best = np.maximum.reduceat(score, edge)
        top = np.flatnonzero(score == best[owner])
        _, first = np.unique(owner[top], return_index=True)
        return best, starts[top[first]]


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return words.texts_of(pa.array([t.encode() for t in texts], pa.large_binary()))


def train(rows: list[tuple[int, str]], seed: int = 5) -> Model | None:
    """Fit on (label, text) pairs, both labels drawn evenly."""
    labels = np.array([label for label, _ in rows])
    if not rows or labels.min() == labels.max():
        return None
    data, offsets = _joined([t for _, t in rows])
    texts = Texts(data, offsets)
    # In how many texts each word occurs.
    owner = np.repeat(np.arange(len(rows)), np.diff(texts.first))
    in_texts = np.bincount(np.unique(np.stack([owner, texts.codes]), axis=1)[1], minlength=len(texts.hashes))
    model = Model(texts.hashes[in_texts >= MIN_COUNT], seed)
    rng = np.random.default_rng(seed)
    adam = gru.Adam(model.p, RATE)
    by_label = [np.flatnonzero(labels == k) for k in (0, 1)]
    count = np.diff(texts.first)
    best = None
    for step in range(STEPS):
        if step >= RANDOM_STEPS and (step - RANDOM_STEPS) % 100 == 0:
            found, best = model.scores(data, offsets)
            hard = by_label[0][np.argsort(-found[by_label[0]])[: max(BATCH // 4, len(by_label[0]) // 12)]]
        chosen = np.concatenate([rng.choice(of, BATCH // 2) for of in by_label])
        if best is not None:
            chosen[: BATCH // 4] = rng.choice(hard, BATCH // 4)
        if best is None or step % 4 == 0:
            room = np.maximum(1, count[chosen] - WINDOW + 1)
            starts = texts.first[:-1][chosen] + (rng.random(len(chosen)) * room).astype(np.int64)
            if best is not None:
                starts = np.where(labels[chosen] == 1, best[chosen], starts)
        else:
            starts = best[chosen]
        windows = texts.fill(starts, chosen)
        part, numbers = np.unique(windows, return_inverse=True)
        small = _Part(texts, part[part >= 0])
        adam.rate = RATE * (1 - 0.9 * step / STEPS)
        adam.step(model.slopes(small, numbers.reshape(windows.shape) - (part[0] < 0), labels[chosen]))
    return model


class _Part:
    """Some of the distinct words of ``Texts``."""

    def __init__(self, texts: Texts, chosen: np.ndarray):
        self.hashes = texts.hashes[chosen]
        many = np.diff(texts.tri_first)[chosen]
        self.tri_first = np.append(0, np.cumsum(many)).astype(np.int64)
        within = np.arange(self.tri_first[-1]) - np.repeat(self.tri_first[:-1], many)
        self.trigrams = texts.trigrams[np.repeat(texts.tri_first[:-1][chosen], many) + within]


def sample(docs: DataFrame, labels: DataFrame, column: str, learn: Column, most: int = SAMPLE) -> list[tuple[int, str]]:
    """At most ``most`` labelled texts of each label, by the hash of their id; of two labels the larger counts."""
    known = labels.where(learn & F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.max(column).alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, 1.3 * most / n)])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(10**9)) / 10**9
    chosen = known.where(draw < share[F.col("label")]).orderBy(draw, "doc_id").limit(2 * most * len(counts))
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
    # The chosen ids are bounded by ``most``.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("label", "doc_id", "text").orderBy("doc_id", "text")
    out: dict[int, list[tuple[int, str]]] = {0: [], 1: []}
    for row in rows.limit(2 * most * len(counts)).collect():
        if len(out[row["label"]]) < most:
            out[row["label"]].append((row["label"], row["text"]))
    return out[0] + out[1]


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.texts_of(batch["text"])
            scores = [np.zeros(0)]
            for a, b in words.slices(offsets, 2_000_000):
                ends = offsets[a : b + 1] - offsets[a]
                scores.append(
                    sent.value.scores(data[offsets[a] : offsets[b]], ends)[0] if sent.value else np.zeros(b - a)
                )
            found = np.concatenate(scores).astype(np.float64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"].cast(pa.int64()),
                    "held_out": batch["held_out"],
                    "score": pa.array(found),
                    "predicted": pa.array((found >= threshold).astype(np.int32)),
                }
            )

    return docs.select("doc_id", "held_out", shared.binary_text()).mapInArrow(
        judge, "doc_id bigint, held_out boolean, score double, predicted int"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on labelled rows that aren't held out and score all rows."""
    held_out = shared.held_out(4, 2)
    model = train(sample(docs, labels, "toxic", ~held_out))
    return score(docs.withColumn("held_out", held_out), model)
