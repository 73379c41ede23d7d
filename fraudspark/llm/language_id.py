"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of a text gets a probability for each language from the network's states at its place;
a document's probability of a language is the mean over its bytes that can be part of a letter.
The network is trained in numpy, by backpropagation through time, to label every position.

Training sees a bounded sample: at most ``SAMPLE_PER_LANG`` rows of a language, chosen by a hash of
their id, with one excerpt of at most ``EXCERPT`` characters each. Prediction reads whole texts, cut
into pieces of ``PIECE`` bytes, in batches of bounded size.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled
row every text is ``und``; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.llm import gru, shared, words

UNITS = 8
PIECE = 128
SAMPLE_PER_LANG = 400
EXCERPT = 400
STEPS, BATCH, TRAIN_PIECE, RATE = 400, 96, 64, 0.01
UNKNOWN = "und"
PAD = 256
_LETTER = np.zeros(257, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:256] = True


class Model:
    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.p: gru.Params = {
            f"{kind}_{way}": gru.normal(rng, *shape)
            for way in ("forth", "back")
            for kind, shape in (("in", (257, 3 * UNITS)), ("u", (UNITS, 3 * UNITS)))
        }
        self.p |= {"w": gru.normal(rng, 2 * UNITS, len(langs)), "b": np.zeros(len(langs), np.float32)}
        self._hold()

    def _hold(self) -> None:
        for way in ("forth", "back"):
            self.p[f"in_{way}"][PAD] = 0
            self.p[f"in_{way}"][PAD, :UNITS] = gru.HOLD

    def probabilities(self, pieces: np.ndarray, keep=None) -> tuple[np.ndarray, np.ndarray]:
        """Of each language at each place (time, piece, language), and the states."""
        states = gru.both_ways(self.p["in_forth"][pieces], self.p["in_back"][pieces], self.p, keep)
        flat = states.reshape(-1, 2 * UNITS) @ self.p["w"] + self.p["b"]
        flat -= flat.max(axis=1, keepdims=True)
        np.exp(flat, out=flat)
        flat /= flat.sum(axis=1, keepdims=True)
        return flat.reshape(*pieces.shape, len(self.langs)), states

    def slopes(self, pieces: np.ndarray, labels: np.ndarray) -> gru.Params:
        """Of the mean cross-entropy over all places that aren't padding."""
        keep: tuple[list, list] = ([], [])
        d, states = self.probabilities(pieces, keep)
        d[:, np.arange(len(labels)), labels] -= 1
        real = pieces != PAD
        d *= real[:, :, None] / np.float32(real.sum())
        flat = d.reshape(-1, len(self.langs))
        out = {"w": states.reshape(-1, 2 * UNITS).T @ flat, "b": flat.sum(axis=0)}
        forth, back, inner = gru.slopes_both_ways((flat @ self.p["w"].T).reshape(states.shape), self.p, keep)
        for way, gates in (("forth", forth), ("back", back)):
            table = np.zeros_like(self.p[f"in_{way}"])
            np.add.at(table, pieces.ravel(), gates.reshape(-1, 3 * UNITS))
            out[f"in_{way}"] = table
        return out | inner

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities per text over its letter bytes; zeros where it has none."""
        lengths = np.diff(offsets)
        pieces = -(-lengths // PIECE)
        owner = np.repeat(np.arange(len(lengths)), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = offsets[:-1][owner] + within * PIECE
        sums = np.zeros((len(lengths), len(self.langs)))
        letters = np.zeros(len(lengths))
        for a in range(0, len(owner), 2048):
            begin, own = starts[a : a + 2048], owner[a : a + 2048]
            at = begin[None, :] + np.arange(PIECE)[:, None]
            inside = at < offsets[1:][own][None, :]
            bytes_ = np.where(inside, data[np.minimum(at, len(data) - 1)], PAD)
            counted = _LETTER[bytes_]
            probs, _ = self.probabilities(bytes_)
            np.add.at(sums, own, np.einsum("tnl,tn->nl", probs, counted.astype(np.float32)))
            np.add.at(letters, own, counted.sum(axis=0))
        return sums / np.maximum(letters, 1)[:, None]


def train(excerpts: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit on (language, text) pairs; languages are drawn evenly, pieces anywhere in their text."""
    langs = sorted({lang for lang, text in excerpts if text})
    texts = {lang: [np.frombuffer(t.encode(), np.uint8) for x, t in excerpts if x == lang and t] for lang in langs}
    model = Model(langs, seed)
    if not langs:
        return model
    rng = np.random.default_rng(seed)
    adam = gru.Adam(model.p, RATE)
    for step in range(STEPS):
        labels = np.arange(BATCH) % len(langs)
        if len(langs) > BATCH:
            labels = rng.integers(len(langs), size=BATCH)
        pieces = np.full((TRAIN_PIECE, BATCH), PAD)
        for k, label in enumerate(labels):
            of = texts[langs[label]]
            text = of[rng.integers(len(of))]
            begin = rng.integers(max(1, len(text) - TRAIN_PIECE + 1))
            part = text[begin : begin + int(rng.choice((TRAIN_PIECE // 4, TRAIN_PIECE // 2, TRAIN_PIECE)))]
            pieces[: len(part), k] = part
        adam.rate = RATE * (1 - 0.9 * step / STEPS)
        adam.step(model.slopes(pieces, labels))
        model._hold()
    return model


def sample(docs: DataFrame, learn: Column) -> list[tuple[str, str]]:
    """At most ``SAMPLE_PER_LANG`` excerpts of a language, by the hash of their row's id."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 1.5 * SAMPLE_PER_LANG / n)])
    hashed = F.xxhash64("doc_id", F.length("text"))
    draw = F.pmod(hashed, F.lit(10**9)) / 10**9
    begin = F.pmod(hashed, F.greatest(F.lit(1), F.length("text") - EXCERPT)).cast("int") + 1
    chosen = (
        rows.where(draw < share[F.col("lang")])
        .select("lang", draw.alias("draw"), F.substring("text", begin, F.lit(EXCERPT)).alias("text"))
        .orderBy("draw", "lang", "text")
        .limit(2 * SAMPLE_PER_LANG * len(counts))
        .collect()
    )
    taken: dict[str, int] = {}
    out = []
    for row in chosen:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= SAMPLE_PER_LANG:
            out.append((row["lang"], row["text"]))
    return out


def label(model: Model, texts: pa.Array) -> pa.StructArray:
    """``lang_pred`` and ``score`` of each text, given as bytes."""
    data, offsets = words.texts_of(texts)
    names, scores = [], []
    for a, b in words.slices(offsets):
        text, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        pooled = model.pooled(text, ends) if model.langs else np.zeros((b - a, 1))
        for k, row in enumerate(pooled):
            own = text[ends[k] : ends[k + 1]].tobytes().decode("utf-8", "replace")
            known = row.any() and any(map(str.isalpha, own))
            names.append(model.langs[int(row.argmax())] if known else UNKNOWN)
            scores.append(float(min(row.max(), 1.0)) if known else 0.0)
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
    )


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct column of ``lang_pred`` and ``score``."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield label(sent.value, texts)
            shared.give_back()

    return named(text.cast("binary"))


def fitted(docs: DataFrame) -> Model:
    """A model of the rows that aren't held out."""
    return train(sample(docs, ~shared.held_out(5, 0)))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that aren't held out and label all rows."""
    found = predicted(docs.sparkSession, fitted(docs), F.col("text"))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), shared.held_out(5, 0).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", "found.*")
