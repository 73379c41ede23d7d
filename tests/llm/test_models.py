"""Learned operators: held-out accuracy, gradients, and defined results of awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fraudspark.llm import language_id, quality, toxicity, words
from tests.llm.corpus import docs, empty, frame, prose, rows_of, texts  # noqa: F401

LEXICON = {
    "en": "the of and thing with was from that this ending other reading".split(),
    "de": "der die und nicht schön über machen zeitung werden könnte".split(),
    "fr": "les une été très pour avec élève français où garçon".split(),
}


def corpus(n: int, seed: int = 1) -> list[tuple[int, str, str, int, int]]:
    """(id, language, text, quality, toxic)"""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(LEXICON))
        found = [rng.choice(LEXICON[lang]) for _ in range(rng.randrange(20, 90))]
        good, bad = int(rng.random() < 0.7), int(rng.random() < 0.3)
        if bad:
            found[rng.randrange(len(found))] = "grom" + rng.choice(("lo", "la", "pf", "xi"))
        if not good:
            found = [w.upper() + "!!!" for w in found]
        out.append((i, lang, " ".join(found), good, bad))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(900)
    made = [(i, t, lang) for i, lang, t, _, _ in rows]
    made += [(None, None, "en"), (5000, "", None), (5001, "123 ...", "xx"), (5002, prose(random.Random(2), 30_000), None)]
    frame = spark.createDataFrame(made * 1 + made[:3], "doc_id bigint, text string, lang string")
    frame = frame.selectExpr("*", "'x' AS label", "1 AS score", "true AS held_out", "'y' AS predicted", "'z' AS found")
    labels = spark.createDataFrame(
        [(i, q, x) for i, _, _, q, x in rows] + [(None, 1, 1), (5000, None, None)], "doc_id bigint, quality int, toxic int"
    )
    return rows, frame, labels


def held_out(i, modulus: int, remainder: int) -> bool:
    return zlib.crc32(b"" if i is None else str(i).encode()) % modulus == remainder


def test_language_id(spark, tables):
    rows, frame, _ = tables
    found = language_id.identify(frame).collect()
    assert len(found) == frame.count()
    by_id = {r["doc_id"]: r for r in found}
    assert all(r["held_out"] == held_out(i, 5, 0) for i, r in by_id.items())
    assert (by_id[None]["lang_pred"], by_id[5000]["lang_pred"], by_id[5001]["lang_pred"]) == ("und",) * 3
    assert by_id[5002]["lang_pred"] in {"en", "de", "fr", "xx"}
    right = [by_id[i]["lang_pred"] == lang for i, lang, *_ in rows if by_id[i]["held_out"]]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert language_id.identify(frame.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(frame.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()} == {"und"}


@pytest.mark.parametrize(
    "operator, column, modulus, remainder, least",
    [(toxicity.toxicity, 4, 4, 2, 0.93), (quality.quality, 3, 5, 0, 0.97)],
)
def test_label_scores(spark, tables, operator, column, modulus, remainder, least):
    rows, frame, labels = tables
    found = operator(frame, labels).collect()
    assert len(found) == frame.count()
    by_id = {r["doc_id"]: r for r in found}
    assert all(r["held_out"] == held_out(i, modulus, remainder) for i, r in by_id.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    right = [by_id[row[0]]["predicted"] == row[column] for row in rows if by_id[row[0]]["held_out"]]
    assert len(right) > 100 and np.mean(right) > least
    assert operator(frame.limit(0), labels).count() == 0
    unlabelled = operator(frame, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in unlabelled} == {(0.0, 0)}


def test_every_window_counts():
    """An insult anywhere in a long text raises its score, wherever the windows begin."""
    rows = [(toxic, t) for _, _, t, _, toxic in corpus(500)]
    model = toxicity.train(rows)
    rng = random.Random(9)
    plain = [rng.choice(LEXICON["en"]) for _ in range(1500)]
    scores = []
    for at in (0, 23, 24, 47, 700, 1499):
        text = plain[:at] + ["gromlo"] + plain[at + 1 :]
        data, offsets = words.texts_of(pa.array([" ".join(text).encode()]))
        scores.append(model.scores(data, offsets)[0][0])
    data, offsets = words.texts_of(pa.array([" ".join(plain).encode()]))
    assert min(scores) > 0.3 > model.scores(data, offsets)[0][0]


def numeric(loss, params, name, at, step=1e-2):
    params[name][at] += step
    up = loss()
    params[name][at] -= 2 * step
    down = loss()
    params[name][at] += step
    return (up - down) / (2 * step)


def test_slopes_of_language_id():
    model = language_id.Model(["a", "b", "c"], seed=1)
    rng = np.random.default_rng(2)
    pieces = rng.integers(97, 105, size=(6, 4))
    pieces[4:, 1] = language_id.PAD
    labels = np.array([0, 1, 2, 1])

    def loss():
        probs, _ = model.probabilities(pieces)
        chosen = probs[:, np.arange(4), labels].astype(np.float64)
        return -np.log(chosen)[pieces != language_id.PAD].mean()

    slopes = model.slopes(pieces, labels)
    for name in ("in_forth", "in_back", "u_forth", "u_back", "w"):
        at = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        if name.startswith("in_") and at[0] == language_id.PAD:
            continue
        assert slopes[name][at] == pytest.approx(numeric(loss, model.p, name, at), rel=0.05, abs=1e-3)


def test_slopes_of_toxicity():
    data, offsets = words.texts_of(pa.array([b"one two three four", b"five six", b"two five one"]))
    part = toxicity.Texts(data, offsets)
    model = toxicity.Model(part.hashes[:4], seed=3)
    starts, owner = part.windows()
    windows = part.fill(starts, owner)
    labels = np.array([1, 0, 1])

    def loss():
        score = model.forward(model.inputs(part), windows)[0].astype(np.float64)
        return -np.mean(labels * np.log(score) + (1 - labels) * np.log(1 - score))

    slopes = model.slopes(part, windows, labels)
    for name in slopes:
        at = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        assert slopes[name][at] == pytest.approx(numeric(loss, model.p, name, at), rel=0.05, abs=2e-3), name


def test_frequencies_and_votes_by_brute_force(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcd  E1.\n") for _ in range(rng.choice((0, 2, 9, 60, 300)))) for _ in range(60)] + [None, ""]
    texts += ["very very good text", "Ünïcode ünïcode"]
    among, present = quality.frequencies(frame(spark, list(enumerate(texts))).repartition(5))
    found = []
    for t in texts:
        data, offsets = words.texts_of(pa.array([(t or "").encode()], pa.large_binary()))
        found.append(quality.counts(data, offsets)[0])
    assert among == len(texts) and present.tolist() == [sum(f[k] > 0 for f in found) for k in range(quality.COLUMNS)]
    assert quality.frequencies(frame(spark, []))[0] == 0

    rows = [(k % 2, t) for k, t in enumerate(texts) if t]
    model = quality.Model(rows, among, present)
    for t in texts:
        data, offsets = words.texts_of(pa.array([(t or "").encode()], pa.large_binary()))
        own = np.sqrt(quality.counts(data, offsets)[0]) * (np.log((1 + among) / (1 + present)) + 1)
        own = (own / (np.linalg.norm(own) or 1)) @ model.axes
        near = [(float(own @ v) / (np.linalg.norm(own) or 1), label) for v, (label, _) in zip(model.vectors, rows, strict=True)]
        near = [(max(c, 0.0), label) for c, label in sorted(near, reverse=True)[: quality.NEIGHBOURS]]
        total = sum(c for c, _ in near)
        plain = sum(c * label for c, label in near) / total if total > 1e-9 else np.mean([label for label, _ in rows])
        assert model.scores(data, offsets)[0] == pytest.approx(plain, abs=2e-3)
