"""Whitening against plain numpy and whole-number arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from fraudspark.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, component string, n string"


def vectors(seed: int = 4, d: int = 6, m: int = 300):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 1 + j))) for j in range(d)]) for i in range(m)]
    rows += [(m + i, rows[7][1]) for i in range(120)]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (900, None), (901, [1.0] * (d - 1) + [None])]
    rows += [(902, [float("nan")] + [1.0] * (d - 1)), (903, [float("inf")] * d), (904, [1.0] * (d + 1)), (905, [])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], SCHEMA).repartition(5)


def usable(rows, d):
    good = [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, tuple(math.floor(256 * c) for c in v)) for i, v in good]


def test_against_plain_numbers(spark):
    rows = vectors()
    kept = usable(rows, 6)
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(x[j] for x in fit) for j in range(6)]
    centred = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums)] for x in fit])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 4 * len(kept)
    place = {}
    for i, x in kept:
        place.setdefault((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))), x)
    sign = {}
    for r in found:
        x = place[r["vec_id"], r["deviation"]]
        k = r["component"] - 1
        plain = (np.array(x) - np.array(sums) / n) @ basis[:, k] / math.sqrt(values[k])
        sign.setdefault(k, 1 if plain * r["whitened"] >= 0 else -1)
        assert sign[k] * r["whitened"] == pytest.approx(plain, abs=1e-8)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r["n"] == n and r["identity_error"] < 1e-9
    assert sorted(str(r["vec_id"]) for r in found if r["component"] == 1) == sorted(str(i) for i, _ in kept)


def test_sums_of_squares_stay_exact():
    rng = random.Random(1)
    for most in (1000, 1 << 30, 1 << 45, 1 << 55):
        z = np.array([[rng.randrange(-most, most + 1) for _ in range(3)] for _ in range(50)], np.int64)
        for axis in (0, 1):
            plain = [sum(int(v) ** 2 for v in line) for line in (z.T if axis == 0 else z)]
            assert list(whitening.squared_sums(z, axis)) == plain


def test_covariance_is_exact(monkeypatch):
    rng = random.Random(2)
    x = np.array([[rng.randrange(-(1 << 40), 1 << 40) for _ in range(4)] for _ in range(30)], np.int64)
    sums = [int(v) for v in x.sum(axis=0)]
    squares = [int(v) for v in whitening.pair_sums(x, 30, sums)]
    found = whitening.covariance(30, 4, squares)
    mean = [Fraction(s, 30) for s in sums]
    for i in range(4):
        for j in range(4):
            plain = sum((Fraction(int(r[i])) - mean[i]) * (Fraction(int(r[j])) - mean[j]) for r in x) / 30
            assert found[i, j] == float(plain)


def test_few_rows_and_dimensions(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.whiten(frame(spark, [(i, [float(i), 0.0]) for i in range(4)])).collect()
    assert {(r["component"], r["whitened"] is None, r["explained"]) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}
    assert max(r["identity_error"] for r in flat) < 1e-12
    huge = whitening.whiten(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [1.0, 2.0])])).collect()
    assert len(huge) == 6 and {r["deviation"] for r in huge if r["vec_id"] == 1} == {None}
