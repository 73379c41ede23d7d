"""Whitening of embeddings; the covariance comes from variances alone, by polarisation.

Entries become integers, so sums are exact. The fit list holds each distinct vector once. One pass
sums every dimension. A second pass takes the centred integers y = n * x - S and sums the squares of
every dimension and of every sum of two dimensions; as (a + b)^2 - a^2 - b^2 = 2ab, the covariance of
two dimensions is half the difference of these variances, again exactly. Only these d * (d + 1) / 2
numbers reach the driver, where ``eigh`` turns them into components. Two further passes measure the
covariance of the whitened fit list.

The fit list is written to the shared folder once. Copies of one vector are combined before the
shuffle, so a very common vector is one row per task. Tasks return sums only.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped, and so are
rows whose vector has not the commonest length (ties: the longest; empty vectors have length 0 and
no components). Repeated rows and rows without id each get their rows. Fewer than four dimensions
give as many components. A component whose eigenvalue is not above the rounding error of the largest
has a null ``whitened`` and is left out of ``identity_error``; without variance ``explained`` is null.
``deviation`` is null where it does not fit a long. Entries beyond a long saturate. Components with
equal eigenvalues may be any basis of their space; of each component the largest entry is positive.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import shared

SCALE, COMPONENTS = 256, 4
#: Vector entries that a task works on at once.
ENTRIES = 1 << 19
#: Sums of squares below this fit a long; larger numbers are squared in two halves of so many bits.
_FITS, _HALF = 1 << 62, 24
#: Whole numbers travel in digits of so many bits, whose sums over all tasks fit a decimal.
_DIGIT = 80

SUMS = "k int, place int, total decimal(38,0)"
ROWS = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)


class Model(NamedTuple):
    """Size of the fit list, sums per dimension, all components as columns, and all eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    kept: int

    def positive(self) -> np.ndarray:
        least = len(self.values) * np.finfo(float).eps * max(self.values.max(initial=0), 0)
        return self.values[: self.kept] > least

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows by the kept components of positive eigenvalue; the others are NaN."""
        centred = x - np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            out = centred @ self.vectors[:, : self.kept] / np.sqrt(self.values[: self.kept])
        out[:, ~self.positive()] = np.nan
        return out


def scaled(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``, the vector in integers, of all usable rows of one length."""
    entry = F.col("embedding").cast("array<double>")
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), entry.alias("embedding")
    ).where(F.coalesce(finite, F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    whole = F.transform("embedding", lambda c: F.floor(c * SCALE).cast("bigint"))
    return rows.where(F.size("embedding") == (common["d"] if common else 0)).select("vec_id", whole.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches in pieces of bounded size, each with its vectors as a matrix of longs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch["x"]
        flat = column.flatten().to_numpy(zero_copy_only=False)
        d = len(flat) // batch.num_rows
        x = flat.reshape(batch.num_rows, d)
        step = max(1, ENTRIES // max(d, 1))
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step), x[a : a + step]


def _most(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S: longs if they fit, else whole numbers of any size."""
    if _most(x) * n + max(map(abs, sums), default=0) < _FITS // 2:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squared_sums(z: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares as Python integers; no square is ever rounded or cut."""
    if z.dtype == object:
        return (z * z).sum(axis=axis)
    terms, most = z.shape[axis], _most(z)
    if most * most * max(terms, 1) < _FITS:
        return np.einsum("ij,ij->" + "ji"[axis], z, z).astype(object)
    high, low = z >> _HALF, z & ((1 << _HALF) - 1)
    if most >> _HALF >= 1 << _HALF or terms > 1 << 13:
        return squared_sums(z.astype(object), axis)
    parts = [np.einsum("ij,ij->" + "ji"[axis], a, b).astype(object) for a, b in ((high, high), (high, low), (low, low))]
    return parts[0] * (1 << 2 * _HALF) + parts[1] * (1 << _HALF + 1) + parts[2]


def _summed(rows: DataFrame, width: int, add: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Sum over all vectors what ``add`` gives for a matrix of them, exactly."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for _, x in _matrices(batches):
            total = total + add(x)
        out: list[tuple[int, int, int]] = []
        for k, value in enumerate(map(int, total)):
            sign, value, place = (-1 if value < 0 else 1), abs(value), 0
            while value or not place:
                out.append((k, place, sign * (value & (1 << _DIGIT) - 1)))
                value, place = value >> _DIGIT, place + 1
        ks, places, digits = zip(*out, strict=True)
        columns = [pa.array(ks, pa.int32()), pa.array(places, pa.int32()), pa.array(digits, pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["k", "place", "total"])

    made = rows.select("x").mapInArrow(work, SUMS).groupBy("k", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    found = [0] * width
    for r in made.collect():
        found[r["k"]] += int(r["total"]) << _DIGIT * r["place"]
    return found


def pair_sums(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Squares of each centred dimension, then of each sum of two, dimension by dimension."""
    y = _centred(x, n, sums)
    rows = 1 << 13
    total: np.ndarray | int = 0
    for a in range(0, len(y), rows):
        z = y[a : a + rows]
        own = [squared_sums(z, 0)]
        own += [squared_sums(z[:, i : i + 1] + z[:, i + 1 :], 0) for i in range(z.shape[1] - 1)]
        total = total + np.concatenate(own)
    return total


def covariance(n: int, d: int, squares: list[int]) -> np.ndarray:
    """V from sums of squares over n * x - S: exact whole numbers up to the one division each."""
    out, at = np.zeros((d, d)), d
    for i in range(d):
        out[i, i] = squares[i] / n**3
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = ((squares[at] - squares[i] - squares[j]) // 2) / n**3
            at += 1
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of a list of distinct vectors; none without vectors or dimensions."""
    shape = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = shape["n"], shape["d"]
    if not n or not d:
        return None
    sums = _summed(distinct, d, lambda x: (x.astype(object) if _most(x) > 1 << 40 else x).sum(axis=0))
    squares = _summed(distinct, d * (d + 1) // 2, lambda x: pair_sums(x, n, sums))
    cov = covariance(n, d, squares)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(d)] < 0, -1.0, 1.0)
    return Model(n, sums, vectors, values, float(np.trace(cov)), min(components, d))


def identity_error(distinct: DataFrame, model: Model) -> float | None:
    """Largest entry of the whitened fit list's covariance less the identity, measured over the list."""
    good = np.flatnonzero(model.positive())
    if not len(good):
        return None

    def totals(of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: np.ndarray | None = None
            for _, x in _matrices(batches):
                own = of(model.whiten(x)[:, good])
                total = own if total is None else total + own
            if total is not None:
                index = pa.array(np.arange(total.size, dtype=np.int32))
                yield pa.RecordBatch.from_pydict({"k": index, "total": pa.array(total.ravel())})

        made = distinct.select("x").mapInArrow(work, "k int, total double").groupBy("k").agg(F.sum("total").alias("total"))
        return np.array([r["total"] for r in made.orderBy("k").collect()]) / model.n

    mean = totals(lambda w: w.sum(axis=0))
    spread = totals(lambda w: (w - mean).T @ (w - mean)).reshape(len(good), len(good))
    return float(np.abs(spread - np.eye(len(good))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, with the projections of the whitened vector."""
    rows = scaled(vectors)
    distinct = shared.stored(rows.select("x").distinct(), "fit-list")
    model = fit(distinct, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], ROWS)
    error = identity_error(distinct, model)
    explained = [float(e) / model.trace if model.trace > 0 else None for e in model.values[: model.kept]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches):
            m, k = len(x), model.kept
            deviation = squared_sums(_centred(x, model.n, model.sums), 1)
            fits = [int(v) if v < 1 << 63 else None for v in deviation]
            each = pa.array(np.repeat(np.arange(m), k))
            white = model.whiten(x).ravel()
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch["vec_id"].take(each),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, model.n), pa.int64()),
                    "deviation": pa.array(fits, pa.int64()).take(each),
                    "whitened": pa.array(white, mask=np.isnan(white)),
                    "explained": pa.array(explained * m, pa.float64()),
                    "identity_error": pa.array([error] * (m * k), pa.float64()),
                }
            )

    return rows.mapInArrow(work, ROWS)
