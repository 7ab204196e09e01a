"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed.  A pass over the distinct vectors multiplies
their centred products with a block of directions, (X - m)'(X - m)Q, one partial
block a task, summed by Spark.  A Chebyshev polynomial of the covariance, one
pass a degree, damps what lies below the block's least Ritz value; QR and
Rayleigh-Ritz follow, and the residuals of the wanted pairs, which that pass
gives too, certify them or ask for another round.

Sums are kept as integers, so centring is exact up to the last rounding: a
vector less the whole part of the mean is an integer, and what is left of the
mean is below one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.util import short_batches, staged

#: Entries of x are below this in size, else they would not be longs for sure.
LARGEST = float(1 << 62)
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


@dataclass(frozen=True)
class Centre:
    """Sums of n integer vectors: sum = n * whole + rest, 0 <= rest < n, per dimension."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def less(self, x: np.ndarray) -> np.ndarray:
        """x - sum / n."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n


@dataclass(frozen=True)
class Whitening:
    """The fit: eigenpairs of the covariance, falling, with what certifies them."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray  # one column each
    trace: float
    identity_error: float
    residual: float  # largest |V q - e q|, as a share of the largest eigenvalue
    passes: int


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: float, shift: int) -> DataFrame:
    """(id, x) with x = floor(scale * c) + shift of every vector without null or
    non-finite entries (nor such as no long could hold)."""
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), v.alias("v"))
    good = F.forall("v", lambda c: F.coalesce(F.abs(c * scale) < LARGEST, F.lit(False)))  # NaN is above all numbers
    return rows.where(F.col("v").isNotNull() & good).select("id", F.transform("v", lambda c: F.floor(c * scale) + shift).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over all batches of ``part`` (a matrix of ``shape``): added up within a
    task, then by Spark per entry, so the driver gets one matrix however many
    tasks there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch.column(0)))
        i, j = np.indices(shape, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    out = np.zeros(shape)
    for r in fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def _centre(fit: DataFrame, dim: int) -> Centre:
    """Exact sums per dimension, through decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dim, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                small = float(np.abs(x.astype(np.float64)).max(initial=0)) * len(x) < LARGEST
                total = [a + int(b) for a, b in zip(total, (x if small else x.astype(object)).sum(axis=0), strict=True)]
                n += len(x)
        rows = [*enumerate(total), (dim, n)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([str(r[1]) for r in rows])], names=["i", "s"])

    sums = fit.select("x").mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by_dim = {r.i: int(r.s) for r in sums}
    n = by_dim.get(dim, 0)
    split = [divmod(by_dim[i], n) for i in range(dim)] if n else [(0, 0)] * dim
    return Centre(n, np.array([a for a, _ in split], np.int64), np.array([b for _, b in split], np.float64))


class _Passes:
    """Products with the covariance; every call is one pass over the fit list."""

    def __init__(self, fit: DataFrame, centre: Centre):
        self.fit, self.centre, self.count = fit, centre, 0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        self.count += 1
        centre = self.centre

        def part(x: np.ndarray) -> np.ndarray:
            c = centre.less(x)
            return c.T @ (c @ q)

        return _summed(self.fit, part, q.shape) / centre.n


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, degree: int,
              low: float, high: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of the operator, at most 1 in size on [low, high] up
    to a common factor and 1 at ``top``, applied to q; ``vq`` is the first product."""
    half, mid = (high - low) / 2, (high + low) / 2
    ratio = first = half / (top - mid)
    before, now = q, (vq - mid * q) * (ratio / half)
    for _ in range(1, degree):
        following = 1 / (2 / first - ratio)
        before, now = now, (times(now) - mid * now) * (2 * following / half) - (ratio * following) * before
        ratio = following
    return now


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, with the block and its product turned to the Ritz vectors."""
    values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def eigenpairs(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, *, block: int = 48, degree: int = 12,
               tolerance: float = 1e-13, enough: float = 1e-11, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, residual) of the ``wanted`` largest eigenpairs of a
    positive semidefinite operator given by its products with blocks.

    Rounds go on until every wanted residual |V q - e q| is below ``tolerance``
    times the largest value, or is below ``enough`` times it and falls no more
    (rounding); RuntimeError if ``rounds`` don't get there.  A block as wide as
    the space is exact at once.
    """
    size = min(dim, max(block, wanted))
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((dim, size)))
    wanted, last = min(wanted, dim), np.inf
    for _ in range(rounds):
        values, q, vq = _ritz(q, times(q))
        top = max(float(values[0]), 0.0)
        if top == 0.0:
            return values[:wanted], q[:, :wanted], 0.0
        off = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / top
        if off <= tolerance or (off <= enough and off > last / 2):
            return values[:wanted], q[:, :wanted], float(off)
        last, high = off, float(max(values[-1], top * 1e-15))
        if high < top * (1 - 1e-12):
            q = chebyshev(times, q, vq, degree, 0.0, high, top)
        else:
            q = vq  # all Ritz values alike: a plain power step
        q, _ = np.linalg.qr(q)
    raise RuntimeError(f"not certified after {rounds} rounds: residual {last:.1e} of the largest eigenvalue")


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = 16,
        scale: float = 64, shift: int = 1_000_000, block: int = 48, degree: int = 12) -> Whitening | None:
    """Whitening of the distinct vectors x; None if no vector takes part.

    Vectors of another number of entries than the commonest (of equally common
    ones the larger) take no part.  Eigenvalues that are zero up to rounding have
    no component: there are fewer than ``components`` if the vectors span less,
    none if all are equal.  Eigenvectors of equal eigenvalues are one of many bases.
    """
    short_batches(vectors.sparkSession)
    rows = integers(vectors, id_col, vector_col, scale, shift).select("x")
    listed = staged(rows.distinct(), "whitening-fit")
    dims = listed.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return None
    dim = int(dims["dim"])
    listed = listed.where(F.size("x") == dim)
    centre = _centre(listed, dim)
    if not dim:
        return Whitening(centre, np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, 0.0, 0)
    times = _Passes(listed, centre)
    trace = float(_summed(listed, lambda x: np.square(centre.less(x)).sum().reshape(1, 1), (1, 1))[0, 0]) / centre.n
    values, found, residual = eigenpairs(times, dim, components, block=block, degree=degree)
    some = values > max(float(values[0]), 0.0) * dim * 1e-14
    values, found = values[some], found[:, some]
    k = len(values)
    error = 0.0
    if k:
        turn = found / np.sqrt(values)

        def part(x: np.ndarray) -> np.ndarray:
            w = centre.less(x) @ turn
            return np.vstack([w.T @ w, w.sum(axis=0, keepdims=True)])

        sums = _summed(listed, part, (k + 1, k)) / centre.n
        error = float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())
    return Whitening(centre, values, found, trace, error, residual, times.count)


def deviations(x: np.ndarray, centre: Centre) -> list[int | None]:
    """Sum over the dimensions of (n * x - sum)^2, exact; None beyond a long."""
    d = x - centre.whole
    far = float(np.abs(d.astype(np.float64)).max(initial=0)) * centre.n + centre.n
    if far * far * x.shape[1] < LARGEST:
        return np.square(centre.n * d - centre.rest.astype(np.int64)).sum(axis=1).tolist()
    whole, rest = centre.whole.tolist(), [int(r) for r in centre.rest]
    out = [sum((centre.n * (a - b) - r) ** 2 for a, b, r in zip(row, whole, rest, strict=True)) for row in x.tolist()]
    return [s if s < 1 << 63 else None for s in out]


def apply(vectors: DataFrame, w: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding", *,
          scale: float = 64, shift: int = 1_000_000) -> DataFrame:
    """A row per vector that takes part and component: vec_id, component (from
    1), n (vectors of the fit), deviation, whitened, explained (the component's
    share of the trace), identity_error (of the whole fit).

    Vectors that are null, hold null or non-finite entries, or have another
    number of entries than the fit's take no part.  Repeated rows come out as
    often as they are there, null ids stay.  An empty table, and a fit without
    components, give an empty one.  A deviation that no long holds is null.
    """
    short_batches(vectors.sparkSession)
    rows = integers(vectors, id_col, vector_col, scale, shift)
    if w is None or not len(w.values):
        return rows.sparkSession.createDataFrame([], RESULT)
    centre, turn, share, k = w.centre, w.components / np.sqrt(w.values), w.values / w.trace, len(w.values)
    error = w.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            far = pa.array(deviations(x, centre), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            m = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(m, centre.n)), far,
                 pa.array((centre.less(x) @ turn).ravel()), pa.array(np.tile(share, len(x))), pa.array(np.full(m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == len(centre.whole)).mapInArrow(run, RESULT)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = 16,
           scale: float = 64, shift: int = 1_000_000) -> DataFrame:
    """``fit`` and ``apply`` on the same vectors."""
    given = {"id_col": id_col, "vector_col": vector_col, "scale": scale, "shift": shift}
    return apply(vectors, fit(vectors, components=components, **given), **given)
