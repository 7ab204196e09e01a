"""Whitening against a dense eigendecomposition in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import queries, whitening
from tests.conftest import SF_ORACLE
from tests.llm.common import CLASHING


def brute(vectors, k=16):
    """x of the vectors that take part, fit list, eigenvalues and vectors, all dense."""
    x = {}
    for i, v in vectors:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x.setdefault(i, []).append([math.floor(64 * float(c)) + 1_000_000 for c in v])
    fit = np.array(sorted({tuple(v) for vs in x.values() for v in vs}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    c = np.array([[float(n * a - b) / n for a, b in zip(r, s)] for r in fit])
    e, q = np.linalg.eigh(c.T @ c / n)
    return x, n, s, e[::-1][:k], q[:, ::-1][:, :k], e.sum()


def compare(rows, vectors, k=16, tolerance=1e-6):
    x, n, s, e, q, trace = brute(vectors, k)
    seen = {}
    for r in rows:
        seen.setdefault(r.vec_id, {})[r.component] = r
    assert set(seen) == set(x)
    signs = {}
    for i, by in seen.items():
        v = x[i][0]
        assert sorted(by) == list(range(1, len(by) + 1))
        far = sum((n * a - b) ** 2 for a, b in zip(v, s))
        centred = np.array([float(n * a - b) / n for a, b in zip(v, s)])
        for j, r in by.items():
            assert (r.n, r.deviation) == (n, far)
            assert abs(r.explained - e[j - 1] / trace) <= 1e-9 * e[j - 1] / trace
            want = centred @ q[:, j - 1] / math.sqrt(e[j - 1])
            if j not in signs and abs(want) > 1e-3:
                signs[j] = math.copysign(1, want * r.whitened)
            assert abs(want * signs.get(j, 1) - r.whitened) < tolerance or abs(want) <= 1e-3
            assert r.identity_error < 1e-9
    return seen


def test_query_against_a_dense_decomposition(spark):
    given = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = queries.op11_whitening(spark, SF_ORACLE).collect()
    assert len(rows) == 16 * len(given)
    compare(rows, [(r.vec_id, r.embedding) for r in given])


def test_filter_finds_a_flat_spectrum_and_is_certified(spark):
    rng = np.random.default_rng(5)
    m = rng.standard_normal((3000, 70)) * np.linspace(1.2, 1.0, 70)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>").repartition(5)
    w = whitening.fit(df, block=24, degree=8)
    x = np.floor(64 * m)
    c = x - x.mean(axis=0)
    e, q = np.linalg.eigh(c.T @ c / len(c))
    assert np.allclose(w.values, e[::-1][:16], rtol=1e-12)
    # by the gap theorem, the residual bounds each vector's error
    assert w.residual <= 1e-11 and w.passes > 8
    assert np.allclose(np.abs((w.components * q[:, ::-1][:, :16]).sum(axis=0)), 1, atol=1e-10)


def test_rows_that_take_no_part_repeats_ties_and_names(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (2, [1.5, 0.0, 1.0]), (3, [0.25, -1.0, 0.0]), (4, [0.5, 1.0, -2.0]), (5, [3.0, 3.0, 3.0])]
    bad = [(6, None), (7, [1.0, None, 2.0]), (8, [nan, 1.0, 2.0]), (9, [inf, 1.0, 2.0]), (10, [1e30, 1.0, 2.0]), (11, [1.0, 2.0]), (12, [])]
    df = spark.createDataFrame([*good, *bad, good[0]], "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("own") for c in (*CLASHING, "x", "v", "i", "n", "component", "id")})
    rows = whitening.whiten(df).collect()
    assert len(rows) == 3 * 6  # three dimensions; row 1 twice
    assert {r.n for r in rows} == {4}  # ids 1 and 4 have one vector
    compare([r for r in rows], good)


def test_null_ids_and_clashing_names_stay(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id is None, r.vec_id, r.component) for r in whitening.whiten(df).collect() if r.vec_id is None) == [
        (True, None, 1), (True, None, 2)]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_spread_there_is_no_component(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() == []


def test_fewer_components_where_vectors_span_less(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0, float(i % 3)]) for i in range(50)], "vec_id long, embedding array<double>")
    w = whitening.fit(df)
    assert len(w.values) == 2 and w.identity_error < 1e-10


def test_large_numbers_are_exact_or_null(spark):
    big = float(1 << 40)
    df = spark.createDataFrame([(1, [big, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    w = whitening.fit(df)
    x = [[(1 << 46) + 1_000_000, 1_000_000], [1_000_000, 1_000_064], [1_000_064, 1_000_000]]
    s = [sum(c) for c in zip(*x)]
    want = [sum((3 * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    assert whitening.deviations(np.array(x), w.centre) == [v if v < 1 << 63 else None for v in want]
    assert len(whitening.apply(df, w).collect()) == 3 * len(w.values)
