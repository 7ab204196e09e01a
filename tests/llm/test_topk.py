import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import topk


def brute(rows, k, every=100):
    """query -> [(vec_id, score)] over rows (id, vector), equal rows once."""
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable[i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)] = True
    out = {}
    for q, a in usable:
        if q % every == 0:
            found = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(a) == len(b)]
            out.setdefault(q, []).extend(found)
    return {q: [(i, -s) for s, i in sorted(f)[:k]] for q, f in out.items() if f}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("own"), "v": F.lit(1), "dim": F.lit(2)})


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_equals_all_products(spark, spread):
    """Unit vectors fall in one bucket, others in many."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1200):
        v = rng.normal(size=12)
        v *= np.exp(spread * rng.normal()) / np.linalg.norm(v)
        rows.append((i, [float(x) for x in v]))
    rows += [(5000 + i, rows[7][1]) for i in range(20)]  # ties
    got = result(topk.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, chunk=100, block=5))
    assert got == brute(rows, 10)


def test_nulls_ties_repeats_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (7, [0.0, 0.0]), (8, [-1.0, -1.0]), (None, [9.0, 9.0]), (9, [1.0]), (10, []), (100, [0.0, 0.0]),
            (200, None), (300, [5.0]), (1, [0.5, 0.5])]
    got = result(topk.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=3))
    assert got == brute(rows, 3)
    empty = vectors(spark, rows).limit(0)
    assert topk.top_k(empty, F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(vectors(spark, rows), F.lit(False)).count() == 0


def test_pruning_keeps_all_that_reach_the_cosine():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(3000, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for cosine in (-1.5, -0.3, 0.0, 0.5, 0.9, 1.0):
        keep = topk.reaching(unit, unit[0], cosine, 4)
        assert not ((unit @ unit[0] >= cosine) & ~keep).any()
    assert topk.reaching(unit, unit[0], 0.9, 4).mean() < 0.2  # and prunes


def test_large_components_stay_exact(spark):
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randrange(-(2**20), 2**20)) for _ in range(3)]) for i in range(40)]
    assert result(topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5, scale=1024)) == brute(rows, 5, every=20)
    with pytest.raises(OverflowError):
        topk.products(np.array([[2**40]]), np.array([2**40]), 2.0**80)


def test_pairs_are_pruned_before_vectors_are_joined(spark):
    """No join of vectors has the number of components as its only key, and short chunks meet no block."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (100.0 if i % 10 == 0 else 0.01)]) for i in range(3000)]
    df = topk.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, chunk=50, block=4)
    assert result(df) == brute(rows, 10)
    plan = df._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    joins = [line for line in plan.split("== Physical Plan ==")[-1].splitlines() if "Join" in line and "vectors" in line]
    assert all("bucket" in line or "band" in line for line in joins)


def test_a_component_beyond_64_bits_ends_the_job(spark):
    with pytest.raises(Exception, match="too large for integer products"):
        topk.top_k(vectors(spark, [(0, [1e30, 1.0]), (1, [1.0, 1.0])]), F.lit(True)).collect()
