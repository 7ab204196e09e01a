import random

import numpy as np

from orrery.llm import graph, minhash, queries
from tests.conftest import SF_SMALL
from tests.llm.common import documents, empty, shingle_components, table


def near_copies(seed=5):
    """Groups of near copies around the bar, chains, copies, short and odd texts."""
    rnd = random.Random(seed)
    word = lambda: "w" + str(rnd.randrange(5000))
    rows, i = [], 0
    for group in range(40):
        base = [word() for _ in range(rnd.choice([3, 5, 8, 20, 60, 200]))]
        for _ in range(rnd.choice([1, 2, 3, 8])):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                text[rnd.randrange(len(text))] = word()
            rows.append((i, rnd.choice([" ", "  ", "\n"]).join(text).upper() if rnd.random() < 0.3 else " ".join(text)))
            i += 1
            if rnd.random() < 0.5:
                base = text  # a chain
    passage = " ".join(word() for _ in range(60))
    rows += [(i + k, passage + " " + " ".join(word() for _ in range(60))) for k in range(60)]
    rnd.shuffle(rows)
    return rows


def test_components_equal_all_pairs(spark):
    rows = near_copies() + [(10_000, None), (10_001, ""), (10_002, " \n "), (10_003, "one"), (10_004, "One"), (10_005, "x " * 30_000)]
    for size in (4, 5):
        want = shingle_components(rows, size, 80)
        got = minhash.near_dedup(table(spark, rows), shingle=size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_registered_query(spark):
    want = shingle_components(documents(spark, SF_SMALL), 4, 80)
    got = queries.op3_minhash_near_dedup(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_pairs_a_star_misses_are_found(spark):
    """Bands of one bin put documents of little similarity in one bucket: its hub
    is like few of the others, which are compared all the same."""
    rows = near_copies(11)
    got = minhash.near_dedup(table(spark, rows), shingle=4, bands=64, band_rows=1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == shingle_components(rows, 4, 80)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (3, "A b  c d e f"), (None, None), (6, "q r s t")]
    got = minhash.near_dedup(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(3, 3, True), (5, 3, False), (5, 3, False), (6, 6, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert minhash.near_dedup(empty(spark)).count() == 0
    kept = minhash.drop_near(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "6", "None", "None"]


def test_densification_fills_every_bin_alike():
    signer = minhash.Signer()
    one = np.array([123456789], np.uint64)
    assert (signer.keys(one) == minhash.Signer().keys(one)).all() and len(set(signer.keys(one).tolist())) == minhash.BANDS
    rng = np.random.default_rng(3)
    # how often a band agrees follows similarity to the power of its rows
    for n, share in ((300, 0.9), (8, 7 / 9)):
        hits = []
        for _ in range(300):
            common = rng.integers(0, 2**63, n, np.uint64)
            extra = rng.integers(0, 2**63, max(1, round(n * (1 / share - 1) / 2)), np.uint64)
            a, b = np.unique(np.append(common, extra)), np.unique(np.append(common, extra ^ np.uint64(1 << 62)))
            s = len(common) / len(np.union1d(a, b))
            hits.append((np.mean(signer.keys(a) == signer.keys(b)), s**minhash.ROWS))
        got, want = np.mean(hits, axis=0)
        assert abs(got - want) < 0.12


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, k) for k in range(501, 560)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e} | {k: v for k, v in got.items() if root(k) == v}
    assert all(root(k) == v for k, v in got.items())
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
