import hashlib
import random
import re

import numpy as np
import pytest

from orrery.llm import quotient
from tests.llm.common import empty, table


def exact(rows):
    """One (doc_id, keep_id, group_size, sha256) per row, sorted."""
    groups = {}
    for i, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(n, []).append((-len(t or ""), i is None, i))
    out = []
    for n, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(i, keep, len(members), hashlib.sha256(n.encode()).hexdigest()) for _, _, i in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("top", [2**64 - 1, 2**63 + 5, 2**20, 3])
def test_filters_lose_nothing(top):
    rng = np.random.default_rng(top % 97)
    for n in (1, 2, 3, 10, 1000, 20_000):
        prints = rng.integers(0, top, n, np.uint64, endpoint=True)
        prints = np.append(prints, prints[: n // 3])
        found, counts = quotient.filter_of(prints)
        again = quotient.from_bytes(quotient.to_bytes(found, counts))
        assert (again[0] == found).all() and (again[1] == counts).all()
        cut = rng.permutation(prints)
        merged = quotient.merge([quotient.to_bytes(*quotient.filter_of(x)) for x in np.array_split(cut, 3) if len(x)])
        assert (merged[0] == found).all() and (merged[1] == counts).all()


def test_repeated_fingerprints(spark):
    rnd = random.Random(1)
    prints = [rnd.randrange(-(2**63), 2**63) for _ in range(500)] + [7] * 900 + [-1, -1, 0]
    prints += prints[:100]
    df = spark.createDataFrame([(x,) for x in prints], "fp long").repartition(7)
    for rows in (1, len(prints), 50 * quotient.SLICE_ROWS):  # sizes the slices only
        got = {r.fp: r.copies for r in quotient.repeated(df, rows).collect()}
        assert got == {x: prints.count(x) for x in set(prints) if prints.count(x) > 1}


def test_groups_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = ["same text", "same  text", "sametext\n", "Same text", "", " ", None, " ", "  ", "x" * 50_000, "x " * 50_000, "a\x00b", "a\x00 b"]
    rows = [(i, rnd.choice(texts)) for i in range(300)] + [(None, "same text"), (None, "alone"), (500, "only once"), (501, "x" * 50_000)]
    got = quotient.exact_dedup(table(spark, rows).repartition(5)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact(rows)
    kept = {}
    for r in got:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "ab"), (1, "ab"), (1, "a b"), (2, "a b"), (None, "a b"), (None, None)]
    got = quotient.exact_dedup(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact(rows)
    assert [(r.doc_id, r.keep_id) for r in got if r.kept and r.doc_id] == [(1, 1)] and sum(r.kept for r in got) == 2
    assert quotient.exact_dedup(empty(spark)).count() == 0
    kept = quotient.drop_copies(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", "a b"), ("None", "None")]
    assert quotient.drop_copies(empty(spark)).count() == 0


def test_lowest_and_highest_ids(spark):
    low, high = -(2**63), 2**63 - 1
    rows = [(low, "a b"), (high, "ab "), (0, "a b"), (None, "a b"), (low + 1, "c"), (None, "c")]
    got = quotient.exact_dedup(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact(rows)
    kept = quotient.drop_copies(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(low, "a b"), (low + 1, "c")]
