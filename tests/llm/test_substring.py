import hashlib
import random

import numpy as np

from orrery.llm import queries, substring
from orrery.llm.minhash import WordHashes
from tests.conftest import SF_ORACLE
from tests.llm.common import documents, empty, table


def brute(rows, size):
    """(doc_id, text) -> (words, removed, kept text)."""
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for j in range(len(w) - size + 1):
            k = tuple(w[j : j + size])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            if i is not None and first[tuple(w[j : j + size])] < i:
                gone[j : j + size] = [True] * size
        out[i, t] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


def passages(seed=4):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "b", "cc", "Dd", "é", "e."]) + str(rnd.randrange(300))
    shared = [[word() for _ in range(rnd.choice([6, 7, 20, 40]))] for _ in range(6)]
    rows = []
    for i in range(200):
        text = []
        for _ in range(rnd.randrange(4)):
            text += [word() for _ in range(rnd.randrange(12))] + (rnd.choice(shared) if rnd.random() < 0.6 else [])
        rows.append((rnd.choice([i, i, i, 1000 - i]), rnd.choice([" ", "\n", "\t "]).join(text)))
    line = "over and over it goes "
    return rows + [(2000, line * 30), (2001, line * 500), (1999, "start " + line * 30 + "end")]


def test_removed_words_equal_brute_force(spark):
    rows = passages() + [(3000, None), (3001, ""), (3002, " \n"), (None, passages()[0][1]), (3003, "  nbsp word")]
    rows = list(dict.fromkeys(rows))
    want = brute(rows, 6)
    # a narrow sketch lets nearly everything through, a wide one nearly nothing
    for bits in (6, 16):
        df = table(spark, rows).repartition(5)
        got = substring.substring_dedup(df, size=6, width_bits=bits).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(
            (str(i), *v) for (i, _), v in want.items())


def test_a_task_may_send_its_windows_in_parts(spark, monkeypatch):
    rows = list(dict.fromkeys(passages(8)))
    want = brute(rows, 6)
    monkeypatch.setattr(substring, "LEAST_SLICES", 1)
    monkeypatch.setattr(substring, "SLICE_WINDOWS", 10)
    got = substring.substring_dedup(table(spark, rows).repartition(3), size=6, width_bits=10).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == sorted((i, v[0], v[1]) for (i, _), v in want.items())


def test_registered_query(spark):
    want = brute(documents(spark, SF_ORACLE), 50)
    got = queries.op6_substring_dedup(spark, SF_ORACLE).collect()
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, gone, kept) in want.items()}


def test_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (9, text), (None, text), (5, "x " + text)]
    got = substring.substring_dedup(table(spark, rows), size=6, width_bits=12).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == [
        ("5", 7, 0), ("5", 7, 0), ("5", 8, 0), ("9", 7, 7), ("None", 7, 0)]
    assert substring.substring_dedup(empty(spark), width_bits=12).count() == 0


def test_window_hashes_do_not_depend_on_the_place():
    words = [str(i % 7).encode() for i in range(100)]
    a = substring.windows(words, 10, WordHashes())
    b = substring.windows([b"x", b"y", *words, b"z"], 10, WordHashes())
    assert (a[0] == b[0][2:-1]).all() and (a[1] == b[1][2:-1]).all()
    assert len(np.unique(a[0])) == 7 and len(substring.windows(words[:9], 10, WordHashes())[0]) == 0
    x = np.array([0, 3, 3, 2**22 - 1], np.uint32)
    assert (substring.unpack(substring.pack(x), "<u4") == x).all()
