"""Language-model scores against word counts and a bit-by-bit model in plain Python."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from orrery.llm import mixing, queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import common


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10


def base_scores(rows):
    """doc_id -> (held_out, n_tokens, n_known, N, base_score)."""
    words = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    counts = Counter()
    for i, w in words.items():
        if remainder(i):
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return {i: (remainder(i) == 0, len(w), sum(counts[x] > 0 for x in w), n,
                sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in words.items()}


def counted(rows):
    """Cell counts per predictor, one document at a time."""
    out = [Counter() for _ in mixing.SLOTS]
    for i, t in rows:
        if remainder(i):
            s = mixing.sequence(mixing.tokens(t))
            for c, (high, low) in zip(out, mixing.cells(mixing._joined([s]))[0]):
                c.update(high.tolist())
                c.update(low.tolist())
    return out


def plain_score(sequence, counts):
    """The model a bit at a time, with dictionaries."""
    cells, _ = mixing.cells(mixing._joined([sequence]))
    weights = {}
    total = 0.0
    for at, size in mixing._stretches(len(sequence)):
        steps, seen = {}, Counter()
        for i in range(at, min(at + size, len(sequence))):
            before = sequence[i - 1] if i else 10
            gate = int(mixing._GATE[before])
            seen[gate] += 1
            for half, value in ((0, sequence[i] >> 4), (1, sequence[i] & 15)):
                node = 1
                for k in range(4):
                    x = []
                    for c, pair in zip(counts, cells):
                        slot = int(pair[half][i]) & ~15
                        span = 16 >> k
                        first = slot + (node << (4 - k)) - 16
                        n = [sum(c[first + b * span // 2 + j] for j in range(span // 2)) for b in (0, 1)]
                        logit = math.log((n[1] + mixing.PRIOR) / (n[0] + mixing.PRIOR))
                        x.append(max(-127, min(127, round(logit * mixing.STEP))) / mixing.STEP)
                    key = (gate, 4 * half + k)
                    w, o = weights.setdefault(key, ([mixing.WEIGHT] * len(x), [0.0]))
                    p = 1 / (1 + math.exp(-(o[0] + sum(a * b for a, b in zip(w, x)))))
                    bit = value >> (3 - k) & 1
                    total += math.log10(p if bit else 1 - p)
                    g = steps.setdefault(key, [0.0] * (len(x) + 1))
                    for j, v in enumerate([*x, 1.0]):
                        g[j] += (bit - p) * v
                    node = node << 1 | bit
        for (gate, b), g in steps.items():
            w, o = weights[gate, b]
            shrink = 1 / max(seen[gate] / 16, 1)
            for j in range(len(w)):
                w[j] += mixing.RATE * shrink * g[j]
            o[0] += mixing.OFFSET_RATE * shrink * g[-1]
    return total


def test_query_against_word_counts(spark):
    rows = common.documents(spark, SF_ORACLE)
    want = base_scores(rows)
    got = queries.op13_lm_scores(spark, SF_ORACLE).collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isclose(r.bits_per_byte, -r.score * math.log2(10) / r.n_bytes, rel_tol=1e-12)
    apart = [r for r in got if r.held_out]
    # what the mixed predictors know of documents they didn't learn from is worth more than word counts
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)


def test_scores_are_those_of_a_bit_by_bit_model_under_any_partitioning(spark):
    rows = sorted(common.documents(spark, SF_SMALL), key=lambda r: len(r[1] or ""))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counts = counted(rows)
    found = {}
    for parts in (1, 7):
        df_n = df.repartition(parts)
        for r in mixing.score_documents(df_n, mixing.fit(df_n)).collect():
            found.setdefault(r.doc_id, []).append(r.score)
    assert all(a == b for a, b in found.values())
    for i, t in [*rows[:20], *rows[90:100]]:
        want = plain_score(mixing.sequence(mixing.tokens(t)), counts)
        assert math.isclose(found[i][0], want, rel_tol=2e-4), (i, found[i][0], want)


def test_probabilities_of_all_next_bytes_sum_to_one(spark):
    df = spark.createDataFrame([(i, "one two three four " * 9) for i in range(40)], "doc_id long, text string")
    tables = mixing.fit(df).tables()
    asked = [b"tw", *(b"tw" + bytes([v]) for v in range(256))]
    p = {s: 10**x for s, x in zip(asked, mixing.score(asked, tables))}
    assert math.isclose(sum(p[b"tw" + bytes([v])] for v in range(256)), p[b"tw"], rel_tol=1e-4)
    assert p[b"two"] > 0.5 * p[b"tw"]


def test_nonsense_scores_below_text_of_the_corpus(spark):
    rows = common.documents(spark, SF_ORACLE)
    some = [(i, t) for i, t in rows if t and 200 < len(t) < 5000][:20]
    rng = np.random.default_rng(1)
    mixed = [(10_000_000 + i, " ".join("".join(rng.permutation(list(w))) for w in t.split())) for i, t in some]
    got = {r.doc_id: r for r in mixing.score_documents(
        spark.createDataFrame([*some, *mixed], "doc_id long, text string"),
        mixing.fit(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(got[10_000_000 + i].bits_per_byte > got[i].bits_per_byte + 0.3 for i, _ in some)


def test_null_empty_repeated_long_and_clashing(spark):
    long = "word " * 400_000
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a b"), (4, "Ab c"), (4, "Ab c"), (5, long), (6, "x" * 1_000_000), (7, "ÄB \x00 é")]
    df = common.table(spark, rows).withColumns({c: F.lit("own") for c in ("block", "words", "held", "train", "score")})
    got = mixing.score_documents(df, mixing.fit(df)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[4][0] == by[4][1]
    assert by[None][0].held_out is False
    ends = {(r.n_tokens, r.n_bytes, round(r.score, 9), round(r.base_score, 9)) for i in (1, 2, 3) for r in by[i]}
    assert len(ends) == 1 and next(iter(ends))[:2] == (1, 1)
    counts = Counter()
    for i, t in rows:
        if i is not None and remainder(i):
            counts.update([*(t or "").encode().lower().split(), b"\n"])
    for r in got:
        assert r.train_tokens == sum(counts.values())
    assert by[5][0].n_tokens == 400_001 and by[5][0].bits_per_byte < 0.5


def test_empty_table(spark):
    df = common.empty(spark)
    assert mixing.score_documents(df, mixing.fit(df)).collect() == []


def test_without_training_documents_bits_are_even(spark):
    held = next(i for i in range(100) if remainder(i) == 0)
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r, = mixing.score_documents(df, mixing.fit(df)).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)
    assert math.isclose(r.score, -8 * 4 * math.log10(2), rel_tol=1e-6)


def test_windows_find_the_cells_of_the_whole(monkeypatch):
    rng = np.random.default_rng(2)
    text = b"".join(rng.choice([b"a", b"b", b"word", b" ", b"\n", b"x" * 300, "é".encode()], 400).tolist())
    buf = mixing._joined([text, b"short\n", b"\n"])
    whole, _ = mixing.cells(buf)
    monkeypatch.setattr(mixing, "WINDOW", 37)
    parts = [found for _, found in mixing.windows(buf)]
    for k, halves in enumerate(whole):
        for i, half in enumerate(halves):
            assert (np.concatenate([p[k][i] for p in parts]) == half).all()
    alone, _ = mixing.cells(mixing._joined([b"short\n"]))
    at = mixing.LEAD + len(text)
    assert all((a == w[at : at + 6]).all() for x, y in zip(alone, whole) for a, w in zip(x, y))


def test_runs_of_equal_weights_are_filled_one_by_one_or_repeated(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [b" ".join(rng.choice([b"one", b"two", b"x" * 40, "é".encode()], n).tolist()) + b"\n" for n in (3, 90, 900)]
    tables = [rng.integers(-2**31, 2**31 - 1, 16 << s, dtype=np.int32) for s in mixing.SLOTS]
    found = []
    for long in (0, 1 << 40):
        monkeypatch.setattr(mixing, "LONG", long)
        found.append(mixing.score(texts, tables).tolist())
    assert found[0] == found[1]


def test_tables_hold_the_logits_on_the_way_to_a_half_byte():
    nodes = np.random.default_rng(4).integers(-127, 128, (mixing.SLICE // 16, 16)).astype(np.int8)
    table = mixing.Predictors({1: mixing.zstandard.ZstdCompressor().compress(nodes.tobytes())}).tables()[0]
    assert not table[: mixing.SLICE].any()
    got = table[mixing.SLICE : 2 * mixing.SLICE].view(np.int8).reshape(-1, 16, 4)
    for v in range(16):
        for k in range(4):
            assert (got[:, v, k] == nodes[:, 1 << k | v >> (4 - k)]).all()


def test_words_split_together_are_those_of_each_text():
    texts = ["", None, " ", "a  b", " \x1c\x1d\x1e\x1f\x85 x\x0b\x0cy\r\nz\t", "Ä b\xa0C ÄÖ", "\x00 a", "AZ[@`", *(f"A{chr(c)}b{chr(c)}" for c in range(300))]
    found = mixing.split(mixing.pa.array(texts, mixing.pa.string()))
    words = [[w.encode() for w in x if w] for x in found.to_pylist()]
    assert words == [mixing.tokens(t) for t in texts]
    assert mixing.sequences(found) == [mixing.sequence(w) for w in words]


def test_parts_of_a_stretch_do_not_change_scores(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [b" ".join(rng.choice([b"one", b"two", b"x" * 40, "é".encode()], n).tolist()) + b"\n" for n in (0, 3, 3, 90, 90, 900, 2000)]
    tables = [rng.integers(-2**31, 2**31 - 1, 16 << s, dtype=np.int32) for s in mixing.SLOTS]
    whole = mixing.score(texts, tables).tolist()
    monkeypatch.setattr(mixing, "PART", mixing.LONGEST)
    assert mixing.score(texts, tables).tolist() == whole
    assert [mixing.score([t], tables)[0] for t in texts] == whole


def test_a_block_counts_each_documents_words(spark):
    rows = [(1, "b a b"), (2, None), (3, "A c"), (4, " "), (None, "a a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    flags = df.selectExpr("doc_id", "doc_id is null held", "doc_id > 1 train", "text").na.fill(False, ["train"])
    r, = mixing._blocks(flags, mixing.fit(df)).collect()
    assert (r.doc_ids, r.n_tokens, r.n_bytes, r.distinct) == ([1, 2, 3, 4, None], [4, 1, 3, 1, 3], [6, 1, 4, 1, 4], [3, 1, 3, 1, 2])
    words = [bytes(w) for w in r.words]
    assert dict(zip(words, r.trained)) == {b"b": 0, b"a": 1, b"c": 1, b"\n": 3}
    at, times = mixing.from_planes(bytes(r.postings), 2)
    places = iter(zip(np.cumsum(at).tolist(), times.tolist()))
    got = [{words[p]: t for p, t in (next(places) for _ in range(n))} for n in r.distinct]
    assert got == [dict(Counter([*mixing.tokens(t), b"\n"])) for _, t in rows]


def test_corpus_counts_sort_the_words_once(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(20)], "doc_id long, text string")
    thin = df.selectExpr("doc_id of_block", "0 at", "text word", "1L trained")
    plan = mixing.corpus_counts(thin)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1
    rows = mixing.corpus_counts(thin).collect()
    assert {r.c for r in rows} == {20} and [r.of_block for r in rows if r.first] == [0]
