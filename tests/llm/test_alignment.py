"""Alignment against the libraries' tokens and plain loops."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orrery.llm import alignment, packing, pieces, queries
from tests.conftest import SF_ORACLE
from tests.llm import common

JSON = packing.load(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
A = Tokenizer.from_str(JSON)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_OF = {**{chr(b): b for b in SHOWN}, **{chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}}
WORD_OF = {i: w for w, i in json.loads(JSON)["model"]["vocab"].items()}

ODD = ["hello world", "  two  spaces ", "don't 'tis we're I'M", "a\n\n b\t\r\n", "<|endoftext|> x <s> </s> <unk>", "▁ mark", "日本語 テキスト", "🧿a🧿 b",
       "nul\x00 in", "x\x85y\xa0z　q", "1234 5,678.90", "<0x41> byte", "ﬁ ½ km². ε", "ÀÉ×÷ñandú", "=" * 500, " " * 300, "a" * 3000,
       "᠎ z​q", "'s't'S", "naïve—dash…", "\n", "é" * 50 + "日" * 50]


def byte_ids(text):
    return A.encode(" " + text, add_special_tokens=False).ids


def groups(text):
    """[(A ids, B ids)] of a text, or None if it has no tokens."""
    if not text:
        return None
    a, b = byte_ids(text), B.encode(text)
    wrote_a = [bytes(BYTE_OF[c] for c in WORD_OF[i]) for i in a]
    wrote_b = [bytes([int(B.id_to_piece(i)[1:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(wrote_a) == b"".join(wrote_b) == (" " + text).encode():
        return None
    out, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(a):
        now = ([], [])
        while not out or now[0] or not now[1]:
            if not now[0] and not now[1] or at_a < at_b:
                now[0].append(a[i])
                at_a += len(wrote_a[i])
                i += 1
            elif at_b < at_a:
                now[1].append(b[j])
                at_b += len(wrote_b[j])
                j += 1
            if at_a == at_b:
                break
        out.append(now)
    return out


def brute(rows):
    found = [(i, groups(t)) for i, t in rows]
    docs_with, links = Counter(), []
    for _, g in found:
        times = Counter()
        for x, y in g or []:
            m, n = Counter(x), Counter(y)
            for p, k in m.items():
                for q, l in n.items():
                    times[p, q] += k * l
        links.append(times)
        docs_with.update(times.keys())
    top = defaultdict(int)
    for (p, _), c in docs_with.items():
        top[p] = max(top[p], c)
    out = []
    for (i, g), times in zip(found, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append((i, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(times.values()),
                    sum(k for p, k in times.items() if docs_with[p] == top[p[0]]), sum(k * docs_with[p] for p, k in times.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_registered_query_against_plain_loops(spark):
    rows = common.documents(spark, SF_ORACLE)
    assert listed(queries.op12_token_alignment(spark, SF_ORACLE)) == sorted(brute(rows), key=str)


def test_odd_null_empty_repeated_and_clashing(spark):
    rows = [*enumerate(ODD), (900, None), (901, ""), (None, "null id"), (902, "again"), (902, "again")]
    df = common.table(spark, rows).withColumns({c: F.lit("own") for c in ("block", "pair", "at", "c", "best", "digests")}).repartition(4)
    got = alignment.align_documents(df, JSON, MODEL)
    assert got.columns == [c.split()[0] for c in alignment.RESULT.split(", ")]
    assert listed(got) == sorted(brute(rows), key=str)
    assert next(r for r in got.collect() if r.doc_id == ODD.index("▁ mark"))[1:] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.align_documents(common.empty(spark), JSON, MODEL).collect() == []


def test_blocks_change_nothing(spark):
    rows = [(i, f"text {i % 7} of {'many ' * (i % 5)}words") for i in range(60)]
    one = listed(alignment.align_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), JSON, MODEL))
    many = listed(alignment.align_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), JSON, MODEL))
    assert one == many == sorted(brute(rows), key=str)


def test_wide_groups(monkeypatch):
    align = alignment.Aligner(JSON, MODEL)
    facts, pairs = align(ODD)
    monkeypatch.setattr(alignment, "WIDE", 1)
    facts_0, pairs_0 = align(ODD)

    def as_set(t):
        return sorted(zip(*(t.column(c).to_pylist() for c in ("doc", "pair", "times"))))

    assert [list(map(str, v)) for v in facts.values()] == [list(map(str, v)) for v in facts_0.values()]
    assert as_set(pairs) == as_set(pairs_0)


def test_a_very_long_text(spark):
    long = "one two three's, 44 " * 150_000
    r, = alignment.align_documents(spark.createDataFrame([(1, long)], "doc_id long, text string"), JSON, MODEL).collect()
    assert r.n_a == len(byte_ids(long)) and r.n_b == len(B.encode(long)) and r.count_sum == r.n_links


@pytest.fixture(scope="module")
def coders():
    return alignment.byte_level(JSON)[0], alignment.sentence_pieces(MODEL)[0]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", "é", "Ÿ", "ɏ", "1", "½", "²", "'s", "'", ".", ",", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0",
                                 "᠎", "​", " ", "　", "ε", "日", "🧿", "-", "_", "<|endoftext|>", "×", "ǅ", "ª", "µ"]), min_size=1, max_size=14))
def test_chunks_give_the_libraries_ids(coders, parts):
    text = "".join(parts)
    assert coders[0]([" " + text]).flatten().to_pylist() == byte_ids(text)
    if "▁" not in text:
        assert coders[1]([text]).flatten().to_pylist() == B.encode(text)
