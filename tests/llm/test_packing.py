import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orrery.llm import packing, queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.common import documents, empty, table

JSON = packing.load(public_tokenizers.path("word_bpe_49k.json"))
ODD = ["a<|endoftext|>b <|startoftext|> <|EndOfText|> <|x", "İstanbul ΣΑΣ é é ́x \x1c\x1d a\x85b ǆ ﬁ", "", " \n",
       "don't I'LL we're 's ''s 12 3½ ② ~!@#$%^&*()_+{}:\"<>?[];',./`-= \x7f \x00a", "ÀÉÎõü ß ÿ × ÷ SS", "\x0b\x0c\r\n x", "word " * 3000]


def ids_of(texts):
    library = Tokenizer.from_str(JSON)
    return [[*e.ids, 1] for e in library.encode_batch(texts, add_special_tokens=False)]


def check(pieces, want, capacity):
    """Every id lies in one piece, sequences are gapless and hold no more than the capacity."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert docs.keys() == want.keys()
    for i, ids in want.items():
        at = 0
        for p in sorted(docs[i], key=lambda p: p.start):
            part = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, bytes(p.ids)) == (at, len(ids), part)
            at += p.length
        assert at == len(ids)
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_ids_equal_the_library(spark):
    texts = ODD + [t for _, t in documents(spark, SF_SMALL)]
    encode = packing.Ids(JSON)
    assert packing.splits_alike(JSON)
    for text, want in zip(texts, ids_of(texts), strict=True):
        assert np.frombuffer(encode(text), "<u4").tolist() == want[:-1], text[:80]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_every_id_once_and_little_padding(spark, capacity):
    rows = list(enumerate(ODD)) + [(100 + i, t) for i, t in documents(spark, SF_SMALL)]
    df = table(spark, rows).repartition(4)
    pieces = packing.pack(df, JSON, capacity=capacity, min_cut=capacity // 16).collect()
    want = {i: ids for (i, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True)}
    assert check(pieces, want, capacity) <= 0.02 * sum(map(len, want.values()))


def test_a_bin_of_a_class_holds_its_number_of_pieces():
    p = packing._Packer(2048, 128, 7)
    for n in (1024, 1024, 100, 101, 2048):
        p.add(1, b"\0" * 4 * n)
    assert [r[5] for r in p.rows] == [7, 7, 8] and [r[2] for r in p.rows] == [1024, 1024, 2048]
    assert packing.cuts(5000, 2048, 128) == [2048, 2048, 512, 256, 128, 8] and packing.cuts(1, 2048, 128) == [1]
    p.finish()
    assert sum(r[2] for r in p.rows) == 2 * 1024 + 201 + 2048
    totals = defaultdict(int)
    for r in p.rows:
        totals[r[5]] += r[2]
    assert all(n & (n - 1) == 0 for n in totals.values())


def test_null_empty_repeated_and_no_rows(spark):
    df = table(spark, [(1, None), (2, ""), (None, "ab"), (3, "ab cd"), (3, "ab cd")]).coalesce(1)
    got = packing.pack(df, JSON).collect()
    assert sum(p.length for p in got if p.doc_id in (1, 2)) == 2 and sum(p.length for p in got if p.doc_id == 3) == 6
    assert {p.doc_tokens for p in got if p.doc_id is None} == {2}
    assert packing.pack(empty(spark), JSON).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, JSON, capacity=1000)


def test_registered_query(spark):
    rows = queries.op4_packing(spark, SF_ORACLE).collect()
    docs = documents(spark, SF_ORACLE)
    want = dict(zip([i for i, _ in docs], ids_of([t for _, t in docs]), strict=True))
    seen = defaultdict(int)
    for p in rows:
        part = np.array(want[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()
        assert zlib.crc32(part) == p.ids_crc32
        seen[p.doc_id] += p.length
    assert dict(seen) == {i: len(ids) for i, ids in want.items()}
