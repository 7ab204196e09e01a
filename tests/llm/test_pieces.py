import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from orrery.llm import pieces, queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.common import documents, empty, table

MODEL = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = ["plain words here.", "  two  spaces   and tabs\t\tx\n\n\n", "日本語テキスト 가나다 🙂 naïve", "a" * 3000, "", " ", "x", "<s> </s> <unk> <0x0A>",
         "\u0000\u0001 ok\r\n", "https://foo.bar/baz?q=1&r=2 function(){return;}", "==== /// ....,,,, 12,345.67", "ﷺ ḁ́ Ⅷ​ zero"]


def unigram():
    """The same pieces as a unigram model, with scores small enough for the library's 32-bit sums."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    proto.trainer_spec.model_type = pieces.UNIGRAM
    for p in proto.pieces:
        p.score = max(p.score, -40000) / 64
    return proto.SerializeToString()


@pytest.mark.parametrize("model", [MODEL, unigram()], ids=["bpe", "unigram"])
def test_ids_equal_the_library(spark, model):
    texts = TEXTS + [t for _, t in documents(spark, SF_SMALL)]
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    df = table(spark, list(enumerate(texts))).repartition(3)
    got = {r.doc_id: r.ids for r in pieces.encode(df, model).collect()}
    assert [got[i] for i in range(len(texts))] == library.encode(texts)


def test_pieces_between_letters_are_cut_nowhere(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    m = pieces.Pieces(MODEL)
    middles = [p.replace(pieces.MARK, " ") for p in m.ids]
    texts = ["5 km². The", "²", "x².", "½.", "①, ②.", *(f"{a}{p}{b}" for p in middles for a, b in (("m", "t"), ("m", ". T"), ("²", "½")))]
    assert "²." in middles
    want = library.encode(texts)
    wrong = [t for t, ids in zip(texts, want, strict=True) if np.frombuffer(m.encode(t), "<i4").tolist() != ids]
    assert not wrong, wrong[:20]
    got = pieces.encode(table(spark, [(1, texts[0])]), MODEL).first().ids
    assert got == want[0]


def test_decoding_equals_the_library_and_restores_texts(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    decode = pieces.Decoder(MODEL).decode
    for ids in library.encode(TEXTS) + [[], [0], [1, 2], [1, 413], [239, 187], [300, 0, 5000]]:
        assert decode(ids) == library.decode(ids)
    rows = queries.op1_sentencepiece(spark, SF_SMALL).collect()
    assert len(rows) == 200 and all(r.restored and r.n_ids == len(r.ids) for r in rows)


def test_pieces_side_by_side_as_the_merges_leave_them():
    m = pieces.Pieces(MODEL)
    some = [p for p in m.ids if len(p) == 1 or p in m.left_edge][:4000:13]
    for a in some[::5]:
        for b in some[::3]:
            assert m.may_follow(a, b) == (m.merge(a + b) == [a, b]), (a, b)


def test_null_empty_and_repeated_rows(spark):
    df = table(spark, [(1, None), (2, ""), (None, "ab"), (3, "ab"), (3, "ab"), (4, "word " * 50_000)])
    got = pieces.encode(df, MODEL).collect()
    assert len(got) == 6 and all(r.ids == [] for r in got if r.doc_id in (1, 2))
    assert pieces.encode(empty(spark), MODEL).count() == 0
    one = spark.createDataFrame([(None,), ([413],)], "ids array<int>").select(pieces.decoder(MODEL)("ids").alias("t"))
    assert sorted(one.collect(), key=str)[-1].t is None or one.where(F.col("t").isNull()).count() == 1


def test_other_models_are_refused():
    proto = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.Pieces(proto.SerializeToString())


def test_letters_and_unknown_characters_in_turn_take_linear_time(spark):
    """5 MB without a character the vocabulary joins to the next."""
    text = "a🧿" * 1_000_000
    r, = pieces.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), MODEL).collect()
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    some = library.encode("a🧿" * 50)
    assert list(r.ids[: len(some)]) == some and len(r.ids) == len(library.encode(text))


def test_registered_query_against_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op1_sentencepiece(spark, SF_ORACLE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "")
        assert (r.n_ids, list(r.ids)) == (len(ids), ids)
        assert r.restored == (library.decode(ids) == (texts[r.doc_id] or ""))
