import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from orrery.llm import pieces, queries, tokencount
from tests.conftest import SF_ORACLE
from tests.llm.common import documents, empty, table
from tests.llm.test_pieces import TEXTS

MODEL = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def test_counts_equal_the_library(spark):
    rows = list(enumerate([*TEXTS, "▁▁x ▁", "end.Start,next;x's (a).b", "𝔘𝔫𝔦 ﬁ ½", "word. " * 30_000])) + [(900, None), (None, "ab"), (901, "ab"), (901, "ab")]
    got = tokencount.count_tokens(table(spark, rows), MODEL).collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "")), len(LIBRARY.encode(t or "")) > 4096) for i, t in rows]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got))) == sorted(map(str, want))
    assert tokencount.count_tokens(empty(spark), MODEL).count() == 0


def test_pieces_between_letters_count_as_in_the_library(spark):
    middles = [p.replace(pieces.MARK, " ") for p in pieces.Pieces(MODEL).ids]
    texts = ["5 km². The", "x².", "½.", *(f"{a}{p}{b}" for p in middles for a, b in (("m", "t"), ("m", ". T"), ("²", "½")))]
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(table(spark, list(enumerate(texts))), MODEL).collect()}
    wrong = [t for i, (t, ids) in enumerate(zip(texts, LIBRARY.encode(texts), strict=True)) if got[i] != len(ids)]
    assert not wrong, wrong[:20]


def test_registered_query(spark):
    rows = documents(spark, SF_ORACLE)
    counts = [len(x) for x in LIBRARY.encode([t for _, t in rows])]
    got = {r.doc_id: r.n_tokens for r in queries.op10_token_counts(spark, SF_ORACLE).collect()}
    assert got == {i: n for (i, _), n in zip(rows, counts, strict=True)}


def test_whole_tokens_are_proved():
    whole = tokencount.whole_tokens(MODEL)
    bare = sentencepiece.SentencePieceProcessor(model_proto=tokencount.bare(MODEL))
    some = sorted(whole)[::97]
    assert len(whole) > 30_000 and all(len(x) == 1 for x in bare.encode(some))


def test_a_model_that_can_merge_across_spaces_is_not_cut(spark):
    proto = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    proto.pieces.add(piece="e▁t", score=-1.5)
    model = proto.SerializeToString()
    assert tokencount.pre_tokens(model) is None and pieces.cut_pattern(["a▁b"]) is None
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    text = "the tone to see the time"
    assert tokencount.count_tokens(table(spark, [(1, text)]), model).first().n_tokens == len(library.encode(text)) != len(LIBRARY.encode(text))
    assert pieces.encode(table(spark, [(1, text)]), model).first().ids == library.encode(text)
