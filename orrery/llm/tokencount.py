"""Token counts by the whole-token shortcut.

It is proved once, where the plan is built, which strings of the vocabulary the
library encodes as one token when they stand alone.  A pre-token (what no merge
can leave: a run of spaces with the word after it, or punctuation) that is such a string counts
one; only the rest goes through the library's merges.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from orrery.llm.pieces import BPE, MARK, NORMAL, cut_pattern
from orrery.llm.util import narrow, portions

REMEMBER = 200_000


def bare(model: bytes) -> bytes:
    """The model without the space the library puts before a text."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    proto.normalizer_spec.add_dummy_prefix = False
    return proto.SerializeToString()


def whole_tokens(model: bytes) -> frozenset[str]:
    """Vocabulary strings (the mark written as a space) that encode alone as one token."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=bare(model))
    texts = [p.piece.replace(MARK, " ") for p in proto.pieces if p.type == NORMAL]
    return frozenset(t for t, ids in zip(texts, library.encode(texts, num_threads=1), strict=True) if len(ids) == 1)


def pre_tokens(model: bytes) -> str | None:
    """A pattern whose matches, in a text with spaces for marks, no merge
    crosses; None if the model has no such pattern (then a text is one pre-token)."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    spec = proto.normalizer_spec
    if (proto.trainer_spec.model_type != BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces
            or not spec.escape_whitespaces or any(p.type in (4, 5) for p in proto.pieces)):
        return None
    pattern = cut_pattern([p.piece for p in proto.pieces if p.type == NORMAL])
    return pattern and pattern.replace(MARK, " ")


class _Counts(dict):
    """Tokens of a pre-token; starts from the proved ones, remembers others up to a bound."""

    def __init__(self, whole: frozenset[str], library: sentencepiece.SentencePieceProcessor):
        super().__init__(dict.fromkeys(whole, 1))
        self.bound, self.library = len(whole) + REMEMBER, library

    def __missing__(self, text: str) -> int:
        n = len(self.library.encode(text))
        if len(self) < self.bound and len(text) < 64:
            self[text] = n
        return n


def counter(model: bytes) -> Callable[[Column], Column]:
    """A column function text -> tokens (long); null and empty have none."""
    whole, pattern, plain = whole_tokens(model), pre_tokens(model), bare(model)
    dummy = sentencepiece_model_pb2.ModelProto.FromString(model).normalizer_spec.add_dummy_prefix

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if pattern is None:
            library = sentencepiece.SentencePieceProcessor(model_proto=model)
            for texts in batches:
                yield pa.array([len(library.encode(t)) if t else 0 for t in texts.to_pylist()], pa.int64())
            return
        counts, split = _Counts(whole, sentencepiece.SentencePieceProcessor(model_proto=plain)), re.compile(pattern).findall
        prefix = " " if dummy else ""
        for texts in portions(batches):
            yield pa.array([sum(map(counts.__getitem__, split(prefix + t.replace(MARK, " ")))) if t else 0
                            for t in texts.to_pylist()], pa.int64())

    return count


def count_tokens(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", *, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, as the library
    counts without begin or end marks.  A null text counts as empty: no bytes, no
    tokens.  Null ids and repeated rows are kept; an empty table gives an empty one."""
    rows = narrow(docs, id_col, text_col).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        counter(model)("text").alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
