"""SentencePiece encoding and decoding by an Aho-Corasick driven Viterbi pass.

One automaton holds all pieces.  It is run once over a text; at every position
its output links name the pieces that end there, and each relaxes the best score
known for that position.  For a unigram model a path scores the sum of its
pieces' scores.  For a BPE model two pieces may stand side by side only if the
merges of the two together leave just these two; a path all of whose neighbours
may stand so is the result of the merges, and there is one.

Text is cut only where no piece of the model can cross (``cut_pattern``).  Such
chunks repeat, so a worker remembers their ids, up to a bound.
"""

from __future__ import annotations

import codecs
import math
import re
import string
from array import array
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.util import narrow, portions

UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MARK = "▁"
#: How far below the lowest piece an unknown character scores in a unigram model.
UNKNOWN_PENALTY = 10.0
REMEMBER = 600_000

Edge = list[tuple[str, float, float]]


def cut_pattern(pieces: Iterable[str]) -> str | None:
    """A pattern whose matches, one after another, are a whole text, cut only
    between characters that stand side by side in no piece: before spaces,
    around characters of no longer piece, and between a letter and such
    punctuation as follows a letter in no piece.  Numerals that are word
    characters without being digits (² ½ ①) count as letters, but for those that
    punctuation follows in a piece.  None if pieces hold a space after something
    else."""
    beside = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
    if any(b == MARK and a != MARK for a, b in beside):
        return None
    joined = {c for pair in beside for c in pair}
    one = "".join(map(re.escape, (c for c in "\t\n\r0123456789" if c not in joined)))
    odd = {a for a, b in beside if b in string.punctuation and not a.isalpha() and re.match(r"[^\W\d_]", a)}
    letter = rf"[^\W\d_{''.join(sorted(odd))}]"
    ends = "".join(map(re.escape, sorted(set(string.punctuation) - {b for a, b in beside if re.match(letter, a)})))
    letters, stop = f"{letter}++", f"[{MARK}{one}{ends}]|$"
    return "|".join([f"[{one}]"] * bool(one) + [f"{MARK}*{letters}(?={stop})", f"{MARK}*[^{MARK}{one}]+", f"{MARK}+"])


codecs.register_error("orrery-each-byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class Decoder:
    """Text of ids: what each piece writes, and the space before a text."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        write = {BYTE: lambda p: bytes([int(p[1:-1], 16)]), UNKNOWN: lambda p: " ⁇ ".encode(), CONTROL: lambda p: b"",
                 NORMAL: lambda p: p.replace(MARK, " ").encode()}
        self.types = [p.type for p in proto.pieces]
        self.written = [write[p.type](p.piece) for p in proto.pieces]
        self.prefix = " " if proto.normalizer_spec.add_dummy_prefix else ""

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces give bytes (U+FFFD for each that is no UTF-8),
        control pieces nothing, the unknown piece its mark, an id outside the
        vocabulary raises IndexError."""
        out = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "orrery-each-byte")
        if self.prefix:
            first = next((i for i in ids if self.types[i] != CONTROL), None)
            if first is not None and self.types[first] == NORMAL:
                out = out.removeprefix(self.prefix)
        return out


class Pieces:
    """A .model file: ids by Viterbi.

    Serves models that leave the text as it is but for the space mark (identity
    normalisation) and have normal, byte, unknown and control pieces only; any
    other raises ValueError, since its results would differ from the library's.
    """

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with identity normalisation")
        if {p.type for p in proto.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only normal, byte, unknown and control pieces")
        self.kind = proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.unknown = self.types.index(UNKNOWN)
        self.byte_ids = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        self.fallback = BYTE in self.types
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ordered = True
        self.lowest = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        pattern = cut_pattern(self.ids)
        self.chunk = re.compile(pattern).findall if pattern else lambda text: [text]
        self.automaton = ahocorasick.Automaton()
        self.left_edge: dict[str, Edge] = {}
        self.right_edge: dict[str, Edge] = {}
        for piece in self.ids:
            if self.kind == UNIGRAM or len(piece) == 1 or self._edges(piece):
                self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        self.fits: set[tuple[str, str]] = set()
        self.clash: set[tuple[str, str]] = set()
        self.known: dict[str, bytes] = {}

    def _edges(self, piece: str) -> bool:
        """Whether the merges of the piece alone give the piece.  If so, keeps for
        its first and its last symbol what they grow into: each symbol with the
        time it forms (minus the score of the merge; a character is there from the
        start) and the time it is merged into the next."""
        out, steps = self._merged(piece)
        if out != [piece]:
            return False
        times = [t for t, _, _ in steps]
        for edge, side in ((self.left_edge, 0), (self.right_edge, 1)):
            grows: Edge = []
            symbol, formed, clock = piece[-side], -math.inf, -math.inf
            for t, parts, where in steps:
                clock = max(clock, t)
                if where[side]:
                    grows.append((symbol, formed, t))
                    symbol, formed = "".join(parts), clock
            edge[piece] = [*grows, (symbol, formed, math.inf)]
        # what may_follow reads off the edges needs merges in the order of their scores
        return times == sorted(times) or self._unordered()

    def _unordered(self) -> bool:
        self.ordered = False
        return True

    def merge(self, text: str) -> list[str]:
        """The merges themselves, best score first, then leftmost; for short strings."""
        return self._merged(text)[0]

    def _merged(self, text: str) -> tuple[list[str], list[tuple]]:
        out, steps = list(text), []
        while len(out) > 1:
            found = [(-self.scores[p], i) for i in range(len(out) - 1) if (p := out[i] + out[i + 1]) in self.scores]
            if not found:
                break
            t, i = min(found)
            steps.append((t, out[i : i + 2], (i == 0, i + 2 == len(out))))
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out, steps

    def may_follow(self, left: str, right: str) -> bool:
        pair = (left, right)
        if pair in self.clash:
            return False
        if pair in self.fits:
            return True
        if len(self.clash) + len(self.fits) >= REMEMBER:
            self.clash.clear()
            self.fits.clear()
        fit = self._stay_apart(left, right)
        (self.fits if fit else self.clash).add(pair)
        return fit

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge joins the last symbol of one piece with the first of
        the next, at any time both are there: such a merge comes first if its
        time is before the left symbol's own next merge and not after the right
        one's (of equals the leftmost goes first)."""
        if not self.ordered:
            return self.merge(left + right) == [left, right]
        scores = self.scores
        for a, a_from, a_to in self.right_edge.get(left) or ((left, -math.inf, math.inf),):
            for b, b_from, b_to in self.left_edge.get(right) or ((right, -math.inf, math.inf),):
                if a_from <= b_to and b_from < a_to:
                    score = scores.get(a + b)
                    if score is not None and -score < a_to and -score <= b_to:
                        return False
        return True

    def path(self, text: str) -> list[str]:
        """The best path; a character that is no piece stands alone."""
        return self._bpe_path(text) if self.kind == BPE else self._unigram_path(text)

    def _bpe_path(self, text: str) -> list[str]:
        last: list[str | None] = [""] + [None] * len(text)  # the piece that ends there
        ids, fits, may_follow = self.ids, self.fits, self.may_follow
        strange, n = [*(i for i, c in enumerate(text) if c not in ids), len(text)], 0
        for end, (piece, length) in self.automaton.iter(text):
            while strange[n] <= end:
                self._stand_alone(text, last, strange[n])
                n += 1
            end += 1
            if last[end] is None:
                before = last[end - length]
                if before is not None and (not before or ((before, piece) in fits or may_follow(before, piece))):
                    last[end] = piece
        for i in strange[n:-1]:
            self._stand_alone(text, last, i)
        return self._back(last)

    def _stand_alone(self, text: str, last: list[str | None], i: int) -> None:
        if last[i] is not None and last[i + 1] is None and (not last[i] or self.may_follow(last[i], text[i])):
            last[i + 1] = text[i]

    def _unigram_path(self, text: str) -> list[str]:
        best = [0.0] + [-math.inf] * len(text)
        last: list[str | None] = [""] + [None] * len(text)
        scores, ids = self.scores, self.ids
        strange, n = [*(i for i, c in enumerate(text) if c not in ids), len(text)], 0

        def relax(start: int, piece: str, score: float) -> None:
            end = start + len(piece)
            if last[start] is not None and (last[end] is None or best[start] + score > best[end]):
                best[end], last[end] = best[start] + score, piece

        for end, (piece, length) in self.automaton.iter(text):
            while strange[n] < end:
                relax(strange[n], text[strange[n]], self.lowest)
                n += 1
            relax(end + 1 - length, piece, scores[piece])
        for i in strange[n:-1]:
            relax(i, text[i], self.lowest)
        return self._back(last)

    @staticmethod
    def _back(last: list[str | None]) -> list[str]:
        out, n = [], len(last) - 1
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def _encode(self, text: str) -> bytes:
        ids: list[int] = []
        for p in self.path(text):
            i = self.ids.get(p)
            if i is not None:
                ids.append(i)
            elif self.fallback:
                ids += [self.byte_ids[b] for b in p.encode()]
            else:
                ids.append(self.unknown)
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; none for an empty text."""
        if not text:
            return b""
        known = self.known
        out = []
        for c in self.chunk((self.prefix + text).replace(" ", MARK)):
            got = known.get(c)
            if got is None:
                if len(known) >= REMEMBER:
                    known.clear()
                got = self._encode(c)
                if len(c) < 64:
                    known[c] = got
            out.append(got)
        return b"".join(out)


def load(path: str) -> bytes:
    """The model file, read where the plan is built and sent with the tasks (about 0.5 MB)."""
    return Path(path).read_bytes()


def encoder(model: bytes) -> Callable[[Column], Column]:
    """A column function text -> array<int> of ids; null gives an empty array."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(model)
        for texts in portions(batches):
            yield _lists([pieces.encode(t or "") for t in texts.to_pylist()])

    return encode


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 for x in ids], dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def coder(model: bytes) -> Callable[[Column], Column]:
    """A column function text -> struct(ids, text): the ids, and what decoding
    them gives, in one worker; null gives no ids and an empty text."""

    @F.arrow_udf("ids array<int>, text string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, decoder = Pieces(model), Decoder(model)
        for texts in portions(batches):
            ids = [pieces.encode(t or "") for t in texts.to_pylist()]
            again = pa.array([decoder.decode(np.frombuffer(x, "<i4").tolist()) for x in ids], pa.string())
            yield pa.StructArray.from_arrays([_lists(ids), again], ["ids", "text"])

    return both


def decoder(model: bytes) -> Callable[[Column], Column]:
    """A column function array<int> -> text; null gives null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Decoder(model)
        for lists in portions(batches):
            values, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            yield pa.array([pieces.decode(values[at[i] : at[i + 1]].tolist()) if there else None
                            for i, there in enumerate(lists.is_valid().to_pylist())], pa.string())

    return decode


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text.  Null and empty texts have no ids; an
    empty table gives an empty table; null ids and repeated rows are kept."""
    return narrow(docs, id_col, text_col).select("doc_id", encoder(model)("text").alias("ids"))
