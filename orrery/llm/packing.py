"""Harmonic packing of tokenised documents into sequences.

A piece of n ids belongs to the class k with capacity / (k + 1) < n <= capacity / k,
and a bin of class k takes exactly k pieces, whatever else happens: bins fill on
every worker by itself, in one pass and without a shuffle.

To leave little padding, a document is first cut at sizes that are exact
reciprocals (capacity, a half, a quarter, ... down to ``min_cut``): their bins
are full.  Only its tail, shorter than ``min_cut``, goes to a class that leaves a
rest, of less than 1 / (k + 1) of a bin.  Bins still open at the end of a
partition are poured one after another into full sequences, cut where one ends;
what remains is cut into sequences whose sizes are powers of two.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from orrery.llm.util import narrow

REMEMBER = 500_000
#: The split pattern of the tokenizer whose ASCII form is known here (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
RESULT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Sequence ids of a partition follow one another from its number shifted so far.
SHIFT = 33

Piece = tuple[int | None, int, bytes, int]  # doc_id, start, ids, doc_tokens


class Ids:
    """Ids of a text as little-endian 32-bit integers, by the library's own merges.

    A text of ASCII and Latin-1 letters without a special string's begin is
    lower-cased and split here, by the form the tokenizer's pattern has for such
    characters, and its parts go to the library's model.  Any other text is
    parted at ASCII white space, where this tokenizer's normaliser, special
    strings and pattern part too, and its words go through the whole library.
    What parts and words give is remembered up to a bound.
    """

    plain = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*").fullmatch
    parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+").findall

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(tokenizer)
        model, letters = library.model, byte_letters()
        self.of_part = _Known(lambda p: [t.id for t in model.tokenize(p.encode().decode("latin-1").translate(letters))])
        self.of_word = _Known(lambda w: library.encode(w, add_special_tokens=False).ids)
        self.alike = splits_alike(tokenizer)

    def __call__(self, text: str) -> bytes:
        if self.alike and self.plain(text) and "<|" not in text:
            return b"".join(map(self.of_part.__getitem__, self.parts(text.lower())))
        return b"".join([self.of_word[w.decode()] for w in text.encode().split()])


class _Known(dict):
    def __init__(self, ids: Callable[[str], list[int]]):
        super().__init__()
        self.ids = ids

    def __missing__(self, text: str) -> bytes:
        got = array("I", self.ids(text)).tobytes()
        if len(text) < 64:
            if len(self) >= REMEMBER:
                self.clear()
            self[text] = got
        return got


def byte_letters() -> dict[int, int]:
    """The letters byte-level tokenizers write bytes with: a printable byte is
    its own Latin-1 character, the others follow from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(others)}


def splits_alike(tokenizer: str) -> bool:
    """Whether the tokenizer lower-cases and splits as ``Ids.parts`` does, and writes bytes as letters."""
    given = json.loads(tokenizer)
    steps = (given.get("normalizer") or {}).get("normalizers", [])
    splits = (given.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"] == {"Regex": SPLIT} and not splits[1]["add_prefix_space"]
            and all(a["content"].startswith("<|") for a in given["added_tokens"]))


def cuts(n: int, capacity: int, min_cut: int) -> list[int]:
    """Sizes of a document's pieces, in order."""
    out = [capacity] * (n // capacity)
    n %= capacity
    size = capacity
    while size % 2 == 0 and size // 2 >= min_cut:
        size //= 2
        if n >= size:
            out.append(size)
            n -= size
    return out + [n] * (n > 0)


class _Packer:
    """The bins of one partition; at most one open bin a class, so what it holds is bounded by the capacity alone."""

    def __init__(self, capacity: int, min_cut: int, first: int):
        self.capacity, self.min_cut, self.next = capacity, min_cut, first
        self.open: dict[int, list[Piece]] = {}
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, ids, total, self.next, offset))
            offset += n
        self.next += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for n in cuts(total, self.capacity, self.min_cut):
            k = self.capacity // n
            held = self.open.setdefault(k, [])
            held.append((doc, start, ids[4 * start : 4 * (start + n)], total))
            if len(held) == k:
                self.close(self.open.pop(k))
            start += n

    def finish(self) -> None:
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[2]) // 4 for p in rest)
        sizes = [self.capacity] * (left // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if left % self.capacity >> b & 1]
        rest.reverse()
        for size in sizes:
            taken: list[Piece] = []
            while size:
                doc, start, ids, total = rest.pop()
                n = min(size, len(ids) // 4)
                taken.append((doc, start, ids[: 4 * n], total))
                if ids[4 * n :]:
                    rest.append((doc, start + n, ids[4 * n :], total))
                size -= n
            self.close(taken)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
         capacity: int = 2048, end_id: int = 1, min_cut: int = 128, rows_out: int = 20_000) -> DataFrame:
    """Pieces of all documents: doc_id, start and length in the document, ids
    (little-endian 32-bit), doc_tokens, sequence_id, offset in the sequence.

    ``tokenizer`` is the JSON of a tokenizer that parts words at ASCII white
    space; every document ends with ``end_id``.  A null or empty text is that id
    alone.  Rows that repeat are packed each by itself, a null id stays null, an
    empty table gives no piece.  ``capacity`` needs to be a power of two.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity is a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = Ids(tokenizer), end_id.to_bytes(4, "little")
        packer = _Packer(capacity, min_cut, TaskContext.get().partitionId() << SHIFT)

        def flush() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(packer.rows), rows_out):
                columns = zip(*packer.rows[i : i + rows_out], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SCHEMA.types, strict=True)], schema=SCHEMA)
            packer.rows = []

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                packer.add(doc, ids(text.as_py() or "") + end)
                if len(packer.rows) >= rows_out:
                    yield from flush()
        packer.finish()
        yield from flush()

    return narrow(docs, id_col, text_col).mapInArrow(run, RESULT)


def load(path: str) -> str:
    """The tokenizer's JSON, read where the plan is built and sent with the tasks."""
    return Path(path).read_text()
