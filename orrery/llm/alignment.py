"""Alignment of two tokenizers' tokens over the bytes of a text, by Arrow.

Tokens of a batch are flattened lists with their documents as parent indices;
cumulative sums of the tokens' bytes, less what stands before each document, are
their ends.  An Acero hash join of both sides' (document, end) keys finds the
offsets where both end; these cut the tokens into groups, and every two tokens
of a group are linked.  How many documents hold a pair of ids linked is counted
by ``Table.group_by`` per block of documents and summed by Spark; only those
counts return to the block, whose documents then look theirs up.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from orrery.llm.packing import byte_letters
from orrery.llm.pieces import BYTE, MARK
from orrery.llm.tokencount import bare, pre_tokens
from orrery.llm.util import from_planes, narrow, planes, short_batches, staged

#: Chunks whose ids a worker remembers, a tokenizer.
REMEMBER = 300_000
#: Characters of the texts that are aligned at a time, and of a block.
STEP_CHARS, BLOCK_CHARS = 1_000_000, 4_000_000
#: Ends of a document are below this many bytes.
FAR = 1 << 40
#: Groups of more links than this are counted by distinct ids rather than link by link.
WIDE = 64

BLOCK = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
         "digests array<string>, pairs array<long>, docs array<long>, distinct array<long>, postings binary")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


class _Chunks:
    """Ids of texts by chunks that no token crosses, remembered up to a bound;
    chunks that are not known go to the library together."""

    def __init__(self, split: Callable[[str], list[str]], ids: Callable[[list[str]], list[list[int]]]):
        self.split, self.ids = split, ids
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> pa.ListArray:
        parts = [self.split(t) for t in texts]
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        new = list({c for p in parts for c in p if c not in known})
        for c, ids in zip(new, self.ids(new), strict=True):
            known[c] = array("i", ids).tobytes()
        found = [b"".join(map(known.__getitem__, p)) for p in parts]
        for c in new:
            if len(c) > 64:
                del known[c]
        ends = np.cumsum([0] + [len(x) // 4 for x in found], dtype="<i4")
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))


#: White space other than space, tab and line ends, and what older Unicode tables count as such.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]").search
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: White space with a word of such letters that an ASCII character which is none
#: ends, or with all up to the next white space.  The tokenizer's pattern parts
#: there too, and looks back nowhere.
_BYTE_CHUNKS = re.compile(rf"[ \t\n\r]*+[{_LETTER}]++(?=[\t\n\r -@\[-`{{-~]|\Z)|[ \t\n\r]*+[^ \t\n\r]++|[ \t\n\r]++").findall

#: Chunks that the pattern leaves whole: they go to the library's merges at once.
_ONE_WORD = re.compile(rf" ?[{_LETTER}]++").fullmatch


def byte_level(tokenizer: str) -> tuple[_Chunks, pa.Array]:
    """Encoder and bytes per id of a byte-level BPE in the tokenizers library's
    JSON; special strings inside texts are plain text."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer)
    library.encode_special_tokens = True
    given = json.loads(tokenizer)
    split = given.get("pre_tokenizer") or {}
    plain = (not given.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space"))

    def chunks(text: str) -> list[str]:
        return _BYTE_CHUNKS(text) if plain and not _ODD_SPACE(text) else [text]

    merges, letters = library.model, {b: chr(letter) for b, letter in byte_letters().items()}

    def ids(parts: list[str]) -> list[list[int]]:
        out = [[t.id for t in merges.tokenize(p.encode().decode("latin-1").translate(letters))] if plain and _ONE_WORD(p) else None for p in parts]
        others = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(others, library.encode_batch_fast([parts[i] for i in others], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    back = {chr(b): b for b in range(256)} | {chr(letter): b for b, letter in byte_letters().items()}
    written: list[bytes] = [b""] * library.get_vocab_size(with_added_tokens=True)
    for token, i in library.get_vocab(with_added_tokens=True).items():
        written[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return _Chunks(chunks, ids), pa.array(written, pa.binary())


def sentence_pieces(model: bytes) -> tuple[_Chunks, pa.Array]:
    """Encoder and bytes per id of a SentencePiece model, the space it puts
    before a text among them."""
    pattern = pre_tokens(model)
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=bare(model) if pattern else model)
    prefix = " " if proto.normalizer_spec.add_dummy_prefix else ""
    find = re.compile(pattern).findall if pattern else None

    def chunks(text: str) -> list[str]:
        return find(prefix + text.replace(MARK, " ")) if find else [text]

    def ids(parts: list[str]) -> list[list[int]]:
        return library.encode(parts, num_threads=1) if parts else []

    written = [bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode() for p in proto.pieces]
    return _Chunks(chunks, ids), pa.array(written, pa.binary())


def _spans(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy().astype(np.int64)


def _kept(lists: pa.ListArray, good: np.ndarray) -> pa.ListArray:
    """The lists, empty where not ``good``."""
    if good.all():
        return lists
    at = _spans(lists)
    sizes = np.where(good, np.diff(at), 0)
    flat = lists.flatten().to_numpy()[np.repeat(good, np.diff(at))]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("<i4")), pa.array(flat, pa.int32()))


def _joined_equal(lists: pa.ListArray, written: pa.Array, wanted: list[bytes]) -> np.ndarray:
    """Per document, whether its tokens' bytes one after another are those wanted."""
    taken = written.take(lists.flatten())
    ends = np.frombuffer(taken.buffers()[1], "<i4", len(taken) + 1, taken.offset * 4)[_spans(lists)]
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    return np.array([data[i:j] == w for i, j, w in zip(ends, ends[1:], wanted, strict=False)], bool)


def _keyed(lists: pa.ListArray, sizes: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Flat ids, their documents, and a table of (document, end) keys with places."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    summed = pc.cumulative_sum(sizes.take(flat))
    before = np.concatenate([[0], summed.to_numpy()])[_spans(lists)[:-1]]
    end = pc.subtract(summed, pa.array(before).take(parent))
    key = pc.add(pc.multiply(parent, FAR), end)
    return flat.to_numpy(), parent.to_numpy(), pa.table({"key": key, name: pa.array(np.arange(len(flat)))})


class Aligner:
    """Groups and links of a list of texts."""

    def __init__(self, tokenizer: str, model: bytes):
        self.encode_a, self.bytes_a = byte_level(tokenizer)
        self.encode_b, self.bytes_b = sentence_pieces(model)
        self.sizes_a, self.sizes_b = (pc.binary_length(x).cast(pa.int64()) for x in (self.bytes_a, self.bytes_b))
        self.base = len(self.bytes_b)  # a pair of ids is a * base + b
        inner_a, last_a = ([f"{i}{mark}" for i in range(len(self.bytes_a))] for mark in ",|")
        inner_b, last_b = ([f"{i}{mark}" for i in range(self.base)] for mark in ",;")
        self.names = pa.array(inner_a + last_a + inner_b + last_b, pa.string())

    def __call__(self, texts: list[str | None]) -> tuple[dict[str, list], pa.Table]:
        """Per document n_a, n_b, n_groups, n_links and digest; and (doc, pair,
        times) of its distinct linked pairs."""
        given = [t or "" for t in texts]
        a, b = self.encode_a([" " + t if t else "" for t in given]), self.encode_b(given)
        wanted = [(" " + t).encode() for t in given]
        good = _joined_equal(a, self.bytes_a, wanted) & _joined_equal(b, self.bytes_b, wanted)
        a, b = _kept(a, good), _kept(b, good)
        ids_a, doc_a, ends_a = _keyed(a, self.sizes_a, "ia")
        ids_b, _, ends_b = _keyed(b, self.sizes_b, "ib")
        both = ends_a.join(ends_b, "key", join_type="inner", use_threads=False).sort_by("ia")
        last_a, last_b = (both.column(c).to_numpy() for c in ("ia", "ib"))
        first_a, first_b = (np.concatenate([[0], x[:-1] + 1]) if len(x) else x for x in (last_a, last_b))
        n_a, n_b = last_a - first_a + 1, last_b - first_b + 1
        doc, links = doc_a[last_a], n_a * n_b
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        linked = np.concatenate([[0], np.cumsum(links)])[bounds]
        out = {"n_a": np.diff(_spans(a)), "n_b": np.diff(_spans(b)), "n_groups": np.diff(bounds), "n_links": np.diff(linked),
               "digests": self._digests(ids_a, ids_b, first_b, last_a, last_b, n_a, n_b, _spans(a) + _spans(b))}
        pairs = self._pairs(ids_a, ids_b, doc, first_a, first_b, n_a, n_b, links)
        found = pairs.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
        return {k: list(v) for k, v in out.items()}, found.rename_columns({"times_sum": "times"})

    def _digests(self, ids_a: np.ndarray, ids_b: np.ndarray, first_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray,
                 n_a: np.ndarray, n_b: np.ndarray, spans: np.ndarray) -> list[str]:
        """sha256 of each document's groups as text: the tokens of both sides are
        put in the order of writing, and their written forms taken at once."""
        codes_a, codes_b = ids_a.astype(np.int64), ids_b + np.int64(2 * len(self.bytes_a))
        codes_a[last_a] += len(self.bytes_a)
        codes_b[last_b] += self.base
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + np.repeat(first_b, n_a)] = codes_a
        codes[np.arange(len(ids_b)) + np.repeat(last_a + 1, n_b)] = codes_b
        taken = self.names.take(pa.array(codes))
        ends = np.frombuffer(taken.buffers()[1], "<i4", len(taken) + 1, taken.offset * 4)[spans]
        data = memoryview(taken.buffers()[2] or b"")
        return [hashlib.sha256(data[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends.tolist(), ends[1:].tolist(), strict=False)]

    def _pairs(self, ids_a: np.ndarray, ids_b: np.ndarray, doc: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
               n_a: np.ndarray, n_b: np.ndarray, links: np.ndarray) -> pa.Table:
        """(doc, pair, times) of all links, a row a link; of wide groups a row a distinct pair."""
        base = np.int64(self.base)
        one, some = links == 1, (links > 1) & (links <= WIDE)
        docs, pairs, times = [doc[one]], [ids_a[first_a[one]] * base + ids_b[first_b[one]]], [np.ones(one.sum(), np.int64)]
        group = np.repeat(np.flatnonzero(some), links[some])
        nth = np.arange(len(group)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
        i, j = np.divmod(nth, n_b[group])
        docs.append(doc[group])
        pairs.append(ids_a[first_a[group] + i] * base + ids_b[first_b[group] + j])
        times.append(np.ones(len(group), np.int64))
        for g in np.flatnonzero(links > WIDE):
            (u, m), (v, n) = (np.unique(ids[f : f + k], return_counts=True)
                              for ids, f, k in ((ids_a, first_a[g], n_a[g]), (ids_b, first_b[g], n_b[g])))
            pairs.append((u.astype(np.int64)[:, None] * base + v[None, :]).ravel())
            times.append((m[:, None] * n[None, :]).ravel())
            docs.append(np.full(len(pairs[-1]), doc[g]))
        return pa.table({"doc": np.concatenate(docs), "pair": np.concatenate(pairs), "times": np.concatenate(times)})


def _blocks(rows: DataFrame, tokenizer: str, model: bytes) -> DataFrame:
    """Blocks of documents: what alignment says of each, the block's distinct
    pairs with the number of its documents that hold them, and each document's
    pairs as places among these."""
    types = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 3, pa.binary()]
    names = [c.split()[0] for c in BLOCK.split(", ")]
    sent = rows.sparkSession.sparkContext.broadcast((tokenizer, model))  # both files, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, block = Aligner(*sent.value), TaskContext.get().partitionId() << 33

        def out(ids: list, facts: dict[str, list], tables: list[pa.Table]) -> pa.RecordBatch:
            table = pa.concat_tables(tables)
            held = table.group_by("pair", use_threads=False).aggregate([("doc", "count")])
            pairs = held.column("pair").to_numpy()
            by_pair = np.argsort(pairs)
            pairs, docs = pairs[by_pair], held.column("doc_count").to_numpy()[by_pair]
            doc, at, times = table.column("doc").to_numpy(), np.searchsorted(pairs, table.column("pair").to_numpy()), table.column("times").to_numpy()
            order = np.argsort(doc * np.int64(max(1, len(pairs))) + at)
            distinct = np.bincount(doc, minlength=len(ids))
            columns = [block, ids, *facts.values(), pairs, docs, distinct, planes(np.diff(at[order], prepend=0), times[order])]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types, strict=True)], names=names)

        def aligned(ids: list, texts: list, facts: dict[str, list], tables: list[pa.Table]) -> None:
            found, pairs = align(texts)
            done = len(ids) - len(texts)
            tables.append(pairs.set_column(0, "doc", pc.add(pairs.column("doc"), done)))
            for k, v in found.items():
                facts.setdefault(k, []).extend(v)

        ids, texts, facts, tables, chars, all_chars = [], [], {}, [], 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py())
                chars += len(texts[-1] or "") + 100
                if chars > STEP_CHARS:
                    aligned(ids, texts, facts, tables)
                    all_chars, texts, chars = all_chars + chars, [], 0
                    if all_chars > BLOCK_CHARS:
                        yield out(ids, facts, tables)
                        ids, facts, tables, all_chars, block = [], {}, [], 0, block + 1
        if texts:
            aligned(ids, texts, facts, tables)
        if ids:
            yield out(ids, facts, tables)

    return rows.mapInArrow(run, BLOCK)


def align_documents(docs: DataFrame, tokenizer: str, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a and n_b (tokens of either tokenizer), n_groups,
    n_links, n_best (links of a pair that no other of its A id is in more
    documents than), count_sum (over the links, how many documents hold their
    pair), groups_sha256.

    ``tokenizer`` is the JSON of a byte-level BPE, which gets a space before the
    text; ``model`` a SentencePiece model.  Null and empty texts, and those that
    either tokenizer's tokens don't spell out again, have no tokens: zeros and an
    empty digest.  Rows that repeat count as often as documents, null ids stay,
    an empty table gives an empty one.
    """
    short_batches(docs.sparkSession)
    blocks = staged(_blocks(narrow(docs, id_col, text_col), tokenizer, model), "alignment-blocks")
    thin = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p")).select(
        F.col("block").alias("of_block"), "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    base = sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()
    counts = thin.groupBy("pair").agg(F.sum("docs").alias("c")).withColumn("a", F.floor(F.col("pair") / F.lit(base)))
    counts = staged(counts, "alignment-counts")
    most = counts.groupBy("a").agg(F.max("c").alias("most"))
    counts = counts.join(most, "a").select("pair", "c", (F.col("c") == F.col("most")).alias("best"))
    known = thin.join(counts, "pair").select("of_block", "at", "c", "best")

    def looked_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        of = {c: left.column(c).combine_chunks() for c in left.column_names}
        m = len(of["doc_ids"].values)
        at, times = from_planes(of["postings"][0].as_py(), 2) if len(of["pairs"].values) else (np.zeros(0, np.int64),) * 2
        at = np.cumsum(at)
        count, best = np.zeros(len(of["pairs"].values), np.int64), np.zeros(len(of["pairs"].values), np.int64)
        place = right.column("at").to_numpy()
        count[place], best[place] = right.column("c").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(of["distinct"].values.to_numpy())])
        n_best, total = (np.concatenate([[0], np.cumsum(times * v[at])])[bounds] for v in (best, count))
        return pa.table([*(of[k].values for k in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")), pa.array(np.diff(n_best)[:m]),
                         pa.array(np.diff(total)[:m]), of["digests"].values], names=[c.split()[0] for c in RESULT.split(", ")])

    return blocks.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(looked_up, RESULT)
