"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A document's words, parted by one space and closed by an end mark, are predicted
bit by bit.  Each predictor hashes a context (the last three bytes, the last
four, the word so far) to a slot and, there, knows how often each half byte
followed in the training documents; these counts add up over tasks without loss.
A slot's counts give the logit of each of its bits.  Per document the logits are
combined by weights gated by the kind of the last byte and the bit's place; the
weights, and an offset that refines what they give, start the same everywhere
and follow the gradient of the coding cost after every stretch of the document,
so a stretch is scored by what was learned before it.

Beside the model's score goes a plain one from word counts.  Documents are read
in blocks; the distinct words of a block meet the corpus counts in a join on the
word, and only the counts go back to the block.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.util import from_planes, narrow, planes, portions, short_batches, staged

END = b"\n"
#: End marks before every document, so that no context reaches into the one before.
LEAD = 4
#: log2 of the slots of each predictor's table; a slot has 16 cells.
SLOTS = (18, 20, 20)
#: Cells of a slice, the unit in which tables are merged.
SLICE = 1 << 16
#: Partial slices of a first merge.
FAN_IN = 64
#: Steps of a logit in a table byte.
STEP = 12
#: Added to both counts of a bit.
PRIOR = 0.05
#: Weights of every document at its start; rates of the weights and of the offset.
WEIGHT, RATE, OFFSET_RATE = 0.4, 0.01, 0.02
#: Bytes of a document's first two stretches; the next ones double up to LONGEST.
STRETCH, LONGEST = 64, 4096
#: Documents, and bytes, scored together; bytes whose cells are found at a time.
TOGETHER, TOGETHER_BYTES, WINDOW = 128, 1 << 18, 1 << 15
#: Bytes of a run of equal weights, on average, from which runs are filled one by one.
LONG = 1024
#: Bytes of a stretch taken at a time, at least LONGEST.
PART = 1 << 14
#: Characters of a block.
BLOCK_CHARS = 8_000_000
#: Added to word counts of the plain score.
ADDED = 0.1
GATES = 3

_U = np.uint32
_GATE = np.full(256, 1, np.int32)  # after a letter or a byte of one
_GATE[:128] = 2
_GATE[ord("a") : ord("z") + 1] = 1
_GATE[[10, 32]] = 0
#: Shifts of a byte's bits, the highest first, to the place of a float's sign.
_BIT, _TOP = np.arange(24, 32, dtype=_U)[:, None], _U(1 << 31)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(256, 0x85EBCA6B, _U), dtype=_U)

BLOCK = ("block long, doc_ids array<long>, held array<boolean>, n_tokens array<long>, n_bytes array<long>, scores array<double>, "
         "words array<binary>, trained array<long>, distinct array<long>, postings binary")
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
          "n_bytes long, bits_per_byte double")


def tokens(text: str | None) -> list[bytes]:
    """Words, A-Z in lower case; the end is not among them."""
    return (text or "").encode().lower().split()


def sequence(words: list[bytes]) -> bytes:
    """What the model predicts: the words parted by one space, and the end."""
    return b" ".join(words) + END


def split(texts: pa.Array) -> pa.Array:
    """``tokens`` of many texts; one without words has one empty word, or none."""
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null(""))))


def sequences(words: pa.Array) -> list[bytes]:
    """``sequence`` of many texts' words."""
    return [s + END for s in pc.binary_join(words, " ").cast(pa.binary()).to_pylist()]


def _joined(sequences: Iterable[bytes]) -> np.ndarray:
    lead = END * LEAD
    return np.frombuffer(b"".join(x for s in sequences for x in (lead, s)), np.uint8)


def cells(buf: np.ndarray, word: tuple[int, int] = (0, 0)) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[int, int]]:
    """Per predictor the cells of the high and of the low half of every byte but
    the first LEAD: 16 times the slot of the context (for the low half, with the
    high one) plus the half byte.  ``word``: hash and length so far of the word
    that the first of these bytes is in; those after the last one come back too."""
    b = buf.astype(_U)
    three = b[2:-2] << _U(8)
    three |= b[3:-1]
    three |= b[1:-3] << _U(16)
    four = b[:-4] << _U(24)
    four |= three
    buf, b = buf[LEAD:], b[LEAD:]
    n = len(b)
    # the word that a byte continues begins after the last break; before the first, in an earlier window
    breaks = np.flatnonzero((buf == 32) | (buf == 10))
    begin = np.concatenate([np.array([-word[1]]), breaks + 1])
    counts = np.diff(begin[1:], prepend=0, append=n + 1)
    length = np.arange(n + 1, dtype=np.int32)
    length -= np.repeat(begin.astype(np.int32), counts)
    terms = np.take(_POWERS, length[:-1] & 255, mode="clip")
    terms *= b + _U(1)
    terms[breaks] = 0
    so_far = np.zeros(n + 1, _U)
    np.cumsum(terms, dtype=_U, out=so_far[1:])
    before = np.concatenate([np.array([-word[0] & 0xFFFFFFFF], _U), so_far[breaks + 1]])
    so_far -= np.repeat(before, counts)
    hashed = length[:-1].view(_U) * _U(0xC2B2AE35)
    hashed += so_far[:-1]
    high, low = b >> _U(4), b & _U(15)
    mixed = (high + _U(1)) * _U(0xC2B2AE3D)
    out = []
    for h, bits, salt in zip((three, four, hashed), SLOTS, (1, 2, 3), strict=True):
        h += _U(salt)
        h *= _U(0x9E3779B1)
        h ^= h >> _U(15)
        h *= _U(0x85EBCA77)
        g = h + mixed
        g *= _U(0x9E3779B1)
        for x, half in ((h, high), (g, low)):
            x >>= _U(32 - bits)
            x <<= _U(4)
            x |= half
        out.append((h, g))
    return out, (int(so_far[-1]), int(length[-1]))


def windows(buf: np.ndarray) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """``cells`` of all bytes, a window at a time, with where each begins (less LEAD)."""
    word = (0, 0)
    for at in range(0, len(buf) - LEAD, WINDOW):
        found, word = cells(buf[at : at + WINDOW + LEAD], word)
        yield at, found


def _packed(at: np.ndarray, counts: np.ndarray) -> bytes:
    raw = np.diff(at, prepend=0).astype("<u2").tobytes() + counts.astype("<i8").view("<u4").reshape(-1, 2).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _add(total: np.ndarray, data: bytes) -> None:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = len(raw) // 10
    at = np.cumsum(np.frombuffer(raw, "<u2", n).astype(np.int64))
    total[at] += np.ascontiguousarray(np.frombuffer(raw, "<u4", 2 * n, 2 * n).reshape(2, n).T).view("<i8").ravel()


def _counted(texts: DataFrame) -> DataFrame:
    """(slice, task, data): cells of a task that occurred, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(16 << s, np.uint32) for s in SLOTS]
        held, chars = [], 0

        def add() -> None:
            buf = _joined(held)
            lead = np.concatenate([np.arange(LEAD + len(s)) < LEAD for s in held])[LEAD:]
            for at, found in windows(buf):
                marks = np.flatnonzero(lead[at : at + WINDOW])
                for table, halves in zip(tables, found, strict=True):
                    for half in halves:
                        np.add.at(table, half, _U(1))
                        np.subtract.at(table, half[marks], _U(1))  # no marks of the lead

        for texts in portions((b.column(0) for b in batches), 200):
            for text in sequences(split(texts)):
                held.append(text)
                chars += len(text)
                if chars > 1_000_000:
                    add()
                    held, chars = [], 0
        if held:
            add()
        task, first = TaskContext.get().partitionId(), 0
        for table in tables:
            for i in range(0, len(table), SLICE):
                part = table[i : i + SLICE]
                at = np.flatnonzero(part)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([first + i // SLICE], pa.int32()), pa.array([task], pa.int32()),
                                                      pa.array([_packed(at, part[at])], pa.binary())], names=["slice", "task", "data"])
            first += len(table) // SLICE

    return texts.mapInArrow(run, "slice int, task int, data binary")


def _merged(parts: DataFrame, keys: list[str], finish: bool) -> DataFrame:
    """Sums of the partial slices that agree in ``keys``, read one after another;
    at last as logits."""

    def out(key: tuple, total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total)
        data = zstandard.ZstdCompressor(level=3).compress(logits(total).tobytes()) if finish else _packed(at, total[at])
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[-1]], pa.int32()), pa.array([data], pa.binary())],
                                          names=["slice", "task", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(SLICE, np.int64)
        for batch in batches:
            for *key, data in zip(*(batch.column(c).to_pylist() for c in (*keys, "data")), strict=True):
                if key != now:
                    if now is not None:
                        yield out(now, total)
                        total = np.zeros(SLICE, np.int64)
                    now = key
                _add(total, data)
        if now is not None:
            yield out(now, total)

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "slice int, task int, data binary")


def logits(counts: np.ndarray) -> np.ndarray:
    """Counts of half bytes, 16 a slot, to the logits of the slot's 15 nodes, in
    steps of 1/STEP (the first of 16 is unused)."""
    level = counts.reshape(-1, 16).astype(np.float64)
    out = np.zeros(level.shape, np.int8)
    for nodes in (8, 4, 2, 1):
        both = level.reshape(len(level), -1, 2)
        out[:, nodes : 2 * nodes] = np.clip(np.rint(np.log((both[:, :, 1] + PRIOR) / (both[:, :, 0] + PRIOR)) * STEP), -127, 127)
        level = both.sum(axis=2)
    return out


@dataclass(frozen=True)
class Predictors:
    """The tables as they travel: logits per slice, compressed; of fixed size
    (``SLOTS``, 35 MB before compression), whatever the corpus."""

    slices: dict[int, bytes]

    def tables(self) -> list[np.ndarray]:
        """Per predictor and cell the four logits on the half byte's way, a byte each, in one integer."""
        out, first, unpack = [], 0, zstandard.ZstdDecompressor().decompress
        for s in SLOTS:
            table = np.zeros(16 << s, np.int32)
            for i in range((16 << s) // SLICE):
                if (data := self.slices.get(first + i)) is not None:
                    node = np.frombuffer(unpack(data), np.uint8).reshape(-1, 16).T.astype(_U, order="C")  # a row a node
                    cell = table[i * SLICE : (i + 1) * SLICE].view(_U).reshape(-1, 16)
                    for v in range(0, 16, 2):
                        way = node[1] | node[2 | v >> 3] << _U(8) | node[4 | v >> 2] << _U(16) | node[8 | v >> 1] << _U(24)
                        cell[:, v] = cell[:, v + 1] = way
            out.append(table)
            first += len(table) // SLICE
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Predictors:
    """Counts of all training documents, merged into tables."""
    texts = narrow(docs, id_col, text_col).where(~held_out(F.col("doc_id"))).select("text")
    parts = _counted(texts).withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
    merged = _merged(_merged(parts, ["slice", "task"], False), ["slice"], True)
    return Predictors({r.slice: bytes(r.data) for r in merged.collect()})


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 10 is 0; null for a null id."""
    return F.crc32(doc_id.cast("string")) % 10 == 0


def _stretches(longest: int) -> Iterator[tuple[int, int]]:
    at, size = 0, STRETCH
    while at < longest:
        yield at, size
        at += size
        if at > STRETCH and size < LONGEST:
            size *= 2


def score(sequences: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
    """log10 of the model's probability of each sequence; a sequence's result
    doesn't depend on the others."""
    out = np.zeros(len(sequences))
    mine, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        if mine and (len(mine) == TOGETHER or size + len(sequences[i]) > TOGETHER_BYTES):
            out[mine] = _score([sequences[j] for j in mine], tables)
            mine, size = [], 0
        mine.append(i)
        size += len(sequences[i])
    if mine:
        out[mine] = _score([sequences[j] for j in mine], tables)
    return out


def _score(sequences: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
    """``score`` of sequences of falling length."""
    buf = _joined(sequences)
    lengths = np.array([len(s) for s in sequences])
    starts = np.cumsum(lengths + LEAD) - lengths - LEAD
    found = np.empty((len(tables), 2, len(buf) - LEAD), np.int32)  # of the two halves the four logits each
    for at, cell in windows(buf):
        for table, out, halves in zip(tables, found, cell, strict=True):
            for plane, half in zip(out, halves, strict=True):
                np.take(table, half.astype(np.intp), mode="clip", out=plane[at : at + len(half)])
    found = found.reshape(-1, found.shape[-1])
    gates = _GATE[buf[LEAD - 1 : -1]]
    buf = buf[LEAD:].astype(_U)
    # weights, and an offset as that of an input that is 1; a row a bit, so that every step runs along the bytes
    weights = np.full((len(tables) + 1, 8, GATES * len(sequences)), WEIGHT / STEP, np.float32)
    weights[-1] = 0
    rates = np.full((len(weights), 1, 1), RATE / STEP**2, np.float32)
    rates[-1] = OFFSET_RATE
    cost = np.zeros(len(sequences))
    # room for a part, taken once
    room = np.empty(len(tables) * 8 * min(PART, int(lengths.sum())), np.float32)
    for at, size in _stretches(int(lengths[0])):
        active = int(np.searchsorted(-lengths, -at))
        spans = np.minimum(lengths[:active] - at, size)
        ends = np.cumsum(spans)
        last = 0
        while last < active:  # as many documents as make a part
            first, done = last, int(ends[last - 1]) if last else 0
            last = int(np.searchsorted(ends, done + PART, "right"))
            n, docs, sizes = int(ends[last - 1]) - done, last - first, spans[first:last]
            place = np.arange(n)
            place += np.repeat(starts[first:last] + at - (ends[first:last] - sizes - done), sizes)
            # by gate, then by document
            gate = np.take(gates, place, mode="clip")
            counts = np.bincount(gate * docs + np.repeat(np.arange(docs), sizes), minlength=GATES * docs)
            place = np.take(place, np.concatenate([np.flatnonzero(gate == g) for g in range(GATES)]), mode="clip")
            mine = np.flatnonzero(counts)
            counts = counts[mine]
            begin = np.cumsum(counts) - counts
            doc = mine % docs
            mine = mine // docs * len(sequences) + doc + first
            inputs = room[: len(tables) * 8 * n].reshape(len(tables), 8, n)
            way = np.take(found, place, axis=1, mode="clip")
            byte = np.empty_like(way)
            for k in range(4):  # signed bytes, the lowest first
                np.left_shift(way, 24 - 8 * k, out=byte)
                byte >>= 24
                inputs.reshape(-1, 4, n)[:, k] = byte
            given = weights[:, :, mine]
            if n > LONG * len(mine):
                parts = np.empty((*given.shape[:2], n), np.float32)
                for j, (a, c) in enumerate(zip(begin.tolist(), counts.tolist(), strict=True)):
                    parts[:, :, a : a + c] = given[:, :, j, None]
            else:
                parts = np.repeat(given, counts, axis=2)
            parts[:-1] *= inputs
            z = parts[0]
            for more in parts[1:]:
                z += more
            sign = np.left_shift(np.take(buf, place, mode="clip"), _BIT)  # a bit that came is 1: turns the sign
            sign &= _TOP
            turned = z.view(_U)
            turned ^= sign
            np.clip(z, -20, 20, out=z)
            inverse = np.exp(z, out=z)  # 1 / probability of the bit that came
            inverse += 1
            four = inverse[:4] * inverse[4:]
            two = four[:2] * four[2:]  # below e^81
            bits = np.add.reduceat(np.log(two[0].astype(np.float64) * two[1]), begin)
            cost[first:last] += np.bincount(doc, weights=bits, minlength=docs)
            off = np.reciprocal(inverse, out=inverse)
            np.subtract(1, off, out=off)
            sign ^= _TOP
            turned ^= sign
            shrink = (1 / np.maximum(counts / 16, 1)).astype(np.float32)
            inputs *= off
            steps = np.empty_like(given)
            np.add.reduceat(inputs, begin, axis=2, out=steps[:-1])
            np.add.reduceat(off, begin, axis=1, out=steps[-1])
            weights[:, :, mine] = given + steps * (rates * shrink)
    return -cost / math.log(10)


def _blocks(rows: DataFrame, predictors: Predictors) -> DataFrame:
    """Documents in blocks of about BLOCK_CHARS, with their scores, and their
    words as places in the block's list of distinct words."""
    model = rows.sparkSession.sparkContext.broadcast(predictors)
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                        *((k, pa.list_(pa.int64())) for k in ("n_tokens", "n_bytes")), ("scores", pa.list_(pa.float64())),
                        ("words", pa.list_(pa.binary())), ("trained", pa.list_(pa.int64())), ("distinct", pa.list_(pa.int64())),
                        ("postings", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, block = model.value.tables(), TaskContext.get().partitionId() << 33

        def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            of = {c: rows.column(c).combine_chunks() for c in rows.column_names}
            found = split(of["text"])
            doc = np.repeat(np.arange(len(found)), pc.list_value_length(found).to_numpy())
            given = sequences(found)
            scores = score(given, tables)
            flat = found.flatten()
            real = pc.greater(pc.binary_length(flat), 0)
            doc, flat = doc[real.to_numpy(zero_copy_only=False)], flat.filter(real).dictionary_encode()
            # each document's distinct words, and the end, as places in the block's list; their times
            end, m = len(flat.dictionary), len(found)
            keys = np.concatenate([doc * (end + 1) + flat.indices.to_numpy(), np.arange(m) * (end + 1) + end])
            keys.sort()
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            times = np.diff(first, append=len(keys))
            of_doc, places = np.divmod(keys[first], end + 1)
            train = of["train"].to_numpy(zero_copy_only=False)
            trained = np.bincount(places, weights=times * train[of_doc], minlength=end + 1).astype(np.int64)
            words = pa.concat_arrays([flat.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
            lists = [of["doc_id"], of["held"], np.bincount(doc, minlength=m) + 1, [len(s) for s in given], scores, words, trained,
                     np.bincount(of_doc, minlength=m)]
            lists = [x if isinstance(x, pa.Array) else pa.array(x, t.value_type) for x, t in zip(lists, schema.types[1:-1], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *(pa.ListArray.from_arrays([0, len(x)], x).cast(t) for x, t in zip(lists, schema.types[1:-1], strict=True)),
                 pa.array([planes(np.diff(places, prepend=0), times)], pa.binary())], schema=schema)

        held, chars = [], 0
        for batch in batches:
            begin = 0
            for i, size in enumerate(pc.utf8_length(batch.column("text")).fill_null(0).to_pylist(), 1):
                chars += size + 100
                if chars > BLOCK_CHARS:
                    yield out([*held, batch.slice(begin, i - begin)])
                    held, chars, begin, block = [], 0, i, block + 1
            if begin < len(batch):
                held.append(batch.slice(begin))
        if held:
            yield out(held)

    return rows.mapInArrow(run, BLOCK)


def corpus_counts(thin: DataFrame) -> DataFrame:
    """(of_block, at, trained, c, first) of (of_block, at, word, trained): c sums
    trained over the word's rows, of which the smallest block's is the first."""
    # a row a block and word: however frequent a word is, its rows are as many as the blocks
    same = Window.partitionBy("word")
    return thin.select("of_block", "at", "trained", F.sum("trained").over(same).alias("c"),
                       (F.min("of_block").over(same) == F.col("of_block")).alias("first"))


def score_documents(docs: DataFrame, predictors: Predictors, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens (with the end), n_known
    (those that occur in training), train_tokens, base_score, score, n_bytes (of
    what the model predicts) and bits_per_byte.

    base_score is the sum over the tokens of log10((c + 0.1) / (N + 0.1 * (V + 1))),
    c being the token's count, N that of all and V the number of distinct ones in
    the training documents; score the log10 probability that the mixed predictors
    give to the document's words and end.  A null text is empty: its end alone.
    A null id is neither held out nor learned from.  Rows that repeat are scored
    each by itself and learned from as often; an empty table gives an empty one.
    Without training documents every token's base is 0 and every bit's
    probability a half.
    """
    short_batches(docs.sparkSession)
    rows = narrow(docs, id_col, text_col)
    out = held_out(F.col("doc_id"))
    rows = rows.select("doc_id", F.coalesce(out, F.lit(False)).alias("held"), F.coalesce(~out, F.lit(False)).alias("train"), "text")
    blocks = staged(_blocks(rows, predictors), "mixing-blocks")
    thin = blocks.select("block", F.posexplode(F.arrays_zip("words", "trained")).alias("at", "w")).select(
        F.col("block").alias("of_block"), "at", F.col("w.words").alias("word"), F.col("w.trained").alias("trained"))
    counts = staged(corpus_counts(thin), "mixing-counts")
    n, v = (int(x or 0) for x in counts.agg(F.sum("trained"), F.count_if(F.col("first") & (F.col("c") > 0))).first())
    elsewhere = counts.where(F.col("c") != F.col("trained")).select("of_block", "at", "c")  # the others the block knows
    whole = n + ADDED * (v + 1)

    def base(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        of = {c: left.column(c).combine_chunks() for c in left.column_names}
        count = of["trained"].values.to_numpy().copy()
        count[right.column("at").to_numpy()] = right.column("c").to_numpy()
        value = np.log10((count + ADDED) / whole)
        at, times = from_planes(of["postings"][0].as_py(), 2)
        at, distinct = np.cumsum(at), of["distinct"].values.to_numpy()
        doc, m = np.repeat(np.arange(len(distinct)), distinct), len(distinct)
        total = np.bincount(doc, weights=value[at] * times, minlength=m)
        known = np.bincount(doc, weights=np.where(count[at] > 0, times, 0), minlength=m).astype(np.int64)
        scores, n_bytes = of["scores"].values, of["n_bytes"].values
        bits = scores.to_numpy(zero_copy_only=False) * -math.log2(10) / n_bytes.to_numpy(zero_copy_only=False)
        return pa.table([of["doc_ids"].values, of["held"].values, of["n_tokens"].values, pa.array(known), pa.array(np.full(m, n)),
                         pa.array(total), scores, n_bytes, pa.array(bits)], names=[c.split()[0] for c in RESULT.split(", ")])

    return blocks.drop("words").groupBy("block").cogroup(elsewhere.groupBy("of_block")).applyInArrow(base, RESULT)
