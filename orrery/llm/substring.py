"""Substring dedup: words of passages that an earlier document has too.

A window is a run of words.  First pass: every map task counts its windows in a
count-min sketch and sends the touched cells; merged, a cell holds at least the
number of documents' windows that fall on it, so a window with a cell below two
is met once.  Second pass: only windows whose cells all reach two are sent, under
a 96-bit hash, and grouped exactly, a slice of the hashes at a time; whatever the
sketch lets through wrongly falls out there, and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.minhash import WordHashes, mix
from orrery.llm.util import narrow, next_pow2, row_key

#: Cells of a row of the sketch (a power of two) and rows.  What the second pass
#: gets to see is one bit a cell: 2 x 64 MB, however large the input.  Beyond some
#: hundred million windows more and more pass the filter, which costs shuffle and
#: loses nothing; a cluster with larger executors can raise the width.
WIDTH_BITS, DEPTH = 29, 2
#: Cells merged at a time.
SLICE_BITS = 22
#: Windows a map task holds before it sends what it has.
HELD = 2_000_000
#: Slices of the hashes that the second pass groups by: at least so many, and one
#: for so many windows that the first pass saw.
LEAST_SLICES, SLICE_WINDOWS = 32, 4_000_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _powers(x: int, n: int) -> np.ndarray:
    """x^0 to x^(n-1) modulo 2^64."""
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def windows(words: list[bytes], size: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every run of ``size`` words, in order."""
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    w = hashes.of(words)
    out = []
    for multiplier, value in zip(_MULTIPLIERS, (w, mix(w)), strict=True):
        # sum of value[i] * m^i over a run, times m^-start: the same wherever the run stands
        total = np.append(np.uint64(0), np.cumsum(value * _powers(multiplier, len(w)), dtype=np.uint64))
        out.append(mix((total[size:] - total[:-size]) * _powers(pow(multiplier, -1, 1 << 64), len(w) - size + 1)))
    return out[0], out[1]


def cells(h: np.ndarray, width_bits: int, depth: int) -> Iterator[np.ndarray]:
    for row in range(depth):
        yield mix(h + np.uint64(row + 1)) >> np.uint64(64 - width_bits)


def pack(x: np.ndarray) -> bytes:
    """An array's bytes, all lowest bytes first, then the next, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def repeated_cells(rows: DataFrame, size: int, width_bits: int, depth: int) -> DataFrame:
    """(slice, bits): of each slice of cells a bit map of those counted twice or more."""
    slice_bits = min(SLICE_BITS, width_bits)
    per_row = 1 << (width_bits - slice_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def out(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for row, cell in enumerate(cells(np.concatenate(parts), width_bits, depth)):
                cell = np.sort(cell)
                if len(cell) > 2:  # above two, further counts of a task say nothing
                    cell = cell[np.append([True, True], cell[2:] != cell[:-2])]
                at = np.searchsorted(cell, np.arange(per_row + 1, dtype=np.uint64) << np.uint64(slice_bits))
                found = [i for i in range(per_row) if at[i] < at[i + 1]]
                mine = [(cell[at[i] : at[i + 1]] & np.uint64((1 << slice_bits) - 1)).astype(np.int64) for i in found]
                data = [pack(np.diff(x, prepend=0).astype("<u4")) for x in mine]
                yield pa.RecordBatch.from_arrays([pa.array([row * per_row + i for i in found], pa.int64()), pa.array(data, pa.binary())],
                                                 names=["slice", "cells"])

        held, n = [], 0
        for batch in batches:
            for text in batch.column(0):
                h = np.unique(windows((text.as_py() or "").encode().split(), size, hashes)[0])
                if len(h):
                    held.append(h)
                    n += len(h)
                if n >= HELD:
                    yield from out(held)
                    held, n = [], 0
        if n:
            yield from out(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(k: int, parts: list[np.ndarray], seen: np.ndarray, total: int) -> pa.RecordBatch:
            add(parts, seen)
            data = np.packbits(seen > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([k]), pa.array([data], pa.binary()), pa.array([total])], names=["slice", "bits", "cells"])

        def add(parts: list[np.ndarray], seen: np.ndarray) -> None:
            if parts:
                offsets, n = np.unique(np.concatenate(parts), return_counts=True)
                seen[offsets] = np.minimum(seen[offsets] + np.minimum(n, 2), 2)

        now, parts, n, total, seen = None, [], 0, 0, np.zeros(0, np.uint8)
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != now:
                    if now is not None:
                        yield out(now, parts, seen, total)
                    now, parts, n, total, seen = k, [], 0, 0, np.zeros(1 << slice_bits, np.uint8)
                parts.append(np.cumsum(unpack(data, "<u4"), dtype=np.int64))
                n += len(parts[-1])
                total += len(parts[-1])
                if n > 1 << 20:
                    add(parts, seen)
                    parts, n = [], 0
        if now is not None:
            yield out(now, parts, seen, total)

    sent = rows.select("text").mapInArrow(count, "slice long, cells binary")
    return sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, "slice long, bits binary, cells long")


def sketch(spark: SparkSession, rows: DataFrame, size: int, width_bits: int, depth: int) -> tuple[Broadcast, int]:
    """The bit maps of all rows of cells, compressed (at most of the size the two
    parameters set); and about how many windows the tasks saw."""
    slice_bits = min(SLICE_BITS, width_bits)
    per_row, step = 1 << (width_bits - slice_bits), (1 << slice_bits) // 8 or 1
    bits, seen = np.zeros(depth * per_row * step, np.uint8), 0
    for r in repeated_cells(rows, size, width_bits, depth).toLocalIterator():
        bits[r["slice"] * step : (r["slice"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
        seen += r["cells"]
    return spark.sparkContext.broadcast(zstandard.ZstdCompressor(level=1).compress(bits)), seen // depth


def earlier(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash (96 bits), then id; and in that order, which windows also
    start under a smaller id."""
    order = np.lexsort((ids, h2, h1))
    h1, h2, ids = h1[order], h2[order], ids[order]
    first = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))[: len(h1)]
    return order, ids > ids[np.flatnonzero(first)[np.cumsum(first) - 1]]


BLOCK = ("slice long, ids binary, keys binary, h1 binary, h2 binary, doc binary, start binary, "
         "known_doc binary, known_start binary, known_length binary")
KINDS = ("<i8", "<i8", "<u8", "<u4", "<u4", "<u4", "<u4", "<u4", "<u4")
GONE = "doc_id long, key long, starts binary, runs binary"


def _suspects(shared: Broadcast, size: int, width_bits: int, depth: int, slices: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of a partition's windows that may be repeated, one per slice of
    the hashes.  Of equal windows in several documents of a task only those of
    the smallest doc_id are sent to be compared; the others are known to be
    removed and go along as runs, so a window's rows never outnumber the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(shared.value), np.uint8)
        shift = np.uint64(64 - slices.bit_length() + 1)

        def often(h: np.ndarray) -> np.ndarray:
            ok = np.ones(len(h), bool)
            for row, cell in enumerate(cells(h, width_bits, depth)):
                at = (cell + np.uint64(row << width_bits)).astype(np.int64)
                ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            return ok

        def out(ids: list[int], keys: list[int], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            ids, keys = np.array(ids, "<i8"), np.array(keys, "<i8")
            h1, h2, doc, start = (np.concatenate(x) for x in zip(*parts, strict=True))
            h2 = h2.astype(np.uint32)
            order, known = earlier(h1, h2, ids[doc])
            d, s = doc[order[known]], start[order[known]]
            order = order[~known]
            h1, h2, doc, start = (x[order] for x in (h1, h2, doc, start))
            of = (h1 >> shift).astype(np.int64) if slices > 1 else np.zeros(len(h1), np.int64)
            to = np.lexsort((s, d))
            d, s = d[to], s[to]
            begin = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1))) if len(d) else np.zeros(0, np.int64)
            length = np.diff(np.append(begin, len(d)))
            d, s = d[begin], s[begin]
            for k in range(slices):
                mine = slice(*np.searchsorted(of, [k, k + 1]))
                runs = d % slices == k  # a document's runs go with one slice, whichever
                used, at = np.unique(np.concatenate([doc[mine], d[runs]]), return_inverse=True)
                if len(used):
                    n = mine.stop - mine.start
                    columns = (ids[used], keys[used], h1[mine], h2[mine], at[:n], start[mine], at[n:], s[runs], length[runs])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int64()), *(pa.array([pack(c.astype(t))], pa.binary()) for c, t in zip(columns, KINDS, strict=True))],
                        names=[c.split()[0] for c in BLOCK.split(", ")])

        ids, keys, held, n = [], [], [], 0
        for batch in batches:
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("text"), strict=True):
                h1, h2 = windows(text.as_py().encode().split(), size, hashes)
                at = np.flatnonzero(often(h1)) if len(h1) else h1
                if len(at):
                    held.append((h1[at], h2[at], np.full(len(at), len(ids)), at))
                    ids.append(doc), keys.append(key)
                    n += len(at)
                if n >= HELD // 2:
                    yield from out(ids, keys, held)
                    ids, keys, held, n = [], [], [], 0
        if n:
            yield from out(ids, keys, held)

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (GONE) of each slice's blocks, which come one after another: the
    windows that another task saw under a smaller doc_id, and the known runs."""
    names = [c.split()[0] for c in BLOCK.split(", ")][1:]

    def out(blocks: list[list[np.ndarray]]) -> pa.RecordBatch:
        offsets = np.cumsum([0] + [len(b[0]) for b in blocks])
        ids, keys, h1, h2, doc, start, known_doc, known_start, known_length = (np.concatenate(x) for x in zip(*[
            (*b[:4], b[4] + o, b[5], b[6] + o, *b[7:]) for b, o in zip(blocks, offsets, strict=False)], strict=True))
        order, gone = earlier(h1, h2, ids[doc])
        doc, start = doc[order[gone]], start[order[gone]]

        def by_doc(at: np.ndarray, values: np.ndarray) -> dict[tuple[int, int], bytes]:
            order = np.argsort(at, kind="stable")
            at, values = at[order], values[order]
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
            found: dict[tuple[int, int], bytes] = {}
            for i, j in zip(begin, np.append(begin[1:], len(at))[: len(begin)], strict=True):
                name = (int(ids[at[i]]), int(keys[at[i]]))
                found[name] = found.get(name, b"") + values[i:j].astype("<u4").tobytes()
            return found

        starts = by_doc(doc, start[:, None])
        runs = by_doc(known_doc, np.stack([known_start, known_length], axis=1))
        rows = [(*name, starts.get(name, b""), runs.get(name, b"")) for name in {**starts, **runs}]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
            names=[c.split()[0] for c in GONE.split(", ")])

    now, blocks = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            k = batch.column(0)[i].as_py()
            if k != now and blocks:
                yield out(blocks)
                blocks = []
            now = k
            blocks.append([unpack(batch.column(c)[i].as_py(), t) for c, t in zip(names, KINDS, strict=True)])
    if blocks:
        yield out(blocks)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 50,
                    width_bits: int = WIDTH_BITS, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (the words that
    stay, joined by a space).

    Words are what ASCII white space parts.  A word is removed if a window of
    ``size`` words that covers it also starts in a document of smaller doc_id.
    Null and empty texts have no words.  A row with a null id keeps its words and
    takes none from others.  Rows that repeat an id take nothing from each other;
    rows that agree in id and text get the same result each.  An empty table
    gives an empty one.
    """
    rows = narrow(docs, id_col, text_col)
    some = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    shared, seen = sketch(docs.sparkSession, some, size, width_bits, depth)
    slices = max(LEAST_SLICES, next_pow2(-(-seen // SLICE_WINDOWS)))
    sent = some.select("doc_id", row_key().alias("key"), "text").mapInArrow(_suspects(shared, size, width_bits, depth, slices), BLOCK)
    gone = sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(_compare, GONE)
    per_row = gone.groupBy("doc_id", "key").agg(F.collect_list("starts").alias("starts"), F.collect_list("runs").alias("runs"))
    both = rows.withColumn("key", row_key()).join(per_row, ["doc_id", "key"], "left").select("doc_id", "text", "starts", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, kept = [], [], []
            for text, starts, runs in zip(*(batch.column(c) for c in ("text", "starts", "runs")), strict=True):
                words = (text.as_py() or "").encode().split()
                stays = words
                if starts.is_valid:
                    cover = np.zeros(len(words) + 1, np.int64)
                    single = np.frombuffer(b"".join(starts.as_py()), "<u4").astype(np.int64)
                    many = np.frombuffer(b"".join(runs.as_py()), "<u4").astype(np.int64).reshape(-1, 2)
                    np.add.at(cover, np.append(single, many[:, 0]), 1)
                    np.add.at(cover, np.append(single + size, many.sum(axis=1) + size - 1), -1)
                    stays = [w for w, c in zip(words, np.cumsum(cover[:-1]).tolist(), strict=True) if not c]
                n.append(len(words)), removed.append(len(words) - len(stays))
                kept.append(b" ".join(stays).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return both.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")
