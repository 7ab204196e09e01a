"""Exact deduplication: counting quotient filters, then byte verification.

Every map task counts its fingerprints in a counting quotient filter: the high
bits of a fingerprint (the quotient) are a place, the low bits (the remainder)
are stored there, in order, with a count.  No bit is lost, so filters merge by
walking their sorted remainders; fingerprints met once in all filters are unique
texts, the few others are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.util import narrow, next_pow2, staged

BITS = 64
#: A map task's filter is written out and begun anew at so many fingerprints.
FILTER_ROWS = 4_000_000
#: Fingerprints merged at a time: what one slice of the quotients holds of all filters.
SLICE_ROWS = 32_768


def filter_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, and how often each occurs."""
    return np.unique(prints, return_counts=True)


def to_bytes(prints: np.ndarray, counts: np.ndarray) -> bytes:
    """A quotient filter of sorted distinct fingerprints: quotient bits, which
    quotients occur, where each one's run of remainders ends, the remainders,
    and the counts of those that occur more than once."""
    n = len(prints)
    q = max(1, min(32, n.bit_length()))
    low, high = (int(prints[0]), int(prints[-1])) if n else (0, 0)
    shared = BITS - (low ^ high).bit_length()  # leading bits that all have are kept once
    q = min(q, BITS - shared) if shared < BITS else 0
    r = BITS - shared - q
    rest = prints & np.uint64((1 << (BITS - shared)) - 1) if shared else prints
    quotient = (rest >> np.uint64(r)).astype(np.int64) if r < BITS else np.zeros(n, np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)[:n]
    width = -(-r // 8)
    remainder = (rest & np.uint64((1 << r) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    many = counts > 1
    head = np.array([n, q, shared, low], "<u8").tobytes()
    return b"".join((head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), remainder.tobytes(),
                     np.packbits(many).tobytes(), counts[many].astype("<u8").tobytes()))


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, q, shared, low = (int(x) for x in np.frombuffer(data, "<u8", 4))
    r, at = BITS - shared - q, 32

    def take(size: int, kind: type | str = np.uint8) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, size, at)
        at += out.nbytes
        return out

    occupied = np.unpackbits(take(-(-(1 << q) // 8)))[: 1 << q]
    ends = np.unpackbits(take(-(-n // 8)))[:n]
    width = -(-r // 8)
    padded = np.zeros((n, 8), np.uint8)
    padded[:, :width] = take(n * width).reshape(n, width)
    many = np.unpackbits(take(-(-n // 8)))[:n].astype(bool)
    run = np.cumsum(ends) - ends  # which run each remainder stands in
    quotient = np.flatnonzero(occupied).astype(np.uint64)[run]
    prints = padded.view("<u8").ravel().astype(np.uint64)
    if r < BITS:
        prints |= quotient << np.uint64(r)
    if shared:
        prints |= np.uint64(low >> (BITS - shared) << (BITS - shared)) if shared < BITS else np.uint64(low)
    counts = np.ones(n, np.int64)
    counts[many] = take(int(many.sum()), "<u8").astype(np.int64)
    return prints, counts


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One filter's content from several: counts of equal fingerprints add up."""
    parts = [from_bytes(f) for f in filters]
    prints = np.concatenate([p for p, _ in parts])
    order = np.argsort(prints, kind="stable")  # runs that are sorted already
    prints, counts = prints[order], np.concatenate([c for _, c in parts])[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


def repeated(prints: DataFrame, rows: int) -> DataFrame:
    """(fp, copies) of the fingerprints in column ``fp`` that occur more than once.

    ``rows`` sizes the slices, not the result.  A fingerprint is one entry of a
    filter however often it occurs, so none is hot.
    """
    slices = next_pow2(-(-max(rows, 1) // SLICE_ROWS))
    shift = BITS - slices.bit_length() + 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[np.ndarray]) -> pa.RecordBatch:
            found, counts = filter_of(np.concatenate(parts))
            of = (found >> np.uint64(shift)).astype(np.int64) if slices > 1 else np.zeros(len(found), np.int64)
            at = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            to = np.append(at[1:], len(of))
            return pa.RecordBatch.from_arrays(
                [pa.array(of[at]), pa.array([to_bytes(found[i:j], counts[i:j]) for i, j in zip(at, to, strict=True)], pa.binary())],
                names=["slice", "filter"])

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                n += batch.num_rows
            if n >= FILTER_ROWS:
                yield out(held)
                held, n = [], 0
        if n:
            yield out(held)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(filters: list[bytes]) -> pa.RecordBatch:
            found, counts = merge(filters)
            many = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(found[many].view(np.int64)), pa.array(counts[many])], names=["fp", "copies"])

        held: list[bytes] = []
        now = None
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != now and held:
                    yield out(held)
                    held = []
                now = k
                held.append(data)
        if held:
            yield out(held)

    built = prints.select("fp").mapInArrow(build, "slice long, filter binary")
    return built.repartition("slice").sortWithinPartitions("slice").mapInArrow(walk, "fp long, copies long")


def normalised(text: Column) -> Column:
    """Null as empty; without the characters 0x20 and 0x09 to 0x0D."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _order() -> Column:
    """Least for the row that stays: most characters, then the smallest doc_id, null last."""
    return F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"))


def _verified(suspects: DataFrame) -> DataFrame:
    """Groups of equal texts among the suspects, by the texts themselves: equal
    rows of a map task are one row before the shuffle, so copies are not hot."""
    groups = suspects.groupBy("norm").agg(F.count(F.lit(1)).alias("group_size"),
                                          F.min(_order()).alias("first"))
    return groups.select(F.sha2("norm", 256).alias("sha"), "group_size", (-F.col("first.chars")).alias("keep_chars"),
                         F.col("first.doc_id").alias("keep_id"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are without ASCII white space; a null text is an
    empty one, and all those are one group.  Of a group the row with most
    characters stays, then the smallest doc_id (a null id after all others).
    Rows that repeat in id and text count each in ``group_size``; one of them,
    whichever, has ``kept``.  An empty table gives an empty one.
    """
    rows = narrow(docs, id_col, text_col).withColumn("norm", normalised(F.col("text")))
    rows = rows.select("doc_id", "norm", F.xxhash64("norm").alias("fp"),
                       F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    slim = staged(rows.select("doc_id", "fp", "chars", F.sha2("norm", 256).alias("sha"),
                              F.monotonically_increasing_id().alias("row")), "prints")
    many = staged(repeated(slim, slim.count()), "repeated")
    groups = staged(_verified(rows.join(many.select("fp"), "fp", "left_semi")), "groups")
    joined = slim.join(groups, "sha", "left")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    keepers = joined.where(stays).groupBy("sha").agg(F.min("row").alias("keep_row")).withColumnRenamed("sha", "keep_sha")
    out = joined.join(keepers, F.col("sha") == F.col("keep_sha"), "left")
    single = F.col("group_size").isNull()
    return out.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      (single | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each group of equal texts, the one
    ``exact_dedup`` keeps.  Rows of unique fingerprints pass as they are; only the
    others are grouped, and rows of a group are merged before the shuffle."""
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        normalised(docs[text_col].cast("string")).alias("norm"),
                        docs[id_col].cast("long").alias("doc_id"),
                        F.coalesce(F.length(docs[text_col].cast("string")), F.lit(0)).alias("chars"))
    inner = inner.withColumn("fp", F.xxhash64("norm"))
    prints = staged(inner.select("fp"), "prints")
    many = staged(repeated(prints, prints.count()), "repeated").select("fp")
    unique = inner.join(many, "fp", "left_anti").select("row.*")
    groups = inner.join(many, "fp", "left_semi").groupBy("norm").agg(
        F.min_by("row", _order()).alias("row"))
    return unique.unionByName(groups.select("row.*"))
