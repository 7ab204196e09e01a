"""Exact top-k inner products by length buckets.

Candidates are grouped by length, each bucket's lengths being within a tenth of
one another.  A query knows a score it can't fall below (its k-th best among the
longest candidates).  Within a bucket that score becomes a least cosine: if even
the longest vector at cosine 1 stays below it, the bucket is passed over (length
pruning); else the query's largest coordinates each bound the same coordinate of
any vector that reaches the cosine (coordinate pruning).  What is left is
verified by exact products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.util import staged

#: Lengths of a bucket are within this factor of one another.
RATIO = 1.1
#: Rows of a bucket, and queries, that meet in one step.
CHUNK, BLOCK = 4096, 512
#: Longest candidates that give the first thresholds.
SEED_ROWS = 1024
#: Coordinates of a query that prune.
FOCUS = 4
#: Below this, sums of products are exact in doubles.
EXACT = float(1 << 53)


def _integers(rows: DataFrame, scale: int) -> DataFrame:
    """id, dim, length, v (64-bit integers) of vectors without null or non-finite components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            at = lists.offsets.to_numpy()
            out = []
            for i, (k, there) in enumerate(zip(batch.column("id").to_pylist(), lists.is_valid().to_pylist(), strict=True)):
                x = values[at[i] : at[i + 1]]
                if k is None or not there or not np.isfinite(x).all():
                    continue
                v = np.floor(scale * x)
                length = math.sqrt(float(v @ v))
                if length >= 2.0**62:
                    raise OverflowError("a component is too large for integer products")
                out.append((k, len(v), length, v.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.binary()))],
                names=["id", "dim", "length", "v"])

    return rows.mapInArrow(run, "id long, dim long, length double, v binary")


def _grouped(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: keys, ids, vectors and the column ``more`` (doubles) one after another."""
    names = [*keys, "ids", "vectors", "more"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple, ids: list, vectors: list, more: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.array([k], pa.int64()) for k in key), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                 pa.array([b"".join(vectors)], pa.binary()), pa.array([np.array(more, "<f8").tobytes()], pa.binary())], names=names)

        now, held = None, ([], [], [])
        for batch in batches:
            for *key, i, v, m in zip(*(batch.column(c).to_pylist() for c in (*keys, "id", "v", "more")), strict=True):
                if key != now:
                    if now is not None:
                        yield out(now, *held)
                    now, held = key, ([], [], [])
                for part, x in zip(held, (i, v, m), strict=True):
                    part.append(x)
        if now is not None:
            yield out(now, *held)

    dealt = rows.select(*keys, "id", "v", "more").repartition(*keys).sortWithinPartitions(*keys, "id")
    return dealt.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", ids binary, vectors binary, more binary")


def products(vectors: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products; ``bound`` is at least the product of the lengths."""
    if bound < EXACT:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    found = vectors.astype(object) @ query.astype(object)
    if any(abs(x) >= 1 << 63 for x in found):
        raise OverflowError("a product is no 64-bit integer")
    return found.astype(np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k] if len(ids) else np.zeros(0, np.int64)
    return ids[order], scores[order]


def reaching(unit: np.ndarray, query: np.ndarray, cosine: float, focus: int) -> np.ndarray:
    """Rows of ``unit`` that may have this cosine with the unit vector ``query``.

    If the angle between two unit vectors is at most t, their angles to any axis
    differ by t at most."""
    keep = np.ones(len(unit), bool)
    if cosine <= -1:
        return keep
    t = math.acos(min(1.0, cosine)) + 1e-6
    for f in np.argsort(-np.abs(query))[:focus]:
        a = math.acos(max(-1.0, min(1.0, query[f])))
        low, high = math.cos(min(math.pi, a + t)) - 1e-9, math.cos(max(0.0, a - t)) + 1e-9
        keep &= (unit[:, f] >= low) & (unit[:, f] <= high)
    return keep


def _search(pairs: DataFrame, k: int, focus: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, lengths = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["more"], "<f8")
                qids, least = np.frombuffer(r["qids"], "<i8"), np.frombuffer(r["qmore"], "<f8")
                p = np.frombuffer(r["vectors"], "<i8").reshape(len(ids), r["dim"])
                q = np.frombuffer(r["qvectors"], "<i8").reshape(len(qids), r["dim"])
                unit = p / np.where(lengths > 0, lengths, 1)[:, None]
                longest, out = lengths.max(initial=0.0), []
                for qid, vector, floor_ in zip(qids, q, least, strict=True):
                    length = math.sqrt(float(vector.astype(np.float64) @ vector.astype(np.float64)))
                    reach = length * longest
                    if reach * (1 + 1e-9) < floor_:
                        continue  # length pruning
                    keep = ids != qid
                    if floor_ > 0:
                        keep &= reaching(unit, vector / length, floor_ / reach, focus)
                    at = np.flatnonzero(keep)
                    scores = products(p[at], vector, reach)
                    got = scores >= floor_
                    for i, s in zip(*best(ids[at][got], scores[got], k), strict=True):
                        out.append((int(qid), int(i), int(s)))
                columns = zip(*out, strict=True) if out else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(out), pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
                                                 names=["block", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "block long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 10,
          scale: int = 1024, ratio: float = RATIO, chunk: int = CHUNK, block: int = BLOCK, focus: int = FOCUS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of every query's k best candidates.

    Components become floor(scale * x), the score is the integer inner product,
    ties go to the smaller vec_id.  Queries are the rows where ``is_query`` holds,
    candidates all rows of another id and as many components.  Integers beyond 64
    bits have no place here: a vector as long as 2^62 (scaled), or a score that is
    no 64-bit integer, raises OverflowError and ends the job.  Rows with a null
    id, a null vector, or a null or non-finite component take no part.  Rows that
    repeat an id and a vector count once; an id with several vectors is as many
    candidates, and as a query keeps the k best of all.  An empty table, or none
    that is a query, gives an empty one.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("x"),
                          F.coalesce(is_query, F.lit(False)).alias("q"))
    whole = staged(_integers(rows, scale).distinct().withColumn(
        "bucket", F.when(F.col("length") > 0, F.floor(F.log(F.col("length")) / math.log(ratio))).otherwise(-1).cast("long")), "vectors")
    asked = rows.where("q").select("id").distinct()
    queries = staged(whole.join(asked, "id", "left_semi"), "queries")

    seeds = whole.orderBy(F.desc("length"), "id").limit(SEED_ROWS).collect()
    least = _first_thresholds(queries, [(r["id"], r["dim"], r["v"]) for r in seeds], k)
    # a query asks for the length that would reach its known score at cosine 1;
    # queries that ask for like lengths are blocked together
    asked = F.when(F.col("length") > 0, F.col("least") / F.col("length")).otherwise(F.when(F.col("least") > 0, math.inf).otherwise(-math.inf))
    band = F.when((F.col("asked") > 0) & (F.col("asked") < math.inf), F.floor(F.log("asked") / math.log(ratio))).otherwise(-(1 << 20)).cast("long")
    least = staged(least.withColumn("asked", asked).withColumn("band", band), "thresholds")
    bands = least.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    least = least.join(bands, ["dim", "band"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    asking = _grouped(least.select("dim", "band", "block", "id", "v", F.col("least").alias("more")), ["dim", "band", "block"])
    asking = asking.toDF("dim", "band", "block", "qids", "qvectors", "qmore")

    sizes = whole.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).alias("parts"))
    dealt = whole.withColumn("more", F.col("length")).join(sizes, ["dim", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")))
    # which blocks a chunk meets is settled by a row a chunk and a row a block: the
    # chunk's longest vector against the block's least asking query
    tops = dealt.groupBy("dim", "bucket", "part").agg(F.max("length").alias("longest"))
    asks = least.groupBy("dim", "band", "block").agg(F.min("asked").alias("asked"))
    meets = tops.join(asks, "dim").where(F.col("longest") * (1 + 1e-9) >= F.col("asked")).drop("longest", "asked")
    chunks = _grouped(dealt, ["dim", "bucket", "part"])
    pairs = meets.join(chunks, ["dim", "bucket", "part"]).join(asking, ["dim", "band", "block"])
    found = _search(pairs, k, focus)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _first_thresholds(queries: DataFrame, seeds: list[tuple[int, int, bytes]], k: int) -> DataFrame:
    """``queries`` with ``least``: a score that the k-th best of each can't fall below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in {s[1] for s in seeds}:
            mine = [s for s in seeds if s[1] == d]
            by_dim[d] = (np.array([s[0] for s in mine]), np.frombuffer(b"".join(s[2] for s in mine), "<i8").reshape(len(mine), d))
        for batch in batches:
            out = []
            for i, d, length, v in zip(*(batch.column(c).to_pylist() for c in ("id", "dim", "length", "v")), strict=True):
                floor_ = -math.inf
                if d in by_dim:
                    ids, p = by_dim[d]
                    bound = length * math.sqrt(float(np.square(p.astype(np.float64)).sum(axis=1).max(initial=0)))
                    scores = products(p[ids != i], np.frombuffer(v, "<i8"), bound)
                    if len(scores) >= k:
                        floor_ = float(np.partition(scores, len(scores) - k)[len(scores) - k])
                        floor_ = math.nextafter(floor_, -math.inf) if abs(floor_) >= EXACT else floor_
                out.append(floor_)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "dim", "length", "v")), pa.array(out, pa.float64())],
                                             names=["id", "dim", "length", "v", "least"])

    return queries.select("id", "dim", "length", "v").mapInArrow(run, "id long, dim long, length double, v binary, least double")
