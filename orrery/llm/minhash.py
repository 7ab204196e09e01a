"""Near-duplicate documents: one-permutation MinHash, bands, stars, full sets.

A document's shingles are hashed once; the hash range is cut into bins and each
bin keeps its smallest hash.  Empty bins are filled by optimal densification:
each copies the first non-empty bin in an order of its own.  Groups of bins are
bands; documents that agree on a band share a bucket.

Documents of equal sets are one node from the start, so copies cost nothing
further.  A bucket of n nodes gives n - 1 candidate edges, a star around one of
them.  Edges are confirmed on the full sets; nodes a star has joined need no
further edge.  Only pairs of a bucket that still lie in different components, and
that the shingles they have to themselves leave in reach of one another, are
then compared, so the result is that of comparing all pairs of all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.graph import components
from orrery.llm.util import narrow, staged

BANDS, ROWS = 32, 5
REMEMBER = 200_000
_MASK = (1 << 64) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBER and len(word) < 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words, of all as one."""
    if not words:
        return np.zeros(0, np.uint64)
    w = hashes.of(words)
    size = min(size, len(w))
    run = np.zeros(len(w) - size + 1, np.uint64)
    for i in range(size):
        run = run * np.uint64(_MULTIPLIER) + w[i : len(w) - size + 1 + i]
    return np.unique(mix(run + np.uint64(size)))


class Signer:
    """Band keys of a shingle set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(seed)
        # turn[i, j]: when bin i, being empty, tries bin j
        self.turn = np.argsort(rng.random((self.bins, self.bins)), axis=1).astype(np.int32)
        self.edges = np.array([(i << 64) // self.bins for i in range(self.bins)], np.uint64)
        self.deal = rng.permutation(self.bins)
        self.salt = rng.integers(0, _MASK, bands, np.uint64)

    def keys(self, found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(found, self.edges)
        to = np.append(at[1:], len(found))
        full = at < to
        least = found[np.minimum(at, len(found) - 1)]
        if not full.all():
            there = np.flatnonzero(full)
            empty = np.flatnonzero(~full)
            least = least.copy()
            least[empty] = least[there[np.argmin(self.turn[np.ix_(empty, there)], axis=1)]]
        cells = least[self.deal].reshape(self.bands, self.rows)
        key = self.salt.copy()
        for i in range(self.rows):
            key = mix(key * np.uint64(_MULTIPLIER) + cells[:, i])
        return key


def _marked(rows: DataFrame, size: int, bands: int, band_rows: int) -> DataFrame:
    """doc_id, key (as given), n_shingles, set_key (of the whole set; null if empty), band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(), Signer(bands, band_rows)
        for batch in batches:
            n, keys, signatures = [], [], []
            for text in batch.column("text"):
                found = shingles((text.as_py() or "").encode().lower().split(), size, hashes)
                n.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signer.keys(found).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n_shingles", "set_key", "bands"])

    return rows.withColumn("key", F.col("key").cast("long")).mapInArrow(run, "doc_id long, key long, n_shingles long, set_key binary, bands array<long>")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """node and its full set, of rows (node, set_key, text) whose text has that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            nodes, sets = [], []
            for node, key, text in zip(*(batch.column(c) for c in ("node", "set_key", "text")), strict=True):
                found = shingles(text.as_py().encode().lower().split(), size, hashes)
                if xxhash.xxh3_128_digest(found.tobytes()) == key.as_py():
                    nodes.append(node.as_py())
                    sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "members"])

    return rows.select("node", "set_key", "text").mapInArrow(run, "node long, members array<long>")


def _checked(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (hub, node) with the count of common shingles, whether that links
    them, and bits (64 a long) that say which of the hub's shingles the node has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, linked, bits = [], [], []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.sort(v.values.to_numpy()) for v in (x, y))
                has = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                n = int(has.sum())
                common.append(n), linked.append(100 * n >= percent * (len(x) + len(y) - n))
                packed = np.packbits(has)
                bits.append(np.pad(packed, (0, -len(packed) % 8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("node"), pa.array(common, pa.int64()), pa.array(linked, pa.bool_()),
                                              pa.array(bits, pa.list_(pa.int64()))], names=["hub", "node", "common", "linked", "bits"])

    both = stars.join(sets.select(F.col("node").alias("hub"), F.col("members").alias("x")), "hub").join(
        sets.select("node", F.col("members").alias("y")), "node")
    return both.select("hub", "node", "x", "y").mapInArrow(run, "hub long, node long, common long, linked boolean, bits array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, by exact counts."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    every = F.size("x") + F.size("y") - common
    return both.where(F.lit(100) * common >= F.lit(percent) * every).select("a", "b")


def _shared(sets: DataFrame) -> DataFrame:
    """(node, shared): how many shingles of each set any other of the sets has too.

    No two sets can have more in common than the smaller of these numbers.  A
    changed copy that is too far from its original has its changes to itself,
    and so is out of reach of all other copies as well.
    """
    each = sets.select("node", F.explode("members").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("held")).where("held = 1")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return sets.select("node", F.size("members").cast("long").alias("all")).join(own, "node", "left").select(
        "node", (F.col("all") - F.coalesce("own", F.lit(0))).alias("shared"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, percent: int = 80,
               bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a document's set
    holds its distinct runs of ``shingle`` words, with fewer words all of them as
    one.  Documents whose sets share at least ``percent`` of their union are
    linked; component_id is the smallest doc_id reachable.  Two documents of
    similarity s miss all buckets with a chance of (1 - s^rows)^bands, 3 in a
    million at 0.8 and 7 in a billion at 0.85 as preset.

    Null, empty and blank texts have no set and are linked with nothing.  A row
    with a null id is linked with nothing: component_id null, kept true.  Rows
    that repeat an id with the same set are one node, with another set two nodes.
    An empty table gives an empty one.
    """
    found = _grouped(narrow(docs, id_col, text_col, key=F.lit(0)), shingle, percent, bands, band_rows)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, percent: int = 80,
              bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_dedup`` keeps: of every
    component those of its smallest doc_id."""
    key = F.xxhash64(docs[text_col].cast("string"), docs[id_col].cast("long"))
    found = _grouped(narrow(docs, id_col, text_col, key=key), shingle, percent, bands, band_rows)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("id"), "key").distinct()
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("id"), key.alias("key"))
    return held.join(gone, ["id", "key"], "left_anti").select("row.*")


def _grouped(rows: DataFrame, shingle: int, percent: int, bands: int, band_rows: int) -> DataFrame:
    """doc_id, key (as given), n_shingles, component_id, kept of rows (doc_id, text, key)."""
    marks = staged(_marked(rows, shingle, bands, band_rows), "marks")
    known = marks.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    nodes = known.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                         F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    spread = nodes.select(F.explode("bands").alias("bucket"), "node", "n")
    hubs = spread.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top")
    members = staged(spread.join(hubs.select("bucket", "hub"), "bucket"), "members")

    wanted = members.select("node").distinct().join(nodes.select("node", "set_key", "first_id"), "node")
    texts = rows.join(wanted, F.col("doc_id") == F.col("first_id"))
    sets = staged(_sets(texts, shingle).dropDuplicates(["node"]), "sets")

    def possible(n: str, m: str) -> F.Column:
        """Sets of too different sizes can't be similar enough."""
        return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)

    sizes = nodes.select(F.col("node").alias("hub"), F.col("n").alias("m"))
    stars = members.where("hub < node").select("hub", "node", "n").distinct().join(sizes, "hub").where(possible("n", "m"))
    checked = staged(_checked(stars.select("hub", "node"), sets, percent), "checked")
    links = checked.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b"))

    # pairs of a bucket that the stars left in different components
    roots = staged(components(links), "roots")
    placed = staged(members.join(roots, "node", "left").select("bucket", "node", "n", "hub", F.coalesce("root", "node").alias("root")), "placed")
    counts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = counts.groupBy("bucket").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    split = staged(placed.join(largest.where("roots > 1"), "bucket"), "split")
    shared = _shared(sets.join(split.select("node").distinct(), "node", "left_semi"))
    buckets = split.groupBy("node").agg(F.collect_set("bucket").alias("all"))
    split = split.join(shared, "node").join(buckets, "node").join(checked.drop("linked"), ["hub", "node"], "left")
    outside = split.where("root != main").select(
        "bucket", *[F.col(c).alias(f"{c}_2") for c in ("node", "n", "root", "shared", "all", "common", "bits")])
    # So many shingles two sets have in common at most: what both share with
    # others, or exactly what both have of their hub and the rest at most.
    most = F.least("shared", "shared_2")
    of_hub = F.aggregate(F.zip_with("bits", "bits_2", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda x, y: x + y)
    most_by_hub = of_hub + F.least(F.col("shared") - F.col("common"), F.col("shared_2") - F.col("common_2"))

    def reach(common: F.Column) -> F.Column:
        return F.lit(100) * common >= F.lit(percent) * (F.col("n") + F.col("n_2") - common)

    met = split.join(outside, "bucket").where(
        (F.col("root") != F.col("root_2")) & ((F.col("root") == F.col("main")) | (F.col("node") < F.col("node_2")))
        & (F.col("hub") != F.col("node")) & (F.col("hub") != F.col("node_2")) & possible("n", "n_2") & reach(most)
        & F.coalesce(reach(most_by_hub), F.lit(True))
        & (F.array_min(F.array_intersect("all", "all_2")) == F.col("bucket")))  # each pair in one bucket
    rest = met.select(F.col("node").alias("a"), F.col("node_2").alias("b"))
    links = links.unionByName(_confirmed(rest, sets, percent))

    found = components(links)
    groups = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = groups.where("copies > 1 OR root != node").select("root").distinct()
    labels = groups.join(least, "root").select("root", "set_key", "first_id")
    named = labels.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = staged(labels.join(named, "root").select("set_key", "component_id"), "labels")
    out = marks.join(by_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
