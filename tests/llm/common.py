"""Tables the operators have to cope with, and brute-force results."""

from collections import defaultdict

from pyspark.sql import functions as F

# names that operators use inside; a caller's own columns of these names stay out of the way
CLASHING = ("key", "fp", "norm", "sha", "row", "spans", "set_key", "bands", "node", "held_out", "_kinds", "ids", "chars", "slice")


def table(spark, rows):
    """Documents (doc_id, text) with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def empty(spark):
    return table(spark, [])


def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def shingle_components(rows, size, percent):
    """doc_id -> (set size, component), by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        k = min(size, len(words))
        sets[i] = frozenset(tuple(words[j : j + k]) for j in range(len(words) - k + 1)) if words else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, common = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[:n]:
                common[min(a, b), max(a, b)] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}
