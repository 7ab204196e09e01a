"""Mergeable summaries, quantiles from buckets, difference digests: against exact forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orrery.operators import quantiles as Q
from orrery.operators import reconcile as RC
from orrery.operators import series as S
from orrery.operators import sketches as SK
from tests.conftest import SF_ORACLE

INF = float("inf")


def exclusive(values, i, m):
    v, n = sorted(values), len(values)
    j, d = i * (n + 1) // m, i * (n + 1) % m
    a, b = v[max(0, min(j, n) - 1)], v[max(0, min(j + 1, n) - 1)]
    return (a * (m - d) + b * d) / m


def test_merged_quantiles_keep_their_bound_on_every_group(spark):
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet").withColumn("day", F.to_date("ts"))
    sketch = SK.quantile_sketch(ev, ["day", "event_type"], "value")
    values = {}
    for r in ev.select("event_type", "value").collect():
        values.setdefault(r.event_type, []).append(r.value)
    asked = {"p1": (1, 100), "p50": (1, 2), "p90": (9, 10), "p99": (99, 100), "p999": (999, 1000)}
    for r in SK.merged_quantiles(sketch, ["event_type"], asked).collect():
        assert r.n == len(values[r.event_type])
        for name, (i, m) in asked.items():
            want = exclusive(values[r.event_type], i, m)
            assert abs(r[name] - want) <= SK.ERROR * want * 1.0001
    exact = Q.quantile_table(ev, ["event_type"], "value", ["event_id"], None, "max")
    for r in exact.join(SK.merged_quantiles(sketch, ["event_type"], {"s": (9, 10)}), "event_type").collect():
        assert abs(r.p90 - r.s) <= SK.ERROR * r.p90 * 1.0001


def test_quantile_sketch_signs_zero_null_and_small_groups(spark):
    rows = [("a", v) for v in (-100.0, -1.0, 0.0, 0.0, 2.0, 50.0, None, float("nan"))] + [("b", 7.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in SK.merged_quantiles(SK.quantile_sketch(df, ["g"], "v", 0.005), ["g"], {"p50": (1, 2), "p90": (9, 10), "p1": (1, 100)}, 0.005).collect()}
    assert set(got) == {"a", "b"} and got["a"].n == 6
    assert got["a"].p50 == 0 and math.isclose(got["a"].p90, 50, rel_tol=0.005) and math.isclose(got["a"].p1, -100, rel_tol=0.005)
    assert math.isclose(got["b"].p50, 7, rel_tol=0.005) and math.isclose(got["b"].p50, got["b"].p90)
    assert SK.merged_quantiles(SK.quantile_sketch(df.limit(0), ["g"], "v"), ["g"], {"p50": (1, 2)}).collect() == []


def test_sketches_of_parts_merge_to_that_of_the_whole(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(i % 5, rnd.lognormvariate(0, 3)) for i in range(4000)], "day int, v double").withColumn("g", F.lit("x"))
    whole = SK.merged_quantiles(SK.quantile_sketch(df, ["g"], "v"), ["g"], {"p50": (1, 2)}).collect()
    parts = SK.merged_quantiles(SK.quantile_sketch(df, ["day", "g"], "v"), ["g"], {"p50": (1, 2)}).collect()
    assert whole == parts


def test_distinct_counts_of_any_range_keep_their_bound(spark):
    """All ranges of a month, from one stored sketch a day and label."""
    rnd = random.Random(5)
    rows = [(d, lab, f"s{int(rnd.paretovariate(0.5)) % 40_000}") for d in range(30) for lab in "xy" for _ in range(1500)]
    df = spark.createDataFrame(rows, "day int, label string, key string")
    stored = SK.distinct_sketch(df, ["day", "label"], "key").collect()
    table = spark.createDataFrame(stored, "day int, label string, sketch binary")
    ranges = [(a, b) for a in range(30) for b in range(a, 30)]
    wanted = spark.createDataFrame(ranges, "a int, b int")
    got = SK.merged_distinct(table.join(wanted, F.col("day").between(F.col("a"), F.col("b"))), ["a", "b", "label"]).collect()
    by = {}
    for d, lab, k in rows:
        by.setdefault((d, lab), set()).add(k)
    assert len(got) == 2 * len(ranges)
    for r in got:
        want = len(set().union(*(by[d, r.label] for d in range(r.a, r.b + 1))))
        assert abs(r.series - want) <= SK.distinct_error() * want


def test_quantile_from_buckets(spark):
    rows = [("plain", 10.0, 5), ("plain", 20.0, 15), ("plain", INF, 20),
            ("above", 10.0, 1), ("above", INF, 100), ("negative", -5.0, 4), ("negative", 5.0, 8), ("negative", INF, 8),
            ("gap", 1.0, 0), ("gap", 2.0, 0), ("gap", 4.0, 10), ("gap", 8.0, 10), ("gap", INF, 10),
            ("none", 1.0, 0), ("none", INF, 0), ("only inf", INF, 3), ("no inf", 2.0, 4), ("no inf", 6.0, 8)]
    b = spark.createDataFrame(rows, "g string, le double, cum_count long")

    def at(q):
        return {r.g: r.quantile for r in S.histogram_quantile(b, q, ["g"]).collect()}

    assert at(0.5) == {"plain": 15.0, "above": 10.0, "negative": -5.0, "gap": 3.0, "none": None, "only inf": None, "no inf": 2.0}
    assert at(0.75) == {"plain": 20.0, "above": 10.0, "negative": 0.0, "gap": 3.5, "none": None, "only inf": None, "no inf": 4.0}
    assert at(0.125)["plain"] == 5.0 and at(1.0)["plain"] == 20.0 and at(0.0)["gap"] == 2.0
    assert S.histogram_quantile(b.limit(0), 0.5, ["g"]).collect() == []


def test_buckets_of_different_bounds_merge(spark):
    rows = [("x", "s1", 10.0, 10), ("x", "s1", 20.0, 20), ("x", "s1", INF, 25), ("x", "s2", 5.0, 4), ("x", "s2", 15.0, 8), ("x", "s2", INF, 8),
            ("y", "s1", 1.0, 1), ("y", "s3", 1.0, 2)]
    b = spark.createDataFrame(rows, "g string, series_key string, le double, cum_count long")
    got = {(r.g, r.le): r.cum_count for r in S.merged_buckets(b, ["g"]).collect()}
    assert got == {("x", 5.0): 5 + 4, ("x", 10.0): 10 + 6, ("x", 15.0): 15 + 8, ("x", 20.0): 20 + 8, ("x", INF): 33, ("y", 1.0): 3}
    whole = {r.le: r.cum_count for r in S.merged_buckets(b.where("g = 'y'").drop("g"), []).collect()}
    assert whole == {1.0: 3}
    # equal bounds: a plain sum, whose quantile is that of the sum
    same = S.merged_buckets(b.where("series_key = 's1'"), ["g"])
    assert {r.g: r.quantile for r in S.histogram_quantile(same, 0.4, ["g"]).collect()} == {"x": 10.0, "y": 0.4}


def differences(spark, expected, found, **more):
    mk = [spark.createDataFrame(x, "batch string, trace string") for x in (expected, found)]
    return sorted((tuple(r) for r in RC.lost_and_surplus(*mk, "batch", "trace", **more).collect()), key=str)


def brute(expected, found):
    e, f = ({(t, i) for t, i in x if i is not None} for x in (expected, found))
    return sorted([(*x, "missing") for x in e - f] + [(*x, "surplus") for x in f - e], key=str)


@pytest.mark.parametrize(("lost", "more", "ranges"), [(0, 0, 16), (1, 0, 1), (3, 5, 1), (60, 0, 1), (40, 700, 1), (1500, 20, 4), (3000, 3000, 1)])
def test_lost_and_surplus_ids_equal_an_anti_join(spark, lost, more, ranges):
    """Losses at the head, in the middle and at the tail of a batch, and ids too many."""
    expected = [(tag, f"{tag}-{i:05d}") for tag in ("first", "middle", "last") for i in range(3000)]
    kept = {"first": range(lost, 3000), "middle": [i for i in range(3000) if not 1000 <= i < 1000 + lost], "last": range(3000 - lost)}
    found = [(t, f"{t}-{i:05d}") for t, r in kept.items() for i in r] + [("last", f"odd {i}") for i in range(more)] + [("other", "x")] * (more > 0)
    assert differences(spark, expected, found, unique=True, ranges=ranges) == brute(expected, found)


def test_repeated_null_and_empty_sides(spark):
    expected = [("a", "1"), ("a", "1"), ("a", "2"), (None, "3"), ("a", None), ("a", "")]
    found = [("a", "2"), ("a", "2"), ("a", "9"), ("a", "9"), (None, None)]
    assert differences(spark, expected, found) == brute(expected, found)
    assert differences(spark, [], found) == brute([], found)
    assert differences(spark, expected, []) == brute(expected, [])
    assert differences(spark, [], []) == []


def test_what_is_exchanged_grows_with_the_difference_only(spark):
    """Cells, not ids: the table of a tag is as large for 200,000 ids as for 2,000."""
    rows = []
    for n in (2_000, 200_000):
        ids = spark.range(n).select(F.lit("t").alias("batch"), F.col("id").cast("string").alias("trace"))
        keyed = RC._keyed(ids, "batch", "trace")
        cells = RC._cells(keyed, 1, 16).groupBy("tag", "range", "cell").agg(F.sum("n").alias("n"))
        rows.append(cells.count())
    assert rows[0] <= rows[1] <= 16 * 3 * (1 << RC.THIRD_BITS)
    got = RC._differences(RC._keyed(ids, "batch", "trace"), RC._keyed(ids.where("trace <> '77'"), "batch", "trace"), 16).collect()
    assert [r.side for r in got] == [1]
