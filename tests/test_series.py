import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery.operators import series as S
from orrery.operators.sequence import with_previous, with_running_sum

T0 = dt.datetime(2024, 1, 1)


def _samples(spark, rows):
    return spark.createDataFrame(
        [(k, T0 + dt.timedelta(seconds=s), i, v) for i, (k, s, v) in enumerate(rows)],
        "series_key string, ts timestamp_ntz, event_id long, value double",
    )


def test_last_step_total_older_series(spark):
    end = T0 + dt.timedelta(seconds=100000)
    df = _samples(spark, [("a", 100000 - 5400, 1.0), ("b", 100000, 1.0)])
    got = S.count_last_step_total(df, 3600, 10, end=end).first().total
    plain = S.count_last_step_total(df, 3600, 10, end=end, mode="plain").first().total
    assert got == 2 and plain == 1


def test_last_step_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(f"s{rnd.randint(0, 30)}", rnd.randint(0, 20000), 1.0) for _ in range(400)]
    end_s, w, step = 20000, 3600, 60
    df = _samples(spark, rows)
    got = S.count_last_step_total(df, w, step, end=T0 + dt.timedelta(seconds=end_s)).first().total
    want = 0
    for key in {k for k, _, _ in rows}:
        ts = [s for k, s, _ in rows if k == key]
        last = 0
        for j in range(w // step + 1):
            t = end_s - j * step
            c = sum(1 for s in ts if t - w < s <= t)
            if c:
                last = c
                break
        want += last
    assert got == want


def test_counter_rate_reset(spark):
    df = _samples(spark, [("a", 10, 5.0), ("a", 20, 8.0), ("a", 30, 2.0), ("a", 40, 4.0), ("b", 35, 1.0)]) \
        .withColumnRenamed("value", "counter")
    r = {x.series_key: x for x in S.counter_rate(df, 100, end=T0 + dt.timedelta(seconds=50)).collect()}
    assert r["a"].increase == 7.0 and r["a"].rate == 0.07 and "b" not in r


def test_with_previous_matches_lag_across_buckets(spark):
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 3)}", rnd.randint(0, 40 * 86400), float(i)) for i in range(500)]
    df = _samples(spark, rows)
    got = {r.event_id: r.prev_value for r in with_previous(df, ["series_key"], ["ts", "event_id"], ["value"], "ts",
                                                           bucket_seconds=86400).collect()}
    w = Window.partitionBy("series_key").orderBy("ts", "event_id")
    want = {r.event_id: r.p for r in df.select("event_id", F.lag("value").over(w).alias("p")).collect()}
    assert got == want


def test_running_sum_matches_window(spark):
    rnd = random.Random(5)
    rows = [(f"k{rnd.randint(0, 3)}", rnd.randint(0, 20 * 86400), float(rnd.randint(1, 9))) for _ in range(300)]
    df = _samples(spark, rows)
    got = {r.event_id: r.c for r in with_running_sum(df, ["series_key"], ["ts", "event_id"], "value", "c", "ts",
                                                      bucket_seconds=3 * 86400).collect()}
    w = Window.partitionBy("series_key").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.event_id: r.c for r in df.select("event_id", F.sum("value").over(w).alias("c")).collect()}
    assert got == want


def test_sliding_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [("a", rnd.randint(0, 5000), 1.0) for _ in range(60)]
    df = _samples(spark, rows)
    got = {(r.series_key, r.window_end): r.n for r in S.count_sliding(df, 600, 200).collect()}
    want = {}
    for _, s, _ in rows:
        t = -(-s // 200) * 200
        while t - 600 < s:
            key = ("a", T0 + dt.timedelta(seconds=t))
            want[key] = want.get(key, 0) + 1
            t += 200
    assert got == want


def test_churn(spark):
    df = _samples(spark, [("a", 10, 1.0), ("b", 10, 1.0), ("a", 86400 + 5, 1.0), ("c", 86400 + 5, 1.0)])
    got = {r.interval_start.day: (r.active, r.appeared, r.disappeared) for r in S.series_churn(df, 86400).collect()}
    assert got == {1: (2, 2, 0), 2: (2, 1, 1), 3: (0, 0, 2)}


def test_histogram(spark):
    df = _samples(spark, [("a", 1, 5.0), ("a", 2, 50.0), ("a", 3, 70.0)])
    got = {r.le: r.cum_count for r in S.histogram_buckets(df, [10, 50, 100]).collect()}
    assert got == {10.0: 1, 50.0: 2, 100.0: 3}


def test_last_step_with_short_query_range(spark):
    """1 h windows evaluated over the last 5 minutes (the reference's log count)."""
    rnd = random.Random(9)
    rows = [(f"s{rnd.randint(0, 20)}", rnd.randint(0, 20000), 1.0) for _ in range(500)]
    end_s, w, step, rng = 20000, 3600, 60, 300
    got = S.count_last_step_total(_samples(spark, rows), w, step, end=T0 + dt.timedelta(seconds=end_s),
                                  range_seconds=rng).first().total
    want = 0
    for key in {k for k, _, _ in rows}:
        ts = [s for k, s, _ in rows if k == key]
        for j in range(rng // step + 1):
            t = end_s - j * step
            c = sum(1 for s in ts if t - w < s <= t)
            if c:
                want += c
                break
    assert got == want


def test_bucket_width_follows_hot_series(spark):
    from orrery.operators.sequence import choose_bucket_seconds

    # 4,000 rows of one series inside one hour, plus a sparse one.
    rows = [("hot", i % 3600, 1.0) for i in range(4000)] + [("cold", 7200 * i, 1.0) for i in range(10)]
    df = _samples(spark, rows)
    assert choose_bucket_seconds(df, ["series_key"], "ts", target_rows=1000) == 3600 * 1000 // 4000
    assert choose_bucket_seconds(df, ["series_key"], "ts", target_rows=10**6) == 3600 * (10**6 // 4000)
    # Results do not depend on the width.
    a = {r.event_id: r.prev_value for r in with_previous(df, ["series_key"], ["ts", "event_id"], ["value"], "ts",
                                                         bucket_seconds=900).collect()}
    b = {r.event_id: r.prev_value for r in with_previous(df, ["series_key"], ["ts", "event_id"], ["value"], "ts",
                                                         bucket_seconds=86400).collect()}
    assert a == b


def test_sliding_dense_and_sparse_series(spark):
    rnd = random.Random(21)
    rows = [("dense", s, 1.0) for s in range(0, 3000, 7)]
    rows += [(f"sparse{j}", rnd.randint(0, 20000), 1.0) for j in range(5) for _ in range(4)]
    df = _samples(spark, rows)
    w, step = 300, 60
    got = {(r.series_key, r.window_end): r.n for r in S.count_sliding(df, w, step).collect()}
    want = {}
    for key, s, _ in rows:
        t = -(-s // step) * step
        while t - w < s:
            k = (key, T0 + dt.timedelta(seconds=t))
            want[k] = want.get(k, 0) + 1
            t += step
    assert got == want
