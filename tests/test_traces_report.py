import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from orrery.operators import report as R
from orrery.operators import traces as T
from orrery.operators.quantiles import quantile_table, value_bucket
from orrery.plans import catalog as C
from orrery.plans import views as V

T0 = dt.datetime(2024, 1, 1)


def test_trace_counts_empty_id(spark):
    df = spark.createDataFrame([("", "s1"), ("", "s2")], "trace_id string, span string")
    r = T.trace_counts(df).first()
    assert (r.traces, r.spans, r.spans_per_trace) == (0, 2, 0.0)


def test_search_result_fallback(spark):
    df = spark.createDataFrame([("t1", [], 4), ("t2", [], 0), ("t3", ["a", "b"], 9), ("t4", None, None)],
                               "traceID string, spans array<string>, spanCount int")
    got = [r.n for r in df.select(T.result_span_count(F.col("spans"), F.col("spanCount")).alias("n")).collect()]
    assert got == [4, 1, 2, 1]


def test_search_returns_whole_traces(spark):
    df = spark.createDataFrame([("t1", {"k": "v"}), ("t1", {"k": "w"}), ("t2", {"k": "w"})],
                               "trace_id string, attrs map<string,string>")
    r = T.trace_counts(T.tag_search(df, "k=v")).first()
    assert (r.traces, r.spans) == (1, 2)


def test_keep_matches_else_all(spark):
    df = spark.createDataFrame([("g1", 1), ("g1", 2), ("g2", 3), ("g2", 4)], "g string, v int")
    kept = T.keep_matches_else_all(df, F.col("v") == 1, by=["g"])
    assert sorted(r.v for r in kept.collect()) == [1, 3, 4]
    none = T.keep_matches_else_all(df, F.col("v") == 99)
    assert none.count() == 4


def test_backend_ratio_guard(spark):
    df = spark.createDataFrame([("a", "x", 2, 4), ("b", "x", 1, 2), ("a", "y", 0, 0), ("b", "y", 3, 3)],
                               "backend string, g string, traces long, spans long")
    got = {r.g: (r.trace_ratio, r.span_ratio) for r in T.backend_ratio(df, "backend", "a", "b", by=["g"]).collect()}
    assert got == {"x": (0.5, 0.5), "y": (None, None)}


def test_expected_vs_found(spark):
    e = spark.createDataFrame([("first", 10), ("last", 10)], "k string, expected long")
    f = spark.createDataFrame([("first", 10), ("middle", 3)], "k string, found long")
    got = {r.k: (r.expected, r.found, r.complete) for r in T.expected_vs_found(e, f, ["k"]).collect()}
    assert got == {"first": (10, 10, True), "last": (10, 0, False), "middle": (0, 3, False)}


def _lat(spark, values, key="q"):
    rows = [(key, T0 + dt.timedelta(seconds=i), i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, event_id long, v double")


def test_small_n_rules(spark):
    vals = [5, 1, 9, 3, 7, 2, 8, 4, 6]  # n = 9, most recent = 6, max = 9
    rec = quantile_table(_lat(spark, vals), ["k"], "v", ["ts", "event_id"], "ts", "recent").first()
    mx = quantile_table(_lat(spark, vals), ["k"], "v", ["ts", "event_id"], None, "max").first()
    assert (rec.p90, rec.p99, rec.p50) == (6.0, 6.0, 5.0)
    assert (mx.p90, mx.p99) == (9.0, 9.0)


def test_exclusive_quantiles_match_python(spark):
    rnd = random.Random(1)
    for n in (10, 11, 37, 99, 100, 101, 1000):
        vals = [round(rnd.uniform(0, 1000), 2) for _ in range(n)]
        r = quantile_table(_lat(spark, vals), ["k"], "v", ["ts", "event_id"], "ts", "recent").first()
        assert r.n == n
        assert r.p50 == statistics.median(vals)
        assert r.p90 == statistics.quantiles(vals, n=10)[8]
        if n >= 100:
            assert r.p99 == statistics.quantiles(vals, n=100)[98]
        else:
            assert r.p99 == vals[-1]


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("partitions", ["1", "16"])
def test_quantiles_do_not_depend_on_the_plan(spark, reuse, partitions):
    """The same values whether or not Spark reuses an exchange, however many partitions."""
    rnd = random.Random(4)
    hot = [round(rnd.uniform(-100, 100), 2) for _ in range(2000)] + [7.25] * 1500
    cold = [1.0, 5.0, 3.0]
    df = _lat(spark, hot, "hot").unionByName(_lat(spark, cold, "cold")).withColumn("payload", F.repeat(F.lit("x"), 50))
    keys = {"spark.sql.exchange.reuse": reuse, "spark.sql.shuffle.partitions": partitions}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = {r.k: r for r in quantile_table(df, ["k"], "v", ["ts", "event_id"], "ts", "recent", stats=True).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got["hot"].p50 == statistics.median(hot) and got["hot"].p90 == statistics.quantiles(hot, n=10)[8]
    assert got["hot"].p99 == statistics.quantiles(hot, n=100)[98]
    assert (got["hot"].n, got["hot"].min, got["hot"].max) == (3500, min(hot), max(hot))
    assert abs(got["hot"].mean - statistics.fmean(hot)) < 1e-9
    assert got["cold"].p50 == 3.0 and got["cold"].p90 == 3.0


def test_value_buckets_follow_the_order(spark):
    vals = [float("-inf"), -1e300, -2.0, -1.0, -1e-300, 0.0, 5e-324, 1e-300, 1.0, 1.0000001, 2.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r.b for r in df.select("i", value_bucket("v").alias("b")).orderBy("i").collect()]
    assert got == sorted(got) and len(set(got)) >= len(vals) - 1


def test_errors_and_join(spark):
    q = spark.createDataFrame([("a", True), ("a", None), ("a", False), ("b", True)], "query_key string, success boolean")
    errs = {r.query_key: r.errors for r in R.error_counts(q).collect()}
    assert errs == {"a": 2, "b": 0}
    lat = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "query_key string, p50 double")
    e = spark.createDataFrame([("a", 2)], "query_key string, errors long")
    got = {r.query_key: r.errors for r in R.latency_with_errors(lat, e).collect()}
    assert got == {"a": 2, "c": 0}


def test_trace_summary_zero_spans(spark):
    q = spark.createDataFrame([("t", True, 0, 0)], "backend string, success boolean, trace_count long, span_count long")
    i = spark.createDataFrame([("t", 0, 0)], "backend string, spans_received long, spans_dropped long")
    r = R.trace_summary(q, i).first()
    assert (r.spans, r.dropped, r.drop_rate_pct) == (0, 0, 0.0)
    i2 = spark.createDataFrame([("t", 200, 0), ("t", 400, 10)], "backend string, spans_received long, spans_dropped long")
    r2 = R.trace_summary(q, i2).first()
    assert (r2.spans, r2.dropped, r2.drop_rate_pct) == (400, 10, 2.5)


def test_storage_fill_in(spark):
    a = spark.createDataFrame([("x", 0), ("y", 5), ("z", None)], "service string, size_a long")
    b = spark.createDataFrame([("x", 7), ("z", 0), ("w", 3)], "service string, size_b long")
    got = {r.service: r.storage_bytes for r in R.storage_fill_in(a, b).collect()}
    assert got == {"x": 7, "y": 5, "w": 3}


def test_counter_delta(spark):
    s = spark.createDataFrame([("a", T0, 5.0), ("a", T0 + dt.timedelta(seconds=9), 20.0)],
                              "k string, ts timestamp_ntz, v double")
    r = R.counter_delta(s, "k", "v").first()
    assert (r.before, r.after, r.delta) == (5.0, 20.0, 15.0)


def _write_response(path, key, traces):
    import json
    with open(path, "w") as f:
        json.dump({key: traces}, f, indent=2)


def test_trace_result_files(spark, tmp_path):
    import os

    from orrery.sources import trace_results as TR

    app = {"key": "benchmark_app", "value": "x"}
    run = {"key": "benchmark_run_id", "value": "r1"}
    other = {"key": "service.name", "value": "svc"}
    d = tmp_path / "resp"
    d.mkdir()
    # API shape 1 ("data"): t1 has both tags on one process, t2 split across two.
    _write_response(d / "a.json", "data", [
        {"traceID": "t1", "spans": [{"spanID": "s1", "tags": []}, {"spanID": "s2", "tags": []}],
         "processes": {"p1": {"tags": [app, run, other]}}},
        {"traceID": "t2", "spans": [{"spanID": "s3", "tags": []}],
         "processes": {"p1": {"tags": [app]}, "p2": {"tags": [run]}}},
    ])
    # API shape 2 ("traces"): summaries without span lists; no labelled trace.
    _write_response(d / "b.json", "traces", [
        {"traceID": "u1", "spans": [], "spanCount": 4},
        {"traceID": "u2", "spanCount": 0},
        {"traceID": "", "spans": [{"spanID": "x", "tags": []}]},
    ])
    res = TR.read_results(spark, str(d))
    got = {os.path.basename(r.response): (r.traces, r.spans) for r in TR.counts(res).collect()}
    assert got == {"a.json": (2, 3), "b.json": (2, 6)}
    kept = TR.labelled(res, ("benchmark_app", "x"), ("benchmark_run_id", "r1"))
    ids = sorted(r.traceID for r in kept.collect())
    assert ids == ["", "t1", "u1", "u2"]  # a.json filtered to t1; b.json had no match: all kept
    tags = sorted((r.key, r.value) for r in TR.benchmark_tags(res).collect())
    assert tags == [("benchmark_app", "x"), ("benchmark_app", "x"), ("benchmark_run_id", "r1"),
                    ("benchmark_run_id", "r1")]


def test_summary_stats_approximate_close(spark):
    rnd = random.Random(12)
    vals = [round(rnd.uniform(0, 1000), 2) for _ in range(5000)]
    df = _lat(spark, vals)
    ex = R.summary_stats(df, ["k"], "v", ["ts", "event_id"]).first()
    ap = R.summary_stats(df, ["k"], "v", ["ts", "event_id"], exact=False).first()
    for c in ("p50", "p90", "p99"):
        assert abs(ex[c] - ap[c]) <= 0.01 * 1000, c
    assert (ex.n, ex.min, ex.max) == (ap.n, ap.min, ap.max)


def span_tables(spark, folder):
    lines = [(k if k % 50 else None, k % 7, n, "RAN"[k % 3], "OF"[k % 2], T0) for k in range(1, 400) for n in range(1 + k % 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    orders = [(k, "POF"[k % 3]) for k in range(1, 420)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
    return [r for r in lines if r[0] is not None], orders


def test_spans_of_a_task_do_not_grow_with_the_table(spark, scratch, monkeypatch, capsys):
    lines, orders = span_tables(spark, scratch)
    monkeypatch.setattr(V, "TASK_SPANS", 20)
    n = V.span_tasks(spark, scratch)
    assert n >= len(lines) / 20
    status = dict(orders)
    for query, hits in ((C.trace_field_search, [r[0] for r in lines if status[r[0]] == "P"]),
                        (C.trace_span_counts, [r[0] for r in lines if r[3:5] == ("R", "F")])):
        df = query(spark, scratch)
        df.explain()
        # dealt by trace once, to that many partitions; groups by trace need no other shuffle
        plan = capsys.readouterr().out
        assert set(re.findall(r"hashpartitioning\((?:trace_id|_order)#\d+, (\d+)\), REPARTITION_BY_NUM", plan)) == {str(n)}
        assert not re.search(r"hashpartitioning\(.*ENSURE_REQUIREMENTS", plan)
        spans = sum(r[0] in set(hits) for r in lines)
        assert tuple(df.first())[:2] == (len(set(hits)), spans)


def test_lost_ids_of_dealt_spans(spark, scratch, monkeypatch, capsys):
    lines, orders = span_tables(spark, scratch)
    monkeypatch.setattr(V, "TASK_SPANS", 20)
    df = C.reconcile_lost_ids(spark, scratch)
    df.explain()
    assert f", {V.span_tasks(spark, scratch)}), REPARTITION_BY_NUM" in capsys.readouterr().out
    seen, status = {r[0] for r in lines}, dict(orders)
    found = {(status[k], k + 10**12 if k % 211 == 0 else k) for k in seen}
    expected = {(v, k) for k, v in orders}
    want = [(*x, "missing") for x in expected - found] + [(*x, "surplus") for x in found - expected]
    assert sorted(map(tuple, df.collect())) == sorted(want)
