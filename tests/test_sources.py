import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from orrery.operators import report as R
from orrery.sources import exposition as X
from orrery.sources import runs
from orrery.streaming import forwarder as FW
from orrery.streaming import windows as W


def _obs(ts, scenario, cpu, mem, spans, q_ok):
    return {
        "timestamp": ts, "scenario": scenario,
        "services": {
            "svc_a": {"docker_stats": {"cpu_percent": cpu, "memory_bytes": mem, "memory_percent": 1.0},
                      "metrics": {"m": 1.0}, "ingest_metrics": {"spans_received": spans, "spans_dropped": 0,
                                                                 "_debug": {"x": 1}},
                      "storage_size_bytes": 2048},
        },
        "queries": {"svc_a:q": {"latency_ms": 5.0, "success": q_ok, "trace_count": 3, "span_count": 7}},
    }


def _write_run(root, run_id, obs, mtime):
    d = os.path.join(root, run_id)
    os.makedirs(d)
    with open(os.path.join(d, "observations.json"), "w") as f:
        json.dump(obs, f, indent=2)
    with open(os.path.join(d, "manifest.json"), "w") as f:
        json.dump({"run_id": run_id, "timestamp": "t", "scenarios": ["steady"], "host_info": {"platform": "p",
                   "ram_gb": 16}, "load_volume": {}, "final_storage_bytes": {"svc_a": 10},
                   "query_latencies": {"svc_a:q": {"p50": 1, "p90": 2, "p99": 3}}}, f, indent=2)
    for name in ("observations.json", "manifest.json"):
        os.utime(os.path.join(d, name), (mtime, mtime))


def test_run_scan_latest_and_tables(spark, scratch):
    root = os.path.join(scratch, "runs")
    _write_run(root, "run_old", [_obs(1.0, "steady", 10.0, 1048576, 5, True)], 1_000)
    _write_run(root, "run_new", [_obs(1.0, "steady", 10.0, 1048576, 5, True),
                                 _obs(3.0, "burst", 30.0, 3 * 1048576, 9, False)], 2_000)
    m = runs.read_manifests(spark, root)
    assert runs.latest_run(m).first().run_id == "run_new"
    obs = runs.read_observations(spark, root).filter(F.col("run_id") == "run_new")
    so = runs.service_obs(obs)
    assert so.count() == 2 and "_debug" not in so.columns
    use = {r.service: r for r in R.resource_usage(so).collect()}
    assert use["svc_a"].avg_cpu_pct == 20.0 and use["svc_a"].max_mem_mb == 3.0
    qo = runs.query_obs(obs)
    assert {r.query_key: r.errors for r in R.error_counts(qo).collect()} == {"svc_a:q": 1}
    both = runs.union_observations(so.filter(F.col("scenario") == "steady"), so.filter(F.col("scenario") == "burst"))
    assert both.count() == 2
    out = os.path.join(scratch, "out")
    made = runs.manifests(obs, "t2", "p", 16)
    runs.write_run(obs, made, os.path.join(out, "artifacts"))
    again = runs.read_observations(spark, os.path.join(out, "artifacts"))
    cols = [c for c in again.columns if c != "_metadata"]
    assert sorted(map(str, again.select(cols).collect())) == sorted(map(str, obs.select(cols).collect()))
    m = runs.read_manifests(spark, os.path.join(out, "artifacts")).first()
    assert (m.run_dir, m.scenarios, m.final_storage_bytes) == ("run_new", ["steady", "burst"], {"svc_a": 2048})
    assert m.query_latencies["svc_a:q"].p50 == 5.0 and m.host_info.ram_gb == 16
    runs.write_tables({"resources": R.resource_usage(so)}, os.path.join(out, "tables"))
    assert spark.read.parquet(os.path.join(out, "tables", "resources")).count() == 1


def test_latest_run_none(spark, scratch):
    root = os.path.join(scratch, "empty")
    os.makedirs(os.path.join(root, "x"))
    with open(os.path.join(root, "x", "manifest.json"), "w") as f:
        f.write("")
    assert runs.latest_run(runs.read_manifests(spark, root).filter("run_id is not null")).count() == 0


def test_pages_to_lines(spark, scratch):
    d = os.path.join(scratch, "pages")
    os.makedirs(d)
    with open(os.path.join(d, "svc1.txt"), "w") as f:
        f.write("# TYPE a counter\na 1\na{x=\"1\"} 2\n")
    with open(os.path.join(d, "svc2.txt"), "w") as f:
        f.write("b 5\n")
    lines = X.pages_to_lines(X.read_pages(spark, d))
    sums = {(os.path.basename(r.page), r.name): r.value for r in X.metric_sums(lines, ["page"]).collect()}
    assert sums == {("svc1.txt", "a"): 3.0, ("svc2.txt", "b"): 5.0}
    drops = X.prefix_sum(X.metric_sums(lines, ["page"]), ["page"], "a")
    assert sorted(r.value for r in drops.collect()) == [0.0, 3.0]


def test_tail_from_now_and_retention(spark, scratch):
    d = os.path.join(scratch, "logs")
    os.makedirs(d)
    with open(os.path.join(d, "a.log"), "w") as f:
        f.write('{"timestamp": 10}\n{"timestamp": 20}\nplain\n')
    lines = spark.read.text(d).select(F.col("value").alias("raw"))
    got = FW.forwarded_entries(lines, arrival=F.timestamp_seconds(F.lit(30)), since=F.lit(15.0))
    assert sorted(r.event_time for r in got.collect()) == [20.0, 30.0]
    ev = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 5, 9)], "ts timestamp_ntz")
    kept = W.retained(ev, "ts", 5, now=F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"))
    assert kept.count() == 2


def test_nonzero_or_fail(spark):
    ok = spark.createDataFrame([(3,)], "n long")
    assert R.nonzero_or_fail(ok, "n", "empty").first().n == 3
    bad = spark.createDataFrame([(0,)], "n long")
    with pytest.raises(Exception, match="empty"):
        R.nonzero_or_fail(bad, "n", "empty").collect()


def test_partitioned_layout_prunes_dates(spark, scratch):
    from orrery.plans import views as V
    from orrery.sources import layout
    from tests.conftest import SF_SMALL

    s = V.samples(spark, SF_SMALL).select("series_key", "ts", "event_id", "value")
    path = os.path.join(scratch, "samples")
    layout.write_partitioned(s, path)
    start, end = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12, 12)
    df = layout.read_range(spark, path, start, end)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(date" in plan
    want = s.filter((F.col("ts") > F.lit(start)) & (F.col("ts") <= F.lit(end))).count()
    assert df.count() == want > 0
    assert len([p for p in os.listdir(path) if p.startswith("date=")]) == 30


def test_summary_tables(spark, scratch):
    root = os.path.join(scratch, "runs2")
    obs = [_obs(1.0, "steady", 10.0, 1048576, 5, True), _obs(3.0, "burst", 30.0, 3 * 1048576, 9, False)]
    for o in obs:
        o["services"]["logs_b"] = {"docker_stats": {"cpu_percent": 1.0, "memory_bytes": 0},
                                   "ingest_metrics": {"lines_ingested": 0, "rows_ingested": 70, "lines_dropped": 2}}
        o["queries"]["svc_a:traces_by_label"] = {"latency_ms": 1.0, "success": True, "trace_count": 4,
                                                 "span_count": 0}
        o["queries"]["logs_b:{x} |= \"ERROR\""] = {"latency_ms": 2.0, "success": False}
    _write_run(root, "r", obs, 1_000)
    m = runs.read_manifests(spark, root)
    with open(os.path.join(root, "r", "manifest.json")) as f:
        man = json.load(f)
    man["load_volume"] = {"series_total": 1234567, "metrics_series": 1000, "log_lines": 5000, "log_rate": 5000.4,
                          "traces_spans": 20, "spans_rate": 2000}
    man["query_latencies"]["logs_b:{x} |= \"ERROR\""] = {"p50": 2, "p90": 2, "p99": 2}
    with open(os.path.join(root, "r", "manifest.json"), "w") as f:
        json.dump(man, f)
    m = runs.read_manifests(spark, root)
    o = runs.read_observations(spark, root)
    t = R.summary_tables(m, runs.service_obs(o), runs.query_obs(o),
                         {"metrics": ["svc_x"], "logs": ["logs_b"], "traces": ["svc_a"]}, materialize_inputs=True)
    plan = spark._jvm.PythonSQLUtils.explainString(t["ingest"]._jdf.queryExecution(), "simple")
    assert "FileScan parquet" in plan and "FileScan json" not in plan  # reads the written table
    assert set(t) == {"load_volume", "metrics", "logs", "traces", "storage", "ingest", "resources"}
    lv = {r.metric: (r.value, r.rate) for r in t["load_volume"].collect()}
    assert lv["Time Series"] == ("1,234,567 series", "1,000 active")
    assert lv["Log Lines"] == ("5,000 lines", "5000 lines/sec")
    logs = t["logs"].collect()
    assert len(logs) == 1 and logs[0].errors == 2 and logs[0].query == '{x} |= "ERROR"'
    tr = {r.backend: r for r in t["traces"].collect()}
    assert tr["svc_a"].traces == 4 and tr["svc_a"].spans == 9  # span count 0 -> ingest fallback
    ing = {r.service: (r.type, r.total_ingested, r.total_dropped) for r in t["ingest"].collect()}
    assert ing == {"svc_a": ("Spans", 9, 0), "logs_b": ("Lines", 70, 2)}
    assert t["storage"].first().storage_size == "10.00 B"
    assert t["resources"].count() == 2


def test_run_parts_and_arrays_are_read_alike(spark, scratch):
    """A run written as parts of lines, in order of time within each, beside one written as an array."""
    root = os.path.join(scratch, "mixed")
    _write_run(root, "run_array", [_obs(float(t), "steady", 1.0, 1, t, True) for t in range(5)], 1_000)
    obs = runs.read_observations(spark, root)
    many = obs.drop("run_id").crossJoin(spark.range(40).select((F.col("id") * 10).cast("double").alias("_t")))
    many = many.withColumn("timestamp", F.col("timestamp") + F.col("_t")).drop("_t").withColumn("run_id", F.lit("run_parts"))
    many = many.select(*obs.columns)
    out = os.path.join(scratch, "out_mixed")
    runs.write_run(many.repartition(4), runs.manifests(many, "t"), out)
    parts = [os.path.join(d, f) for d, _, files in os.walk(out) for f in files if "observations.jsonl" in d and f.startswith("part-")]
    assert parts
    seen = 0
    for p in parts:
        with open(p) as f:
            times = [json.loads(x)["timestamp"] for x in f]
        assert times == sorted(times)
        seen += len(times)
    assert seen == 200
    again = runs.read_observations(spark, out)
    assert again.count() == 200 and {r.run_id for r in again.select("run_id").distinct().collect()} == {"run_parts"}
    assert runs.latest_run(runs.read_manifests(spark, out)).first().run_id == "run_parts"
    # both forms under one root
    os.rename(os.path.join(root, "run_array"), os.path.join(out, "run_array"))
    both = runs.read_observations(spark, out)
    assert {(r.run_id, r["count"]) for r in both.groupBy("run_id").count().collect()} == {("run_parts", 200), ("run_array", 5)}


def test_pages_stay_bounded_as_the_table_grows(spark, scratch, monkeypatch):
    from orrery.plans import catalog, views

    monkeypatch.setattr(views, "PAGE_LINES", 20)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    largest = []
    for times in (1, 10):
        sf = os.path.join(scratch, f"sf{times}")
        more = ev.crossJoin(spark.range(times)).withColumn("event_id", F.col("event_id") * 50 * times + F.col("id") * 50 + F.col("event_id") % 50).drop("id")
        more.write.parquet(os.path.join(sf, "events.parquet"))
        folder = views.exposition_files(spark, sf)
        largest.append(max(r.n for r in spark.read.text(folder).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()))
        lines = views.exposition_lines(spark, sf)
        want = {(r.service, str(r.scrape_ts.date()), r.name): round(r.value, 6) for r in catalog.X.metric_sums(lines, ["service", "scrape_ts"]).collect()}
        assert {(r.service, r.day, r.name): r.value for r in catalog.exposition_pages_sum(spark, sf).collect()} == want
    assert largest[1] <= 2.5 * max(largest[0], 20)
