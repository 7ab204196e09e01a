import json
import os

from pyspark.sql import functions as F

from orrery.operators import series as S
from orrery.streaming import forwarder as FW
from orrery.streaming import windows as W
from tests.conftest import SF_SMALL


def _event_files(spark, scratch, parts=4):
    """Events as ``parts`` files in event-time order (files are read in name
    order, so the watermark only moves forward past data already read)."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = os.path.join(scratch, "events")
    ev.repartitionByRange(parts, "ts").sortWithinPartitions("ts").write.parquet(src)
    # The file source reads oldest files first: make modification times
    # follow the range-partition index (= event-time order).
    files = sorted(f for f in os.listdir(src) if f.startswith("part-"))
    for i, f in enumerate(files):
        os.utime(os.path.join(src, f), (1_000_000 + i, 1_000_000 + i))
    return ev, src


def test_sliding_stream_equals_batch(spark, scratch):
    ev, src = _event_files(spark, scratch)
    stream = W.event_time(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src))
    agg = W.sliding_counts(stream, ["event_type"], "1 day", "6 hours", watermark="1 hour")
    q = (agg.writeStream.format("memory").queryName("st_sliding").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck1")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.event_type, r.window_end.replace(tzinfo=None)): r.n for r in spark.table("st_sliding").collect()}
    batch = S.count_sliding(ev, 86400, 6 * 3600, key="event_type")
    max_ts = ev.agg(F.max("ts")).first()[0]
    # Only windows closed by the final watermark are emitted in append mode.
    import datetime as dt
    closed = max_ts - dt.timedelta(hours=1)
    want = {(r.event_type, r.window_end): r.n for r in batch.collect() if r.window_end <= closed}
    assert got and all(k in want for k in got)
    assert {k: v for k, v in want.items() if k in got} == got
    missing = [k for k in want if k not in got]
    assert all(k[1] > closed - dt.timedelta(days=1) for k in missing)


def _write_logs(scratch):
    d = os.path.join(scratch, "logs")
    os.makedirs(d)
    lines = [
        [json.dumps({"timestamp": 5.0, "service": "api", "msg": "a"}), "",
         '2024-01-01T00:00:00Z stdout F {"timestamp": 6.0, "service": "db"}'],
        ["plain words here", json.dumps({"_time": 1, "timestamp": 9, "service": "api"}), "   "],
    ]
    for i, chunk in enumerate(lines):
        with open(os.path.join(d, f"part{i}.log"), "w") as f:
            f.write("\n".join(chunk) + "\n")
    return d


def test_forwarder_fan_out_and_replay(spark, scratch):
    src = _write_logs(scratch)
    a, b = os.path.join(scratch, "sink_a"), os.path.join(scratch, "sink_b")
    q = FW.start_forwarder(spark, src, [a, b], os.path.join(scratch, "ck2"), available_now=True)
    q.awaitTermination()
    ra = sorted(r.value for r in spark.read.text(a).collect())
    rb = sorted(r.value for r in spark.read.text(b).collect())
    assert ra == rb and len(ra) == 4
    times = sorted(json.loads(x)["_time"] for x in ra if "_msg" not in x)
    assert [float(t) for t in times] == [1.0, 5.0, 6.0]
    # Replaying a batch id leaves the sink unchanged.
    df = spark.createDataFrame([("x",), ("y",)], "value string")
    write = FW.idempotent_writer([os.path.join(scratch, "sink_c")], fmt="text")
    write(df, 7)
    write(df, 7)
    assert sorted(r.value for r in spark.read.text(os.path.join(scratch, "sink_c")).collect()) == ["x", "y"]


def test_dedup_within_watermark(spark, scratch):
    ev, src = _event_files(spark, scratch, parts=2)
    dup = os.path.join(scratch, "dup")
    ev.unionByName(ev).repartition(3).write.parquet(dup)
    s = W.event_time(spark.readStream.schema(ev.schema).parquet(dup))
    d = W.deduplicated(s, ["event_id"])
    q = (d.writeStream.format("memory").queryName("st_dedup").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck3")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("st_dedup").count() == ev.count()


def test_observed_drop_metrics(spark, scratch):
    src = _write_logs(scratch)
    entries = FW.observed_drops(FW.forwarded_entries(FW.tail_lines(spark, src), arrival=F.timestamp_seconds(F.lit(0))))
    q = (entries.writeStream.format("memory").queryName("st_obs")
         .option("checkpointLocation", os.path.join(scratch, "ck4")).trigger(availableNow=True).start())
    q.awaitTermination()
    metrics = [p["observedMetrics"]["forwarder"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(int(m["entries"]) for m in metrics) == 4
    assert sum(int(m["plain"]) for m in metrics) == 1


def test_forwarder_delivers_dead_letters_and_counts_drops(spark, scratch):
    """Payload types survive, rejected lines land in the dead-letter sink, older
    entries are not forwarded, and the query's progress tells the drops."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.log"), "w") as f:
        f.write('{"timestamp": 50, "n": 1.50, "deep": {"a": [1, true]}}\n[1, 2]\n{"timestamp": 5}\nwords\t\n"text"\n')
    sink, dead = os.path.join(scratch, "sink"), os.path.join(scratch, "dead")
    q = FW.start_forwarder(spark, src, [sink], os.path.join(scratch, "ck_dead"), strict=True, available_now=True, since=10.0,
                           dead_letter=dead)
    q.awaitTermination()
    sent = [json.loads(r.value) for r in spark.read.text(sink).collect()]
    assert sorted(len(e) for e in sent) == [2, 4]
    assert {"_time": 50, "timestamp": 50, "n": 1.5, "deep": {"a": [1, True]}} in sent
    assert [e["_msg"] for e in sent if "_msg" in e] == ["words"]
    assert sorted(r.value for r in spark.read.text(dead).collect()) == ['"text"', "[1, 2]"]
    metrics = [p["observedMetrics"]["forwarder"] for p in q.recentProgress if p.get("observedMetrics")]
    assert [sum(int(m[k]) for m in metrics) for k in ("entries", "plain", "rejected")] == [2, 1, 2]


def test_running_totals_update(spark, scratch):
    ev, src = _event_files(spark, scratch, parts=3)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    agg = W.running_totals(s.withColumn("v", F.col("value").cast("decimal(18,2)")), ["event_type"], "v")
    q = (agg.writeStream.format("memory").queryName("st_run").outputMode("complete")
         .option("checkpointLocation", os.path.join(scratch, "ck5")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_type: r.total for r in spark.table("st_run").collect()}
    want = {r.event_type: r.t for r in ev.groupBy("event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("t")).collect()}
    assert got == want


def test_forwarder_restart_resumes_exactly_once(spark, scratch):
    """A stopped job restarted on the same checkpoint delivers every new line
    once and nothing twice (what a lost driver or executor looks like)."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    sink, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck_restart")

    def add(i):
        with open(os.path.join(src, f"f{i}.log"), "w") as f:
            f.write(json.dumps({"timestamp": float(i), "n": i}) + "\n")

    for i in range(3):
        add(i)
    FW.start_forwarder(spark, src, [sink], ck, available_now=True).awaitTermination()
    for i in range(3, 5):
        add(i)
    FW.start_forwarder(spark, src, [sink], ck, available_now=True).awaitTermination()
    got = sorted(json.loads(r.value)["n"] for r in spark.read.text(sink).collect())
    assert got == [0, 1, 2, 3, 4]


def test_periodic_snapshot_stream_equals_batch(spark, scratch):
    ev, src = _event_files(spark, scratch, parts=4)
    stream = W.event_time(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src))
    snap = W.periodic_snapshot(stream, ["event_type"], "value", every="1 day", watermark="1 hour")
    q = (snap.writeStream.format("memory").queryName("st_snap").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck6")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.event_type, r.window_end.replace(tzinfo=None)): (r.value, r.samples)
           for r in spark.table("st_snap").collect()}
    batch = W.periodic_snapshot(W.event_time(ev), ["event_type"], "value", every="1 day")
    want = {(r.event_type, r.window_end.replace(tzinfo=None)): (r.value, r.samples) for r in batch.collect()}
    assert got and all(want[k] == v for k, v in got.items())


def test_step_counts_sum_to_sliding(spark, scratch):
    """Sliding counts rebuilt from streamed step counts equal the direct ones."""
    import datetime as dt
    ev, src = _event_files(spark, scratch, parts=3)
    stream = W.event_time(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src))
    steps = W.step_counts(stream, ["event_type"], "6 hours", watermark="1 hour")
    q = (steps.writeStream.format("memory").queryName("st_steps").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck7")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {}
    for r in spark.table("st_steps").collect():
        for j in range(4):  # 1 day = 4 steps of 6 h
            k = (r.event_type, r.window_end.replace(tzinfo=None) + dt.timedelta(hours=6 * j))
            got[k] = got.get(k, 0) + r.n
    direct = {(r.event_type, r.window_end): r.n for r in S.count_sliding(ev, 86400, 6 * 3600, key="event_type").collect()}
    closed = ev.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1) - dt.timedelta(days=1)
    assert all(got[k] == v for k, v in direct.items() if k[1] <= closed)
