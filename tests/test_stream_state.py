"""Entry-bounded tail, atomic sinks, durable counts, keyed state: restarts and failures included."""

import datetime as dt
import json
import os
import random
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orrery.operators import series as S
from orrery.plans import catalog, views
from orrery.sources import tail as T
from orrery.streaming import commits
from orrery.streaming import forwarder as FW
from orrery.streaming import stateful as SF
from tests.conftest import SF_SMALL


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def put(folder, name, data, mode="wb"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), mode) as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def drain(spark, stream, home):
    """Runs to the end; (batch id, raw) of what came."""
    def write(batch, batch_id):
        batch.withColumn("b", F.lit(batch_id)).write.mode("overwrite").parquet(f"{home}/out/batch={batch_id}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{home}/ck").trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if not os.path.exists(f"{home}/out"):
        return []
    return [(r.b, r.raw) for r in spark.read.parquet(f"{home}/out").orderBy("b", "source", "line_offset").collect()]


def test_tail_admits_lines_and_resumes_inside_a_file(spark, scratch):
    src = f"{scratch}/in"
    put(src, "a.log", "".join(f"a{i}\n" for i in range(25)))
    put(src, "b.log", "b0\r\nb1 \xff\n".encode("latin-1") + b"\nunended")
    put(src, "_hidden", "no\n")
    got = drain(spark, T.tail(spark, src, f"{scratch}/p/offset.json", entries=10), scratch)
    sizes = {b: sum(x == b for x, _ in got) for b, _ in got}
    assert sorted(sizes.values()) == [8, 10, 10]
    assert [t for _, t in got] == [*(f"a{i}" for i in range(25)), "b0", "b1 �", ""]
    # a line gets its end, a file grows, a new one comes, while nothing runs
    put(src, "b.log", " now\nb4\n", "ab")
    put(src, "c.log", "c0\nlast")
    put(src, "d.log", "")
    more = drain(spark, T.tail(spark, src, f"{scratch}/p/offset.json", entries=10), scratch)
    assert [t for _, t in more[28:]] == ["unended now", "b4", "c0", "last"] and more[:28] == got


def test_tail_from_the_end_reads_what_comes_later(spark, scratch):
    src = f"{scratch}/in"
    put(src, "a.log", "old\n" * 1000)
    assert drain(spark, T.tail(spark, src, f"{scratch}/p/o.json", 10, "end"), scratch) == []
    put(src, "a.log", "new 1\n", "ab")
    put(src, "b.log", "new 2\n")
    assert [t for _, t in drain(spark, T.tail(spark, src, f"{scratch}/p/o.json", 10, "end"), scratch)] == ["new 1", "new 2"]


def test_tail_offsets_and_ranges_without_spark(scratch):
    src, rnd = f"{scratch}/in", random.Random(3)
    lines = ["x" * rnd.randrange(0, 90) for _ in range(500)]
    put(src, "f.log", "".join(f"{x}\n" for x in lines))
    reader = T.TailReader({"path": src, "progress": f"{scratch}/p/o.json", "entries": "37", "task_bytes": "256"})
    at, got = reader.initialOffset(), []
    while (to := reader.latestOffset()) != at:
        assert to["entries"] - at["entries"] <= 37 and reader.latestOffset() == to
        ranges = reader.partitions(at, to)
        assert all(r.end - r.begin <= 256 + 91 for r in ranges)
        rows = [x for r in ranges for b in reader.read(r) for x in b.column("raw").to_pylist()]
        assert len(rows) == to["entries"] - at["entries"]
        got += rows
        at = to
    assert got == lines
    again = T.TailReader({"path": src, "progress": f"{scratch}/p/o.json"})
    assert again.latestOffset() == at
    assert T.TailReader({"path": f"{scratch}/none", "progress": f"{scratch}/p/n.json"}).latestOffset() == {"files": {}, "entries": 0}


def forward(spark, src, home, **more):
    q = FW.start_forwarder(spark, src, [f"{home}/a", f"{home}/b"], f"{home}/ck", strict=True, dead_letter=f"{home}/dead", **more)
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_no_batch_is_visible_in_one_sink_only(spark, scratch):
    """The second sink fails after the first was written; then the run is started again."""
    src, log = f"{scratch}/in", FW.commit_log(f"{scratch}/ck")
    put(src, "a.log", "".join(json.dumps({"timestamp": i, "n": i}) + "\n" for i in range(8)))
    put(scratch, "b", "a file where the sink's folder should be")
    with pytest.raises(StreamingQueryException):
        forward(spark, src, scratch, entries_per_batch=5)
    assert os.listdir(f"{scratch}/a") and commits.visible(spark, log, f"{scratch}/a").collect() == []
    assert commits.totals(spark, log).collect() == []
    os.rename(f"{scratch}/b", f"{scratch}/was_b")
    forward(spark, src, scratch, entries_per_batch=5)
    for sink in "ab":
        rows = commits.visible(spark, log, f"{scratch}/{sink}").collect()
        assert sorted((r.batch_id, json.loads(r.value)["n"]) for r in rows) == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 5), (1, 6), (1, 7)]
    assert {r.metric: r.lines for r in commits.totals(spark, log).collect()} == {"entries": 8, "plain": 0, "rejected": 0, "untimed": 0}


def test_a_replayed_batch_is_committed_once(spark, scratch):
    df = spark.createDataFrame([("x",), ("y",)], "value string")
    write = commits.atomic_writer([f"{scratch}/a", f"{scratch}/b"], f"{scratch}/log", {"rows": F.count(F.lit(1))})
    for _ in range(3):
        write(df, 4)
    assert [tuple(r) for r in commits.entries(spark, f"{scratch}/log").collect()] == [(4, "rows", 2)]
    df.write.text(f"{scratch}/a/batch_id=5")  # never committed
    assert sorted(r.value for r in commits.visible(spark, f"{scratch}/log", f"{scratch}/a").collect()) == ["x", "y"]


def test_counts_are_exact_over_many_batches_and_a_restart(spark, scratch):
    """More micro-batches than the progress keeps."""
    src, rnd, log = f"{scratch}/in", random.Random(1), FW.commit_log(f"{scratch}/ck")
    kinds = [('{"timestamp": 1}', "entries"), ("words", "plain"), ("[1]", "rejected"), ('{"timestamp": "?"}', "untimed")]
    drawn = [rnd.choice(kinds) for _ in range(330)]
    for name, part in (("a.log", drawn[:160]), ("b.log", drawn[160:])):
        put(src, name, "".join(f"{x}\n" for x, _ in part))
        forward(spark, src, scratch, entries_per_batch=3)
    log_rows = commits.entries(spark, log)
    n = {k: sum(x == k for _, x in drawn) for _, k in kinds}
    assert log_rows.select("batch_id").distinct().count() > 100
    assert {r.metric: r.lines for r in commits.totals(spark, log).collect()} == {
        "entries": 330 - n["rejected"], "plain": n["plain"], "rejected": n["rejected"], "untimed": n["untimed"]}
    for sink, want in (("a", 330 - n["rejected"]), ("b", 330 - n["rejected"]), ("dead", n["rejected"])):
        assert commits.visible(spark, log, f"{scratch}/{sink}").count() == want


def samples(seed, n=600):
    """(series, second, id, value) of counters that reset, in order of time but for neighbours."""
    rnd, rows, now = random.Random(seed), [], {}
    for i in range(n):
        k = rnd.choice(["a", "a", "a", "b", "c"])
        now[k] = 0 if rnd.random() < 0.05 else now.get(k, 0) + rnd.randrange(0, 30)
        rows.append((k, 1_704_067_200 + i * 97 + rnd.choice([0, 0, 400]), i, now[k]))
    return rows


def json_lines(rows):
    return "".join(json.dumps(dict(zip(("series_key", "s", "event_id", "counter"), r))) + "\n" for r in rows)


def as_stream(spark, src, home, entries):
    lines = T.tail(spark, src, f"{home}/progress/o.json", entries)
    row = lines.select(F.from_json("raw", "series_key string, s long, event_id long, counter long").alias("r")).select("r.*")
    return row.withColumn("event_ts", F.timestamp_seconds("s"))


def test_streamed_rates_equal_the_batch_operator(spark, scratch):
    """Resets, samples out of order, several micro-batches, a restart."""
    rows, src = samples(7), f"{scratch}/in"
    for name, part in (("a.log", rows[:350]), ("b.log", rows[350:])):
        put(src, name, json_lines(part))
        panes = SF.run_to_end(SF.rate_panes(as_stream(spark, src, scratch, 120), "series_key", "counter", "1 hour", "30 minutes"),
                              f"{scratch}/out", f"{scratch}/ck")
    end = panes.agg(F.max("pane")).first()[0]
    newest = max(r[1] for r in rows)
    assert end == (newest - 1800) // 3600 * 3600 * 1000 or end <= (newest - 1800) * 1000
    assert panes.groupBy("key", "pane").count().where("count > 1").count() == 0
    batch = spark.createDataFrame([(k, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s), i, v) for k, s, i, v in rows],
                                  "series_key string, ts timestamp_ntz, event_id long, counter long")
    until = F.lit(dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=end)).cast("timestamp_ntz")
    for hours in (1, 3, 10):
        want = {r.series_key: (r.increase, r.samples) for r in S.counter_rate(batch, hours * 3600, end=until).collect()}
        got = {r.series_key: (r.increase, r.samples) for r in SF.rates_from_panes(panes, "series_key", hours * 3600, F.lit(end)).collect()}
        assert got == want and got


def test_streamed_sliding_counts_equal_the_batch_operator(spark, scratch):
    """Gaps longer than a window, several micro-batches, a restart; every grid end once."""
    rows = [r for r in samples(9) if not 20_000 < r[1] - 1_704_067_200 < 45_000]
    rows.append(("late series", rows[-1][1] + 40_000, 9999, 1))
    src = f"{scratch}/in"
    for name, part in (("a.log", rows[:300]), ("b.log", rows[300:])):
        put(src, name, json_lines(part))
        out = SF.run_to_end(SF.sliding_counts(as_stream(spark, src, scratch, 100), "series_key", 7200, 1800, "30 minutes"),
                            f"{scratch}/out", f"{scratch}/ck")
    got = [(r.series_key, r.window_end, r.n) for r in out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")).collect()]
    batch = spark.createDataFrame([(k, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)) for k, s, _, _ in rows], "series_key string, ts timestamp_ntz")
    closed = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=rows[-1][1] - 1800)
    want = [(r.series_key, r.window_end, r.n) for r in S.count_sliding(batch, 7200, 1800).collect() if r.window_end < closed]
    assert sorted(got) == sorted(want)


def test_a_changed_table_gives_a_new_result(spark, scratch):
    os.makedirs(f"{scratch}/sf")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for half in (0, 1):
        part = f"{scratch}/half{half}"
        ev.where(F.col("event_id") % 2 == half).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.startswith("part-"))
        shutil.copy(f"{part}/{name}", f"{scratch}/sf/events.parquet")
        os.utime(f"{scratch}/sf/events.parquet", (1_000_000 + half, 1_000_000 + half))
        spark.catalog.refreshByPath(f"{scratch}/sf/events.parquet")
        got = catalog.stored_range_counts(spark, f"{scratch}/sf").agg(F.sum("samples")).first()[0]
        want = ev.where((F.col("event_id") % 2 == half) & (F.col("ts") > dt.datetime(2024, 1, 10, 6)) & (F.col("ts") <= dt.datetime(2024, 1, 12, 18))).count()
        assert got == want
    files = len(views._WRITTEN)
    catalog.stored_range_counts(spark, f"{scratch}/sf")
    assert len(views._WRITTEN) == files


def test_streamed_churn_equals_the_batch_operator(spark, scratch):
    rows = [r for r in samples(11) if not (r[0] == "a" and 12_000 < r[1] - 1_704_067_200 < 40_000)]
    rows.append(("late series", rows[-1][1] + 30_000, 9999, 1))
    src = f"{scratch}/in"
    for name, part in (("a.log", rows[:200]), ("b.log", rows[200:])):
        put(src, name, json_lines(part))
        out = SF.run_to_end(SF.series_changes(as_stream(spark, src, scratch, 90), "series_key", 1800, "30 minutes"), f"{scratch}/out", f"{scratch}/ck")
    closed = (rows[-1][1] - 1800) // 1800 * 1800
    batch = spark.createDataFrame([(k, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)) for k, s, _, _ in rows], "series_key string, ts timestamp_ntz")
    limit = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=closed)
    want = sorted(tuple(r) for r in S.series_churn(batch, 1800).collect() if r.interval_start < limit)
    assert sorted(tuple(r) for r in SF.churn_from_changes(out, 1800).collect()) == want


def test_space_saving_holds_the_heaviest_within_bounds(spark, scratch):
    """A skewed stream with far more keys than counters, several micro-batches and a restart."""
    rnd = random.Random(4)
    keys = [f"k{min(int(rnd.paretovariate(0.6)), 5000)}" for _ in range(9000)]
    src, true = f"{scratch}/in", {}
    for k in keys:
        true[k] = true.get(k, 0) + 1
    for name, part in (("a.log", keys[:5000]), ("b.log", keys[5000:])):
        put(src, name, "".join(f"{k}\n" for k in part))
        lines = T.tail(spark, src, f"{scratch}/progress/o.json", 1500)
        q = SF.heavy_hitters(lines, "raw", counters=40, parts=4).writeStream.outputMode("update").foreachBatch(
            FW.idempotent_writer([f"{scratch}/out"], "parquet")).option("checkpointLocation", f"{scratch}/ck").trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        q.stop()
    said = spark.read.parquet(f"{scratch}/out")
    last = said.groupBy("part").agg(*[F.max_by(c, "batch_id").alias(c) for c in ("items", "n", "error")])
    rows = {i: (n, e) for r in last.collect() for i, n, e in zip(r["items"], r["n"], r["error"])}
    assert len(true) > 400 and len(rows) == 160 and sum(n for n, _ in rows.values()) == len(keys)
    assert all(n - e <= true[i] <= n for i, (n, e) in rows.items())
    best = sorted(true, key=lambda k: (-true[k], k))
    assert all(k in rows for k in best[:10])
    top = SF.heaviest(last, 10).collect()
    assert len(top) == 10 and all(r.item in best[: len(top)] for r in top if r.sure) and any(r.sure for r in top)


def test_many_batches_of_a_micro_batch_are_told_apart(spark, scratch):
    """Several bounded batches in one micro-batch: ids, folders, counts, a replay, a rejected batch, a restart."""
    src, log = f"{scratch}/in", FW.commit_log(f"{scratch}/ck")
    put(src, "a.log", "".join(json.dumps({"timestamp": i, "n": i}) + "\n" for i in range(8)))
    put(src, "b.log", "".join(json.dumps({"timestamp": i, "n": i}) + "\n" for i in range(8, 15)) + "[1]\n" * 5)
    os.makedirs(f"{scratch}/a/batch_id=2")
    put(f"{scratch}/a/batch_id=2", "part-old.txt", "left by an attempt that failed\n")
    forward(spark, src, scratch, entries_per_batch=5, batches_per_trigger=3)
    put(src, "c.log", json.dumps({"timestamp": 15, "n": 15}) + "\n")
    forward(spark, src, scratch, entries_per_batch=5, batches_per_trigger=3)
    for sink in "ab":
        rows = commits.visible(spark, log, f"{scratch}/{sink}").collect()
        assert sorted((r.batch_id, json.loads(r.value)["n"]) for r in rows) == sorted((i // 5, i) for i in range(15)) + [(6, 15)]
    assert [r.batch_id for r in commits.visible(spark, log, f"{scratch}/dead").collect()] == [3] * 5
    sizes = commits.entries(spark, log).where("metric in ('entries', 'rejected')").groupBy("batch_id").agg(F.sum("lines").alias("n"))
    assert sorted((r.batch_id, r.n) for r in sizes.collect()) == [(0, 5), (1, 5), (2, 5), (3, 5), (6, 1)]
    # five batches took two micro-batches, a file of the log each, and one after the restart
    assert len([x for x in os.listdir(log) if x.startswith("batch-")]) == 3


def test_state_is_asked_for_once_a_part_and_churn_needs_no_keyed_state(spark, scratch):
    """A micro-batch of many series calls the stateful step once a part; changes come from native aggregates."""
    rows = [(f"s{i}", 1_704_067_200 + 60 * (i % 50), i, i) for i in range(2000)]
    src = f"{scratch}/in"
    put(src, "a.log", json_lines(rows))
    stream = as_stream(spark, src, scratch, 5000)
    plan = SF.series_changes(stream, "series_key", 1800, "30 minutes")._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan
    plan = SF.rate_panes(stream, "series_key", "counter", "1 hour", "30 minutes")._jdf.queryExecution().analyzed().toString()
    assert "pmod(xxhash64(key" in plan
