"""Telemetry views over the driver tables.

The driver tables hold no metrics, logs or spans, so each telemetry shape is
derived from them by a fixed rule (FIXTURES.md part B).  Every rule here is
mirrored column for column by the SQL in ``plans/oracle.py``.

* samples          events: series = (event_type, user_id), gauge value
* counter_samples  running sum of the value per series, ordered by (ts, event_id)
* log_lines        events rendered as JSON log lines (+ container-runtime prefix / plain lines)
* latencies        events: query key, latency_ms = value, success = not an error
* spans            lineitem: trace = order, batch tag from the order status
* exposition       events rendered as exposition-format lines of scrape pages
* service_obs      per-event observation of a service (= event_type) with
                   cumulative ingest counters, cpu and memory
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.keys import labels_map
from orrery.operators import sketches
from orrery.operators.sequence import choose_bucket_seconds, ordered, with_running_sum
from orrery.session import remove_at_end, scratch_path
from orrery.sources import runs
from orrery.sources.layout import write_partitioned
from orrery.sources.tables import read_table, table_path
from orrery.sources.tail import ENTRIES, tail
from orrery.sources.trace_results import read_results
from orrery.streaming import commits, stateful
from orrery.streaming.forwarder import commit_log, idempotent_writer, start_forwarder

# Fixed vocabulary of the bindings (also used by the oracle SQL).
METRIC_NAME = "event_value"
SERVICES = ["frontend", "checkout", "payment", "inventory", "shipping"]
SEVERITY_ERROR = "ERROR"
SEVERITY_DEFAULT = "INFO"


def _epoch_text(ts: str = "ts"):
    """Epoch seconds with 6 decimals as text, e.g. ``1704067207.179575``."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.format_string("%d.%06d", F.floor(us / 1_000_000).cast("long"), F.pmod(us, F.lit(1_000_000)))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    # Label keys are known here, so the canonical key (sorted by label name)
    # is a plain concat that stays inside whole-stage codegen.
    key = F.concat(
        F.lit(METRIC_NAME + '{event_type="'), F.col("event_type"),
        F.lit('",user_id="'), F.col("user_id").cast("string"), F.lit('"}'),
    )
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        F.lit(METRIC_NAME).alias("name"),
        labels_map({"event_type": "event_type", "user_id": "user_id"}).alias("labels"),
        key.alias("series_key"),
        F.col("value"),
    )


def counters_from(s: DataFrame, bucket_seconds: int = 86400, keep_bucket: bool = False) -> DataFrame:
    """Monotone counters: running decimal sum of the value per series.

    The counter stays decimal, so increases and their sums are exact.
    ``keep_bucket`` keeps the (series, day) partitioning column so a following
    ``counter_rate`` with the same bucket width reuses it without a shuffle.
    """
    return with_running_sum(
        s, ["series_key"], ["ts", "event_id"], F.col("value").cast("decimal(18,2)"), "counter", "ts",
        bucket_seconds, keep_bucket=keep_bucket,
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON log line per event plus the raw forms a log agent sees.

    ``line``: the JSON object.  ``raw``: what arrives on the stream — every
    10th event is plain text, every 3rd otherwise carries a container-runtime
    prefix before the JSON.  ``container``: stream path ``/<service>``.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    severity = F.when(F.col("event_type") == "error", F.lit(SEVERITY_ERROR)).otherwise(F.lit(SEVERITY_DEFAULT))
    service = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (F.col("user_id") % 5 + 1).cast("int"))
    line = F.concat(
        F.lit('{"timestamp":'), _epoch_text("ts"),
        F.lit(',"severity":"'), severity,
        F.lit('","service":"'), service,
        F.lit('","event_type":"'), F.col("event_type"),
        F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"msg":"event '), F.col("event_id").cast("string"),
        F.lit('","duration_ms":'), F.col("value").cast("decimal(18,2)").cast("string"),
        F.lit(',"props":'), F.col("props"),
        F.lit("}"),
    )
    iso = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    # Shapes a real stream has, by event id: odd times, types, broken JSON,
    # white space that is no blank, blank lines, JSON that is no object.
    plain = F.concat(F.lit("plain text event "), F.col("event_id").cast("string"))
    tail = F.regexp_replace(line, r'^\{"timestamp":[^,]*', "")
    shape = F.col("event_id") % 40
    raw = (
        F.when(shape == 7, F.concat(F.lit('{"timestamp":"'), iso, F.lit('"'), tail))
        .when(shape == 11, F.substr(line, F.lit(1), F.length(line) - 1))
        .when(shape == 13, F.concat(line, F.lit(" trailing")))
        .when(shape == 17, F.concat(
            F.substr(line, F.lit(1), F.length(line) - 1),
            F.lit(',"ok":true,"big":123456789012345678901234567890,"none":null,"deep":{"a":[1,2.50,"x"]}}')))
        .when(shape == 19, F.replace(line, F.lit('"'), F.lit("'")))
        .when(shape == 23, F.lit("\t \r"))
        .when(shape == 29, F.concat(F.lit('{"_time":"'), iso, F.lit('","timestamp":1'), tail))
        .when(shape == 31, F.lit("[1, 2]"))
        .when(shape == 37, F.concat(F.lit('\t{"level":"none"}\r')))
        .when(shape == 20, F.concat(F.lit("\t"), plain, F.lit("\r")))
        .when(F.col("event_id") % 10 == 0, plain)
        .when(F.col("event_id") % 3 == 0, F.concat(iso, F.lit(" stdout F "), line))
        .otherwise(line)
    )
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        severity.alias("severity"), service.alias("service"),
        line.alias("line"), raw.alias("raw"),
        F.concat(F.lit("/"), service).alias("container"),
    )


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("query_key"),
        F.col("value").alias("latency_ms"),
        (F.col("event_type") != "error").alias("success"),
    )


#: Span rows of a task that holds them by trace.
TASK_SPANS = 1_250_000


def span_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for spans dealt by trace: they grow with the rows (counted in
    the files' footers), so that what a task sorts or groups does not."""
    rows = read_table(spark, sf_dir, "lineitem", []).count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_SPANS))


def spans(spark: SparkSession, sf_dir: str, with_batch: bool = False, tasks: int | None = None) -> DataFrame:
    """Span rows from lineitem (trace = order).

    ``with_batch`` adds the ``test.batch`` attribute from the order status,
    which needs a join with orders on the order key; queries that do not use
    it do not pay for that join.  ``tasks`` (``span_tasks``) deals the rows, and
    the orders, to that many partitions by trace id before anything else: joins,
    searches and groups by trace need no other shuffle, and AQE, which goes by
    compressed bytes, does not put the partitions together again.
    """
    li = read_table(
        spark, sf_dir, "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"],
    ).withColumn("trace_id", F.col("l_orderkey").cast("string"))
    if tasks:
        li = li.repartition(tasks, "trace_id")
    if with_batch and tasks:
        orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"]).select(
            F.col("o_orderkey").cast("string").alias("_order"), "o_orderstatus").repartition(tasks, "_order")
        li = li.join(orders, F.col("trace_id") == F.col("_order"), "left")
    elif with_batch:
        orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
        li = li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
    batch = [F.lit("test.batch"), F.col("o_orderstatus")] if with_batch else []
    service = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (F.col("l_partkey") % 5 + 1).cast("int"))
    return li.select(
        "trace_id",
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        service.alias("service"),
        F.create_map(
            F.lit("benchmark_app"), F.lit("orders"),
            F.lit("return.flag"), F.col("l_returnflag"),
            F.lit("line.status"), F.col("l_linestatus"),
            F.lit("Benchmark.Status"), F.col("l_linestatus"),
            F.lit("service.name"), service,
            *batch,
        ).alias("attrs"),
        F.col("l_shipdate").alias("start"),
    )


#: Folders of files derived from a set of tables, by application, kind and the
#: state of the tables: queries over the same files share them.
_WRITTEN: dict[tuple[str, str, str, str], str] = {}


def table_state(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """Names, lengths and times of the tables' files."""
    jvm, out = spark._jvm, []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, t))
        out += sorted(f.toString() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))
    return "\n".join(out)


def _written(spark: SparkSession, kind: str, sf_dir: str, write: Callable[[str], None], tables: Sequence[str] = ("events",)) -> str:
    """Folder of what ``write`` makes of the tables, made once while they stay as
    they are and removed when the application ends."""
    key = (spark.sparkContext.applicationId, kind, sf_dir, table_state(spark, sf_dir, *tables))
    if key not in _WRITTEN:
        path = scratch_path(spark, f"tables/{kind}-{uuid.uuid4().hex}")
        remove_at_end(spark, path)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def forget_written() -> None:
    """Files are made anew from now on (the bench counts their making)."""
    _WRITTEN.clear()


#: Lines of a scrape page, about.
PAGE_LINES = 1_000


def exposition_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the scrape pages as files, bounded scrapes: as many a service and
    day as the table needs for pages of about PAGE_LINES lines, lines dealt by id."""
    lines = exposition_lines(spark, sf_dir).select("service", F.date_format("scrape_ts", "yyyy-MM-dd").alias("day"), "line_no", "line")

    def write(path: str) -> None:
        most = lines.groupBy("service", "day").count().agg(F.max("count")).first()[0] or 0
        page = F.pmod(F.xxhash64("line_no"), F.lit(max(1, -(-most // PAGE_LINES))))
        dealt = lines.withColumn("page", page).repartition("service", "day", "page").sortWithinPartitions("service", "day", "page", "line_no")
        dealt.drop("line_no").write.partitionBy("service", "day", "page").text(path)

    return _written(spark, "pages", sf_dir, write)


def event_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the events as files, for a stream to read."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return _written(spark, "events", sf_dir, ev.write.parquet)


def sunk(spark: SparkSession, kind: str, sf_dir: str, stream: Callable[[], DataFrame]) -> DataFrame:
    """What a streaming query has in its sink (Parquet, append) after a run over
    all there is; it and its checkpoint lie under the shared folder."""

    def run(path: str) -> None:
        remove_at_end(spark, f"{path}-checkpoint")
        writer = stream().writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-checkpoint")
        writer.trigger(availableNow=True).start(path).awaitTermination()

    return spark.read.parquet(_written(spark, f"sink-{kind}", sf_dir, run))


def _until_done(query) -> None:
    try:
        query.processAllAvailable()
    finally:
        query.stop()


#: Batches of 2,500 lines that a micro-batch of a forwarder takes.
TOGETHER = 200


def forwarder_run(spark: SparkSession, sf_dir: str, since: float) -> str:
    """Folder of a run of the forwarder (strict parse, entries from ``since`` on)
    over the raw lines, at most 2,500 a batch, into two sinks: the lines of
    two thirds of the events first, then, after a restart on the same checkpoint,
    the others."""
    lines = log_lines(spark, sf_dir).select("event_id", "raw")

    def run(home: str) -> None:
        for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
            lines.where(part).select("raw").write.mode("append").text(f"{home}/in")
            _until_done(start_forwarder(spark, f"{home}/in", [f"{home}/a", f"{home}/b"], f"{home}/checkpoint", strict=True, since=since,
                                        dead_letter=f"{home}/dead", entries_per_batch=ENTRIES, batches_per_trigger=TOGETHER))

    return _written(spark, "forwarder", sf_dir, run)


def forwarder_sinks(spark: SparkSession, sf_dir: str, since: float) -> tuple[dict[str, DataFrame], DataFrame]:
    """What that run committed: rows of the sinks ``a``, ``b`` and ``dead``, and its log."""
    home = forwarder_run(spark, sf_dir, since)
    log = commit_log(f"{home}/checkpoint")
    return {k: commits.visible(spark, log, f"{home}/{k}") for k in ("a", "b", "dead")}, commits.entries(spark, log)


def tail_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a forwarder delivers that starts when two thirds of the lines are
    there: the lines that come after its start (S9)."""
    lines = log_lines(spark, sf_dir).select("event_id", "raw")

    def run(home: str) -> None:
        lines.where("event_id % 3 <> 0").select("raw").write.text(f"{home}/in")
        for more in ("event_id % 3 = 0", "false"):  # the second start resumes; it doesn't skip again
            _until_done(start_forwarder(spark, f"{home}/in", [f"{home}/a"], f"{home}/checkpoint", entries_per_batch=10 * ENTRIES,
                                        batches_per_trigger=TOGETHER // 10, from_end=True))
            lines.where(more).select("raw").write.mode("append").text(f"{home}/in")

    home = _written(spark, "from-now", sf_dir, run)
    return commits.visible(spark, commit_log(f"{home}/checkpoint"), f"{home}/a")


#: Micro-batches that a run over lines in order of time is cut into.
ORDERED_BATCHES = 6


#: Lines of a micro-batch that a partition of the state is for, about: opening and
#: committing one takes as long whether it holds something or not.
STATE_LINES = 50_000


def _share(spark: SparkSession, path: str) -> int:
    """Lines of one of ORDERED_BATCHES micro-batches over the text files, counted there."""
    return -(-spark.read.text(path).count() // ORDERED_BATCHES) or 1


@contextmanager
def _state_partitions(spark: SparkSession, entries: int) -> Iterator[None]:
    """As many shuffle partitions as the state of such micro-batches is worth, one a
    core at least and the session's number at most (a stream keeps the number that
    it starts with)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), max(spark.sparkContext.defaultParallelism, -(-entries // STATE_LINES)))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ordered_stream(spark: SparkSession, kind: str, sf_dir: str, rows: DataFrame, order: Sequence[str], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The Parquet sink of a streaming run over ``rows``, written as JSON lines in
    ``order`` and tailed in ORDERED_BATCHES micro-batches."""

    def run(home: str) -> None:
        rows.orderBy(*order).select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(f"{home}/in")
        entries = _share(spark, f"{home}/in")
        lines = tail(spark, f"{home}/in", f"{home}/progress/offset.json", entries)
        parsed = lines.select(F.from_json("raw", rows.schema).alias("r")).select("r.*")
        with _state_partitions(spark, entries):
            stateful.run_to_end(make(parsed), f"{home}/out", f"{home}/checkpoint")

    return spark.read.parquet(f"{_written(spark, kind, sf_dir, run)}/out")


def updated(spark: SparkSession, kind: str, sf_dir: str, rows: DataFrame, order: Sequence[str], make: Callable[[DataFrame], DataFrame],
            keys: Sequence[str]) -> DataFrame:
    """What a streaming query in update mode has said last of every key, after
    ORDERED_BATCHES micro-batches over ``rows``: each batch's updates are a folder
    of the sink, written again whole on a replay."""

    def run(home: str) -> None:
        rows.orderBy(*order).select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(f"{home}/in")
        entries = _share(spark, f"{home}/in")
        lines = tail(spark, f"{home}/in", f"{home}/progress/offset.json", entries)
        parsed = lines.select(F.from_json("raw", rows.schema).alias("r")).select("r.*")
        write = idempotent_writer([f"{home}/out"], "parquet")
        with _state_partitions(spark, entries):
            _until_done(make(parsed).writeStream.outputMode("update").foreachBatch(write).option(
                "checkpointLocation", f"{home}/checkpoint").trigger(processingTime="0 seconds").start())

    said = spark.read.parquet(f"{_written(spark, kind, sf_dir, run)}/out")
    others = [c for c in said.columns if c not in (*keys, "batch_id")]
    return said.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in others])


def stored_sketches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored per day: quantile sketches of the values by type, and sketches of the users."""
    ev = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"]).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))

    def run(home: str) -> None:
        sketches.quantile_sketch(ev, ["day", "event_type"], "value").write.parquet(f"{home}/quantiles")
        sketches.distinct_sketch(ev, ["day"], "user_id").write.parquet(f"{home}/users")

    home = _written(spark, "sketches", sf_dir, run)
    return spark.read.parquet(f"{home}/quantiles"), spark.read.parquet(f"{home}/users")


def closed_end(spark: SparkSession, sf_dir: str, pane_seconds: int, late_ms: int = 3_600_000) -> Column:
    """End (milliseconds) of the last pane that the final watermark of a stream of the events has closed."""
    newest = read_table(spark, sf_dir, "events", ["ts"]).select(
        F.floor((F.unix_micros(F.max("ts").cast("timestamp")) - 1) / 1000) - late_ms)
    pane = pane_seconds * 1000
    return F.floor(newest.scalar() / pane) * pane


def stored_samples(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the samples in the date-partitioned layout."""
    s = samples(spark, sf_dir).select("series_key", "ts", "event_type", "value")
    return _written(spark, "stored", sf_dir, lambda path: write_partitioned(s, path, rows_per_file=200))


#: Services of the runs, by what they store.
RUN_SERVICES = {"metrics": ["metrics_store"], "logs": ["logs_store"], "traces": ["traces_store"]}


def run_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, before and from 2024-01-16, with an observation per day: what
    the day's events of each type say about three services and their queries."""
    day = F.date_trunc("day", F.col("ts"))
    ev = read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    kinds = ["click", "view", "signup", "purchase", "error"]
    d = ev.groupBy(day.alias("day")).agg(
        *[F.count_if(F.col("event_type") == k).alias(k) for k in kinds], F.max("value").alias("top"), F.min("value").alias("low"))
    run = F.when(F.col("day") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit("run_a")).otherwise(F.lit("run_b"))
    odd = F.dayofmonth("day") % 2 == 1

    def service(cpu: Column, memory: Column, storage: Column, **ingest: Column) -> Column:
        kept = F.struct(*[(ingest[f.name].cast("double") if f.name in ingest else F.lit(None).cast("double")).alias(f.name)
                          for f in runs.INGEST.fields])
        return F.struct(
            F.struct((cpu % 100 + 0.5).alias("cpu_percent"), (memory * 1048576).alias("memory_bytes"),
                     F.lit(1.0).alias("memory_percent")).alias("docker_stats"),
            F.create_map(F.lit("up"), F.lit(1.0)).alias("metrics"), kept.alias("ingest_metrics"),
            storage.cast("long").alias("storage_size_bytes"))

    def query(latency: Column, success: Column, traces: Column, spans: Column) -> Column:
        return F.struct(latency.alias("latency_ms"), success.alias("success"), F.lit(None).cast("string").alias("error"),
                        traces.cast("long").alias("trace_count"), spans.cast("long").alias("span_count"))

    c = {k: F.col(k) for k in kinds}
    none = F.lit(None).cast("long")
    # the first ingest counter is 0 on some days and missing for logs, so its fallback counts (P20)
    services = F.create_map(
        F.lit("metrics_store"), service(c["click"], c["view"], c["click"] * 1000,
                                        samples_ingested=F.when(odd, 0).otherwise(c["click"] * 10), samples_appended=c["click"] * 20,
                                        samples_dropped=c["error"]),
        F.lit("logs_store"), service(c["view"], c["click"], F.lit(0), rows_ingested=c["signup"] * 7, lines_dropped=c["error"] * 2),
        F.lit("traces_store"), service(c["signup"], c["purchase"], c["purchase"] * 37 + 5,
                                       spans_received=c["purchase"] * 3, spans_dropped=c["view"] % 5))
    queries = F.create_map(
        F.lit("metrics_store:topk"), query(F.col("top"), c["error"] % 3 != 0, none, none),
        F.lit("logs_store:count"), query(F.col("low"), c["error"] % 4 != 0, none, none),
        F.lit("traces_store:traces_by_label"), query(F.col("top") - F.col("low"), F.lit(True), c["view"], F.lit(0)))
    load = F.create_map(F.lit("series_total"), c["click"] * 1000.0, F.lit("metrics_series"), c["view"] * 10.0, F.lit("log_lines"), c["signup"] * 5000.0,
                        F.lit("log_rate"), c["signup"] + 0.25, F.lit("traces_spans"), c["purchase"] * 1.0, F.lit("spans_rate"), c["purchase"] + 0.75)
    return d.select(
        run.alias("run_id"), (F.unix_micros(F.col("day").cast("timestamp")) / 1e6).alias("timestamp"),
        F.when(odd, F.lit("steady")).otherwise(F.lit("burst")).alias("scenario"), load.alias("load_volume"),
        services.alias("services"), queries.alias("queries"))


def run_artifacts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(manifests, observations) of both runs, written as files, the second run
    after the first, and read back."""
    def write(root: str) -> None:
        obs = run_observations(spark, sf_dir)
        for run in ("run_a", "run_b"):
            mine = obs.filter(F.col("run_id") == run)
            runs.write_run(mine, runs.manifests(mine, "2024-02-01T00:00:00"), root)

    root = _written(spark, "runs", sf_dir, write)
    return runs.read_manifests(spark, root), runs.read_observations(spark, root)


#: Orders of one trace-search response.
RESPONSE_ORDERS = 2000


def trace_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace-search responses written as JSON files and read back, one response
    per range of order keys, one trace per order, one span per line.

    Every second response keeps its traces under ``data`` and has whole span
    lists; every fifth has an empty ``data`` besides ``traces``; traces of every
    seventh order have no span list.  A trace has two processes: both tags sit on
    the first if the order is finished and the response isn't every third, else
    they are split over the two.
    """
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey"]).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    r = F.floor(F.col("o_orderkey") / RESPONSE_ORDERS)
    whole = r % 2 == 0

    def tag(k: str, v: str) -> Column:
        return F.struct(F.lit(k).alias("key"), F.lit(v).alias("value"))

    app, run = tag("benchmark_app", "orders"), tag("benchmark_run_id", "r1")
    both = (F.col("o_orderstatus") == "F") & (r % 3 != 0)
    first = F.struct(F.when(both, F.array(app, run)).otherwise(F.array(app)).alias("tags"))
    second = F.struct(F.when(both, F.array(tag("other", "x"))).otherwise(F.array(run)).alias("tags"))
    n = F.when(F.col("o_orderkey") % 7 == 0, 0).otherwise(F.coalesce("n", F.lit(0))).cast("int")
    trace = F.struct(
        F.col("o_orderkey").cast("string").alias("traceID"),
        F.array_repeat(F.struct(F.lit("s").alias("spanID")), n).alias("spans"),
        F.when(~whole & (F.col("o_orderstatus") == "F"), 3).when(~whole & (F.col("o_orderstatus") == "O"), 0).alias("spanCount"),
        F.create_map(F.lit("p1"), first, F.lit("p2"), second).alias("processes"),
    )
    kept = rows.select(r.alias("r"), trace.alias("t")).groupBy("r").agg(F.collect_list("t").alias("t"))
    none = F.array().cast(kept.schema["t"].dataType)
    body = F.when(F.col("r") % 2 == 0, F.to_json(F.struct(F.col("t").alias("data")))).when(
        F.col("r") % 5 == 0, F.to_json(F.struct(none.alias("data"), F.col("t").alias("traces")))).otherwise(
        F.to_json(F.struct(F.col("t").alias("traces"))))
    path = _written(spark, "responses", sf_dir, kept.select(body.alias("value"), F.col("r")).write.partitionBy("r").text, ("orders", "lineitem"))
    named = F.regexp_extract("response", r"/r=(\d+)/", 1).cast("long")
    return read_results(spark, path).withColumn("response", named)


def exposition_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape pages as lines: (service, scrape_ts, line_no, line).

    A page per (service, day); line_no is the event id.  Every 50th event is
    a comment, the next a blank line, the next an unparsable value; labels
    include a value with a space.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    service = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (F.col("user_id") % 5 + 1).cast("int"))
    name = F.concat(F.lit("events_"), F.col("event_type"), F.lit("_total"))
    labels = F.concat(
        F.lit('{user_id="'), F.col("user_id").cast("string"),
        F.lit('",zone="zone '), (F.col("user_id") % 3).cast("string"), F.lit('"}'),
    )
    m = F.col("event_id") % 50
    line = (
        F.when(m == 0, F.concat(F.lit("# HELP "), name, F.lit(" events seen")))
        .when(m == 1, F.lit(""))
        .when(m == 2, F.concat(name, labels, F.lit(" nope")))
        .otherwise(F.concat(name, labels, F.lit(" "), F.col("value").cast("decimal(18,2)").cast("string")))
    )
    return ev.select(
        service.alias("service"),
        F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("scrape_ts"),
        F.col("event_id").alias("line_no"),
        line.alias("line"),
    )


#: Bucket widths by application and the state of the table.
_WIDTHS: dict[tuple[str, str], int] = {}


def bucket_width(spark: SparkSession, sf_dir: str) -> int:
    """Width of the time buckets that series of ``events`` are cut into, from the
    density of the hottest event type (every series lies within one), measured
    once while the table stays as it is."""
    key = (spark.sparkContext.applicationId, table_state(spark, sf_dir, "events"))
    if key not in _WIDTHS:
        _WIDTHS[key] = choose_bucket_seconds(read_table(spark, sf_dir, "events", ["event_type", "ts"]), ["event_type"], "ts")
    return _WIDTHS[key]


def service_obs(spark: SparkSession, sf_dir: str, previous: Sequence[str] = (), bucket_seconds: int | None = None,
                counters: bool = True) -> DataFrame:
    """Observation rows per service (= event_type) at each event time.

    ingested: cumulative events of the service; dropped: cumulative events
    with value > 400; cpu_percent = value % 100; memory_bytes = value MiB.
    ``previous`` adds columns of the service's previous observation; without
    ``counters`` there are neither, and nothing is put in order.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    base = ev.select(
        "event_id", "ts", F.col("event_type").alias("service"), "value",
        F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit("steady"))
        .otherwise(F.lit("burst")).alias("scenario"),
    )
    if counters:
        # Five services share all rows: each is a hot key, cut by time bucket.
        sums = {"ingested": F.lit(1).cast("long"), "dropped": F.when(F.col("value") > 400, 1).otherwise(0).cast("long")}
        base = ordered(base, ["service"], ["ts", "event_id"], "ts", sums, previous, bucket_seconds or bucket_width(spark, sf_dir))
    return base.select(
        "event_id", "ts", "service", "scenario", *(["ingested", "dropped"] if counters else []),
        (F.col("value") % 100).alias("cpu_percent"),
        (F.col("value") * F.lit(1048576.0)).cast("long").alias("memory_bytes"),
        *[f"prev_{c}" for c in previous],
    )
