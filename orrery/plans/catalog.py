"""Registered queries: one Spark plan per operator group, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in ``plans/oracle.py``.  Parameters
(windows, labels, needles) are fixed here and mirrored there.

Floating-point aggregates whose result depends on summation order (means of
doubles) are rounded to 6 decimals in both the query and the oracle; sums of
two-decimal values are computed in decimal so they are exact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.keys import known_series_key, modulo_label, pick_label
from orrery.functions.numeric import cpu_percent, memory_percent
from orrery.functions.numeric import relative_difference as rel_diff
from orrery.functions.text import format_bytes, truncate, utf8_repair
from orrery.operators import logs as L
from orrery.operators import reconcile as RC
from orrery.operators import report as R
from orrery.operators import series as S
from orrery.operators import sketches as SK
from orrery.operators import traces as T
from orrery.plans import views as V
from orrery.sources import exposition as X
from orrery.sources import layout as LY
from orrery.sources import runs as RN
from orrery.sources import trace_results as TR
from orrery.sources.tables import read_table
from orrery.streaming import stateful as SF
from orrery.streaming import windows as W

# Label derivation of the reference's metric generator, in its
# order.  Each rule is (label, value prefix, modulus of the series index);
# env picks from a list by index modulo its length.
BASE_LABEL_RULES = [("job", "test-job-", 10), ("instance", "instance-", 100)]
HIGH_CARDINALITY_LABEL_RULES = [
    ("host", "host-", 1000),
    ("pod", "pod-", 5000),
    ("region", "region-", 10),
    ("version", "v", 20),
    ("customer", "customer-", 100),
    ("env", ["prod", "staging", "dev"], 3),
    ("team", "team-", 50),
]

DAY = 86400
WEEK = 7 * DAY
HIST_BOUNDS = [10.0, 50.0, 100.0, 250.0, 500.0]
SERVICE_CLASSES = {"Samples": ["click", "view"], "Lines": ["signup", "purchase"], "Spans": ["error"]}
KNOWN_SERVICES = ["click", "purchase", "view"]


def _r6(c):
    return F.round(c, 6)


# ----------------------------------------------------------------- series
def topk_latest(spark: SparkSession, sf: str) -> DataFrame:
    return S.topk_latest(V.samples(spark, sf), k=10, seconds=WEEK, labels={"event_type": "click"})


def topk_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: top 10 series by counter rate over the last week."""
    samples = V.samples(spark, sf)
    # Series-local filter first: a counter only depends on its own series.
    width = V.bucket_width(spark, sf)
    counters = V.counters_from(samples.filter(F.col("event_type") == "purchase"), width, keep_bucket=True)
    return S.topk_rate(counters, k=10, seconds=WEEK, bucket_seconds=width, anchor=samples)


def rate_per_series(spark: SparkSession, sf: str) -> DataFrame:
    samples = V.samples(spark, sf)
    width = V.bucket_width(spark, sf)
    return S.counter_rate(V.counters_from(samples, width, keep_bucket=True), WEEK, bucket_seconds=width, anchor=samples)


def count_over_time_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return S.count_tumbling(V.samples(spark, sf), DAY)


def count_over_time_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return S.count_sliding(V.samples(spark, sf), DAY, 6 * 3600)


def count_over_time_last_step_total(spark: SparkSession, sf: str) -> DataFrame:
    """A2, failing loudly when nothing was counted."""
    t = S.count_last_step_total(V.samples(spark, sf), 2 * DAY, 3600)
    return R.nonzero_or_fail(t, "total", "range count returned 0 samples")


def count_over_time_plain_total(spark: SparkSession, sf: str) -> DataFrame:
    return S.count_last_step_total(V.samples(spark, sf), 2 * DAY, 3600, mode="plain")


def series_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return S.series_cardinality(V.samples(spark, sf), by=["event_type"])


def series_churn(spark: SparkSession, sf: str) -> DataFrame:
    return S.series_churn(V.samples(spark, sf), DAY)


def histogram_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return S.histogram_buckets(V.samples(spark, sf), HIST_BOUNDS)


INF = float("inf")
ODD_BOUNDS = [25.0, 100.0, 300.0, INF]


def histogram_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Median and p90 per type, by interpolation in the merged buckets of
    series whose bounds differ (those of odd users have their own)."""
    s = V.samples(spark, sf).withColumn("series_key", F.concat_ws("|", "event_type", F.col("user_id").cast("string")))
    odd = F.col("user_id") % 2 == 1
    both = S.histogram_buckets(s.where(~odd), [*HIST_BOUNDS, INF]).unionByName(S.histogram_buckets(s.where(odd), ODD_BOUNDS))
    merged = S.merged_buckets(both.withColumn("event_type", F.split_part("series_key", F.lit("|"), F.lit(1))), ["event_type"])
    p50 = S.histogram_quantile(merged, 0.5, ["event_type"]).select("event_type", _r6(F.col("quantile")).alias("p50"), F.col("count").cast("long").alias("n"))
    p90 = S.histogram_quantile(merged, 0.9, ["event_type"]).select("event_type", _r6(F.col("quantile")).alias("p90"))
    return p50.join(p90, "event_type")


SKETCH_DAYS = ("2024-01-05", "2024-01-20")


def quantiles_merged(spark: SparkSession, sf: str) -> DataFrame:
    """A11 + A12 from stored sketches: quantiles of the values per type over
    sixteen days, without the samples."""
    stored = V.stored_sketches(spark, sf)[0].where(F.col("day").between(*map(F.lit, SKETCH_DAYS)))
    got = SK.merged_quantiles(stored, ["event_type"], {"p50": (1, 2), "p90": (9, 10), "p99": (99, 100)})
    return got.select("event_type", "n", *[_r6(F.col(c)).alias(c) for c in ("p50", "p90", "p99")])


def cardinality_merged(spark: SparkSession, sf: str) -> DataFrame:
    """A19 from stored sketches: for weeks, thirds of a month and months the exact
    number of users, and whether the merged estimate is within its bound."""
    def periods(day: Column) -> Column:
        month = F.substring(day, 1, 7)
        return F.explode(F.array(
            F.concat(F.lit("month "), month), F.concat(F.lit("week "), F.weekofyear(day.cast("date")).cast("string")),
            F.concat(F.lit("third "), month, F.lit(" "), F.floor((F.dayofmonth(day.cast("date")) - 1) / 10).cast("string")))).alias("period")

    estimates = SK.merged_distinct(V.stored_sketches(spark, sf)[1].select(periods(F.col("day")), "sketch"), ["period"])
    ev = read_table(spark, sf, "events", ["ts", "user_id"])
    active = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id").distinct()
    exact = active.select(periods(F.col("day")), "user_id").groupBy("period").agg(F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("series") - F.col("users")) / F.col("users")
    return exact.join(estimates, "period").select("period", "users", (off <= SK.distinct_error()).alias("within_bound"))


def label_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    """P10 + P9 + A19: label sets derived from event ids in base and
    high-cardinality mode, distinct canonical keys per mode."""
    ev = read_table(spark, sf, "events", ["event_id"])
    i = F.col("event_id")

    def derive(rules):
        out = {}
        for label, rule, mod in rules:
            out[label] = pick_label(i, rule) if isinstance(rule, list) else modulo_label(i, rule, mod)
        return out

    base = {**derive(BASE_LABEL_RULES), "benchmark_app": F.lit("events")}
    high = {**base, **derive(HIGH_CARDINALITY_LABEL_RULES)}

    def keyed(mode, labels):
        return F.struct(F.lit(mode).alias("mode"), known_series_key(F.lit("test_metric"), labels).alias("series_key"))

    both = ev.select(F.inline(F.array(keyed("base", base), keyed("high_cardinality", high))))
    return S.series_cardinality(both, by=["mode"])


# ------------------------------------------------------------------- logs
_LOG_FIELDS = {"service": "payment", "event_type": "error"}


def log_error_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = L.error_lines(V.log_lines(spark, sf), "payment", _LOG_FIELDS, "ERROR")
    return lines.select("event_id", "ts", "line")


def log_window_count(spark: SparkSession, sf: str) -> DataFrame:
    """A6, failing loudly when nothing matched."""
    logs = V.log_lines(spark, sf)
    n = L.window_count(logs, *S.range_bounds(logs, WEEK), {"severity": "ERROR"})
    return R.nonzero_or_fail(n, "n", "log window count returned 0 lines")


def log_latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 100 error lines of one stream (a limit is the feature)."""
    sel = L.json_fields_equal(L.relabel_streams(V.log_lines(spark, sf), keep_service="checkout"),
                              {"severity": "ERROR"})
    return S.newest(sel.select("event_id", "ts", "line"), 100)


def _logs_arrival(spark, sf):
    logs = V.log_lines(spark, sf)
    return logs, F.col("ts")


def log_parse_lenient(spark: SparkSession, sf: str) -> DataFrame:
    logs, arrival = _logs_arrival(spark, sf)
    p = L.parse_lenient(logs.select("event_id", "ts", "raw"), "raw", arrival)
    return p.select("event_id", "is_json", "_msg", "_time", _r6(F.col("event_time")).alias("event_time"),
                    F.col(L.PARSED_FIELDS)["severity"].alias("severity"))


def log_entry_payload(spark: SparkSession, sf: str) -> DataFrame:
    """K1: the JSON text delivered for every line, types and times as they came."""
    logs, arrival = _logs_arrival(spark, sf)
    p = L.parse_lenient(logs.select("event_id", "ts", "raw"), "raw", arrival)
    return p.select("event_id", L.payload(p).alias("payload"))


def log_parse_strict(spark: SparkSession, sf: str) -> DataFrame:
    logs, arrival = _logs_arrival(spark, sf)
    p = L.parse_strict(logs.select("event_id", "ts", "raw"), "raw", arrival)
    return p.select("event_id", "is_json", "_msg", "_time", _r6(F.col("event_time")).alias("event_time"),
                    F.col(L.PARSED_FIELDS)["severity"].alias("severity"))


def log_stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    return L.stream_counts(V.log_lines(spark, sf), DAY, DAY)


def log_range_count_total(spark: SparkSession, sf: str) -> DataFrame:
    logs = V.log_lines(spark, sf)
    sel = L.json_fields_equal(L.relabel_streams(logs), {"severity": "ERROR"})
    t = L.range_count_total(sel, DAY, 3600, stream=["container_label"], range_seconds=6 * 3600, anchor=logs)
    return R.nonzero_or_fail(t, "total", "log range count returned 0 lines")


# ------------------------------------------------------------- exposition
_PAGE = ["service", "scrape_ts"]


def exposition_sum(spark: SparkSession, sf: str) -> DataFrame:
    s = X.metric_sums(V.exposition_lines(spark, sf), _PAGE)
    return s.select(*_PAGE, "name", _r6(F.col("value")).alias("value"))


def exposition_pages_sum(spark: SparkSession, sf: str) -> DataFrame:
    """S11 + S1: the pages as landed files, each a bounded scrape, read whole,
    split into lines and summed by service and day."""
    pages = X.read_pages(spark, V.exposition_files(spark, sf))
    part = lambda k: F.regexp_extract("page", rf"/{k}=([^/]+)/", 1).alias(k)
    lines = X.pages_to_lines(pages.select(part("service"), part("day"), "text"))
    s = X.metric_sums(lines, ["service", "day"])
    return s.select("service", "day", "name", _r6(F.col("value")).alias("value"))


def exposition_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """S1 in labelled mode: label sets parsed into maps, summed per series."""
    s = X.series_sums(V.exposition_lines(spark, sf), _PAGE)
    return s.select(*_PAGE, "series_key", _r6(F.col("value")).alias("value"))


def exposition_selected(spark: SparkSession, sf: str) -> DataFrame:
    s = X.selected_sums(V.exposition_lines(spark, sf), _PAGE, ("events_click_total", "zone 1"),
                        ("events_error_total", "zone 2"))
    # int() of the float totals; rounding to 6 places first keeps the
    # truncation independent of summation order.
    return s.select(*_PAGE, *[_r6(F.col(c)).cast("long").alias(c) for c in ("ingested", "dropped")])


def exposition_first(spark: SparkSession, sf: str) -> DataFrame:
    return X.matched_value(V.exposition_lines(spark, sf), _PAGE, 'zone="zone 2"', "first")


def exposition_last(spark: SparkSession, sf: str) -> DataFrame:
    return X.matched_value(V.exposition_lines(spark, sf), _PAGE, 'zone="zone 2"', "last")


def exposition_active_series(spark: SparkSession, sf: str) -> DataFrame:
    return X.active_series(V.exposition_lines(spark, sf), _PAGE, "events_")


def exposition_named(spark: SparkSession, sf: str) -> DataFrame:
    s = X.metric_sums(V.exposition_lines(spark, sf), _PAGE)
    n = X.named_metrics(s, _PAGE, ["events_click_total", "events_view_total", "events_missing_total"])
    return n.select(*_PAGE, *[_r6(F.col(c)).alias(c) for c in n.columns if c not in _PAGE])


def exposition_drop_prefix_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A14 + A15: drops = sum of metrics with a name prefix, plus a second counter."""
    s = X.metric_sums(V.exposition_lines(spark, sf), _PAGE)
    d = X.total_drops(s, _PAGE, "events_error", "events_signup_total")
    return d.select(*_PAGE, _r6(F.col("drops")).alias("drops"))


# ----------------------------------------------------------------- traces
def trace_span_counts(spark: SparkSession, sf: str) -> DataFrame:
    found = T.tag_search(V.spans(spark, sf, tasks=V.span_tasks(spark, sf)), "return.flag=R line.status=F")
    return T.trace_counts(found)


def trace_service_tag_search(spark: SparkSession, sf: str) -> DataFrame:
    spans = V.spans(spark, sf, tasks=V.span_tasks(spark, sf))
    found = T.service_tag_search(spans, "payment", '{"return.flag":"A","benchmark_app":"orders"}')
    return T.trace_counts(found)


def trace_field_search(spark: SparkSession, sf: str) -> DataFrame:
    # every span of an order has the order's batch: a span that matches stands for
    # its whole trace, and the condition reaches the orders before the join
    spans = V.spans(spark, sf, with_batch=True, tasks=V.span_tasks(spark, sf))
    return T.trace_counts(spans.filter(T.has_field("test.batch", "P")))


def reconcile_expected_found(spark: SparkSession, sf: str) -> DataFrame:
    tasks = V.span_tasks(spark, sf)
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]).repartition(tasks, "o_orderkey")
    expected = orders.groupBy(F.col("o_orderstatus").alias("batch")).agg(F.count(F.lit(1)).alias("expected"))
    # Distinct traces first (map-side partial distinct), then their batch tag:
    # the join sees one row per trace instead of one per span.
    traces = V.spans(spark, sf).select("order_key").repartition(tasks, "order_key").distinct()
    tagged = traces.join(orders, traces.order_key == orders.o_orderkey, "left")
    found = tagged.groupBy(F.col("o_orderstatus").alias("batch")).agg(F.count(F.lit(1)).alias("found"))
    return T.expected_vs_found(expected, found, ["batch"])


def reconcile_lost_ids(spark: SparkSession, sf: str) -> DataFrame:
    """J5 by name: the trace ids that a batch lost and those it has too much, by
    difference digests.  Spans of every 211th order carry another id."""
    tasks = V.span_tasks(spark, sf)
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]).repartition(tasks, "o_orderkey")
    expected = orders.select(F.col("o_orderstatus").alias("batch"), F.col("o_orderkey").alias("trace"))
    spans = V.spans(spark, sf).select("order_key").repartition(tasks, "order_key").distinct()
    tagged = spans.join(orders, F.col("order_key") == F.col("o_orderkey"))
    other = F.when(F.col("order_key") % 211 == 0, F.col("order_key") + 10**12).otherwise(F.col("order_key"))
    found = tagged.select(F.col("o_orderstatus").alias("batch"), other.alias("trace"))
    got = RC.lost_and_surplus(expected.distinct(), found, "batch", "trace", unique=True)
    return got.select(F.col("tag").alias("batch"), F.col("id").cast("long").alias("trace"), "side")


def backend_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """The replica backend only kept spans with line number <= 4.

    Both backends are read from the same span table here, so their A7 counts
    come from one pass: spans per (flag, trace) for each backend (one shuffle,
    partial aggregation), then per-flag totals in long form for the ratio.
    """
    spans = V.spans(spark, sf).select(
        F.col("attrs")["return.flag"].alias("flag"), F.nullif("trace_id", F.lit("")).alias("trace"),
        (F.col("line_number") <= 4).alias("in_replica"),
    )
    per_trace = spans.groupBy("flag", "trace").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("in_replica").alias("n_replica")
    )
    per_flag = per_trace.groupBy("flag").agg(
        F.count("trace").alias("p_traces"), F.sum("n").alias("p_spans"),
        F.count(F.when(F.col("n_replica") > 0, F.col("trace"))).alias("r_traces"),
        F.sum("n_replica").alias("r_spans"),
    )
    counts = per_flag.select("flag", F.explode(F.array(
        F.struct(F.lit("primary").alias("backend"), F.col("p_traces").alias("traces"), F.col("p_spans").alias("spans")),
        F.struct(F.lit("replica").alias("backend"), F.col("r_traces").alias("traces"), F.col("r_spans").alias("spans")),
    )).alias("c")).select("flag", "c.*")
    return T.backend_ratio(counts, "backend", "primary", "replica", by=["flag"])


def trace_keep_matches_else_all(spark: SparkSession, sf: str) -> DataFrame:
    spans = V.spans(spark, sf)
    m = (F.col("attrs")["return.flag"] == "R") & (F.col("service") == "payment")
    kept = T.keep_matches_else_all(spans, m, by=["service"])
    return kept.groupBy("service").agg(F.count(F.lit(1)).alias("spans"))


def trace_process_exists(spark: SparkSession, sf: str) -> DataFrame:
    """P14 on span rows: the process of a span is its service.  The two tags
    sit on different spans (line 1 and line 2) of one process."""
    spans = V.spans(spark, sf)
    a = (F.col("line_number") == 1) & (F.col("attrs")["return.flag"] == "N")
    b = (F.col("line_number") == 2) & (F.col("attrs")["line.status"] == "O")
    hits = T.process_predicate_traces(spans, a, b, "service")
    return hits.agg(F.count(F.lit(1)).alias("traces"))


def trace_response_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A7 + A8 over response files: both shapes, empty lists, spanCount."""
    return TR.counts(V.trace_responses(spark, sf))


def trace_response_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """P14 + P15 over response files: traces one process of which carries both
    tags; where a response has none, all of its traces."""
    found = TR.labelled(V.trace_responses(spark, sf), ("benchmark_app", "orders"), ("benchmark_run_id", "r1"))
    return found.groupBy("response").agg(F.count(F.lit(1)).alias("traces"), F.sum(F.size("spans")).cast("long").alias("spans"))


def trace_response_tags(spark: SparkSession, sf: str) -> DataFrame:
    """P17 over response files: process tags whose key contains 'benchmark'."""
    return TR.benchmark_tags(V.trace_responses(spark, sf)).groupBy("response", "key", "value").agg(F.count(F.lit(1)).alias("tags"))


def search_result_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A8 on search-result rows: one row per order with its span list size
    (orders without lines: empty list) and a ``spanCount`` field."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey"])
    n = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    res = orders.join(n, orders.o_orderkey == n.l_orderkey, "left").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").cast("string").alias("traceID"),
        F.array_repeat(F.lit("span"), F.coalesce("_n", F.lit(0)).cast("int")).alias("spans"),
        F.when(F.col("o_orderstatus") == "F", F.lit(3)).when(F.col("o_orderstatus") == "O", F.lit(0))
        .alias("spanCount"),
    )
    return T.search_result_counts(res, by=["status"])


# ----------------------------------------------------------------- report
def latency_percentiles_recent(spark: SparkSession, sf: str) -> DataFrame:
    return R.run_latency_percentiles(V.latencies(spark, sf))


def latency_percentiles_by_type(spark: SparkSession, sf: str) -> DataFrame:
    lat = V.latencies(spark, sf).withColumn("query_key", F.col("event_type"))
    return R.run_latency_percentiles(lat)


def latency_summary_stats(spark: SparkSession, sf: str) -> DataFrame:
    lat = V.latencies(spark, sf)
    s = R.summary_stats(lat, ["event_type"], "latency_ms", ["ts", "event_id"])
    return s.withColumn("mean", _r6(F.col("mean")))


def errors_per_query(spark: SparkSession, sf: str) -> DataFrame:
    lat = V.latencies(spark, sf)
    return R.latency_with_errors(R.run_latency_percentiles(lat), R.error_counts(lat))


def peak_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return R.peak_ingest(V.service_obs(spark, sf), ["ingested"], "dropped", SERVICE_CLASSES)


def _trace_obs(spark, sf):
    ev = read_table(spark, sf, "events", ["user_id", "value"])
    backend = F.concat(F.lit("backend-"), (F.col("user_id") % 3).cast("string"))
    # every event is a search and an ingest observation of its backend
    q = ev.select(
        backend.alias("backend"),
        (F.col("value") > 5).alias("success"),
        F.col("value").cast("long").alias("trace_count"),
        F.when(F.col("user_id") % 3 == 2, F.lit(0)).otherwise((F.col("value") * 3).cast("long")).alias("span_count"),
    )
    i = ev.select(
        backend.alias("backend"),
        (F.col("value") * 10).cast("long").alias("spans_received"),
        F.when(F.col("value") > 400, (F.col("value") / 10).cast("long")).otherwise(F.lit(0)).alias("spans_dropped"),
    )
    return q, i


def trace_drop_rate(spark: SparkSession, sf: str) -> DataFrame:
    q, i = _trace_obs(spark, sf)
    return R.trace_summary(q, i).withColumn("drop_rate_pct", _r6(F.col("drop_rate_pct")))


def resource_usage(spark: SparkSession, sf: str) -> DataFrame:
    u = R.resource_usage(V.service_obs(spark, sf, counters=False), by=["scenario"])
    return u.select("scenario", "service", *[_r6(F.col(c)).alias(c) for c in
                                             ["avg_cpu_pct", "max_cpu_pct", "avg_mem_mb", "max_mem_mb"]])


def resource_series(spark: SparkSession, sf: str) -> DataFrame:
    return R.resource_series(V.service_obs(spark, sf, counters=False))


def throughput(spark: SparkSession, sf: str) -> DataFrame:
    return R.throughput(V.service_obs(spark, sf), by=["service"])


def counter_delta(spark: SparkSession, sf: str) -> DataFrame:
    obs = V.service_obs(spark, sf)
    return R.counter_delta(obs, "service", "ingested", start="2024-01-15 00:00:00", tiebreak="event_id")


def _storage_sides(spark, sf):
    obs = V.service_obs(spark, sf)
    primary = R.last_observation(obs, ["service"], "ts", ["ingested"]).select(
        "service",
        F.when(F.col("service") == "error", F.lit(0)).otherwise(F.col("ingested") * 1000).alias("size_a"),
    )
    second = obs.groupBy("service").agg((F.count(F.lit(1)) * 37 + 11).alias("size_b"))
    return primary, second


def storage_fill_in(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _storage_sides(spark, sf)
    return R.storage_fill_in(a, b)


def bytes_per_item(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _storage_sides(spark, sf)
    st = R.storage_fill_in(a, b)
    items = R.peak_ingest(V.service_obs(spark, sf), ["ingested"], "dropped", SERVICE_CLASSES)
    return R.bytes_per_item(st, items.select("service", "total_ingested"))


def relative_difference(spark: SparkSession, sf: str) -> DataFrame:
    """How much less storage per item 'error' needs than 'click'."""
    bpi = bytes_per_item(spark, sf)
    p = bpi.groupBy().pivot("service", ["click", "error"]).agg(F.first("bytes_per_item"))
    return p.select(rel_diff("click", "error").alias("pct_less"))


def format_storage(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _storage_sides(spark, sf)
    st = R.storage_fill_in(a, b)
    return st.select("service", "storage_bytes", format_bytes("storage_bytes").alias("storage_text"))


def service_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Resource stats and ingest counters of one (ts, service), plus the
    service's final storage (small dimension)."""
    obs = V.service_obs(spark, sf)
    # an observation holds both, so they are projected together, not joined on
    # a time that several observations may share
    both = obs.select("ts", "service", "cpu_percent", "memory_bytes", "ingested", "dropped")
    a, b = _storage_sides(spark, sf)
    return both.join(R.storage_fill_in(a, b), "service", "left")


def known_services(spark: SparkSession, sf: str) -> DataFrame:
    obs = R.restrict_services(V.service_obs(spark, sf, counters=False), KNOWN_SERVICES)
    return obs.groupBy("service").agg(F.count(F.lit(1)).alias("observations"))


def load_volume(spark: SparkSession, sf: str) -> DataFrame:
    """A scenario's configured rate times the time it ran."""
    t = R.throughput(V.service_obs(spark, sf), by=["scenario"])
    rate = F.when(F.col("scenario") == "steady", F.lit(25.5)).otherwise(F.lit(100.25))
    return R.load_volume(t.withColumn("rate", rate), "rate", "elapsed_s").select("scenario", "estimated_items")


def cpu_from_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """P22 + W4: CPU %% from consecutive cumulative counters of one service
    (cpu = ingested counter, system = elapsed microseconds, 4 CPUs)."""
    p = V.service_obs(spark, sf, previous=["ingested", "ts"])
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    cpu = cpu_percent(F.col("ingested") - F.col("prev_ingested"), us("ts") - us("prev_ts"), F.lit(4))
    return p.filter(F.col("prev_ts").isNotNull()).select("service", "event_id", cpu.alias("cpu_pct"))


def memory_share(spark: SparkSession, sf: str) -> DataFrame:
    obs = V.service_obs(spark, sf, counters=False)
    return obs.select("service", "event_id",
                      memory_percent("memory_bytes", F.lit(512 * 1048576)).alias("mem_pct"))


def text_utf8_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a byte that begins a character and isn't followed by one."""
    logs = V.log_lines(spark, sf)
    broken = F.concat(F.col("line").cast("binary"), F.unhex(F.lit("C3")), F.lit("x").cast("binary"))
    return logs.select("event_id", utf8_repair(broken.cast("string")).alias("repaired"))


def text_truncate(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", truncate("text", 200).alias("head"))


# ------------------------------------------------- more trace / report ops
def trace_search_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Tag search that matches nothing falls back to the service filter."""
    spans = V.spans(spark, sf)
    strict = (F.col("service") == "payment") & (F.col("attrs")["return.flag"] == "X")
    loose = F.col("service") == "payment"
    return T.search_with_fallback_counts(spans, strict, loose)


def trace_search_strict_wins(spark: SparkSession, sf: str) -> DataFrame:
    """P16, the other branch: the strict search matches, so the loose one isn't used."""
    spans = V.spans(spark, sf)
    strict = (F.col("service") == "payment") & (F.col("attrs")["return.flag"] == "R")
    return T.search_with_fallback_counts(spans, strict, F.col("service") == "payment")


def tag_inspection(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute keys containing 'benchmark' (case-insensitive), with
    their values and span counts."""
    tags = T.benchmark_tag_rows(V.spans(spark, sf))
    return tags.groupBy("key", "value").agg(F.count(F.lit(1)).alias("spans"))


def query_latency_table(spark: SparkSession, sf: str) -> DataFrame:
    """P19 + A11: per query key ``<service>:<query>`` the service class and
    the query name after the last ':', with run percentiles."""
    lat = V.latencies(spark, sf).withColumn(
        "query_key", F.concat(F.col("event_type"), F.lit(":q"), (F.col("user_id") % 3).cast("string"))
    )
    p = R.run_latency_percentiles(lat)
    return p.select(
        R.service_class("query_key", SERVICE_CLASSES).alias("service"),
        R.query_name("query_key").alias("query"),
        "query_key", "n", "p50", "p90", "p99",
    )


# ------------------------------------- run artifacts, written and read back
def run_latest(spark: SparkSession, sf: str) -> DataFrame:
    """S7 + T3: the run whose manifest was written last."""
    manifests, _ = V.run_artifacts(spark, sf)
    return RN.latest_run(manifests)


def run_query_errors(spark: SparkSession, sf: str) -> DataFrame:
    """S6 + U1 + A13: errors per query over the observations of both runs."""
    _, obs = V.run_artifacts(spark, sf)
    q = RN.query_obs(obs)
    both = RN.union_observations(q.filter("run_id = 'run_a'"), q.filter("run_id = 'run_b'"))
    return R.error_counts(both)


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        manifests, obs = V.run_artifacts(spark, sf)
        last = RN.latest_run(manifests)
        m = manifests.withColumnRenamed("run_id", "_id").join(last, F.col("run_dir") == last.run_id)
        o = obs.join(last, "run_id")
        out = R.summary_tables(m, RN.service_obs(o), RN.query_obs(o), V.RUN_SERVICES)[name]
        doubles = [c for c, kind in out.dtypes if kind == "double"]
        return out.withColumns({c: _r6(F.col(c)) for c in doubles})

    run.__name__ = f"report_{name}"
    run.__doc__ = f"K3 + K4: the {name} table of the latest run, from its files."
    return run


REPORTS = [_report(n) for n in ("load_volume", "metrics", "logs", "traces", "storage", "ingest", "resources")]


# ------------------------------------------ streaming operators, batch form
def _events_et(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return W.event_time(ev)


def stream_sliding_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ST8 in batch (withWatermark is inert): counts per step, then the windows."""
    steps = W.step_counts(_events_et(spark, sf), ["event_type"], "6 hours")
    return W.sliding_from_steps(steps, "event_type", DAY, 6 * 3600)


def _events_stream(spark, sf):
    # All files are one micro-batch: the table isn't in order of time, and a
    # watermark between its files would drop what comes late.
    path = V.event_files(spark, sf)
    return W.event_time(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path))


def stream_sink_steps(spark: SparkSession, sf: str) -> DataFrame:
    """ST8 streamed: the step counts in the sink of a run, those the final
    watermark has closed."""
    out = V.sunk(spark, "steps", sf, lambda: W.step_counts(_events_stream(spark, sf), ["event_type"], "6 hours", watermark="1 hour"))
    return out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def stream_sink_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """ST7 streamed: the last value per type and day in the sink of a run."""
    out = V.sunk(spark, "snapshot", sf, lambda: W.periodic_snapshot(
        _events_stream(spark, sf), ["event_type"], "value", every="1 day", watermark="1 hour"))
    return out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


FORWARD_SINCE = 1705363200.0  # 2024-01-16 00:00 UTC


def _delivered(rows: DataFrame) -> DataFrame:
    got = F.from_json("value", "_msg string, severity string")
    return rows.select(F.when(got["_msg"].isNotNull(), "plain").otherwise("entry").alias("kind"), got["severity"].alias("severity"))


def stream_sink_forwarder(spark: SparkSession, sf: str) -> DataFrame:
    """S8, S10, K1, ST1, ST2, ST4: what a run of the forwarder left in its sink and
    its dead-letter sink, by kind and severity."""
    sinks, _ = V.forwarder_sinks(spark, sf, FORWARD_SINCE)
    both = _delivered(sinks["a"]).unionByName(sinks["dead"].select(F.lit("rejected").alias("kind"), F.lit(None).cast("string").alias("severity")))
    return both.groupBy("kind", "severity").agg(F.count(F.lit(1)).alias("lines"))


def stream_forwarder_pair(spark: SparkSession, sf: str) -> DataFrame:
    """K2: both sinks of the run, as the commit log shows them: batches differ in none."""
    sinks, _ = V.forwarder_sinks(spark, sf, FORWARD_SINCE)
    each = [sinks[k].select(F.lit(k).alias("sink"), "batch_id", "value") for k in ("a", "b")]
    by_batch = each[0].unionByName(each[1]).groupBy("batch_id").pivot("sink", ["a", "b"]).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("sum"))
    same = F.col("a_lines").eqNullSafe(F.col("b_lines")) & F.col("a_sum").eqNullSafe(F.col("b_sum"))
    return by_batch.agg(F.coalesce(F.sum("a_lines"), F.lit(0)).alias("lines_a"), F.coalesce(F.sum("b_lines"), F.lit(0)).alias("lines_b"),
                        F.count_if(~same).alias("batches_apart"))


def stream_forwarder_batches(spark: SparkSession, sf: str) -> DataFrame:
    """ST1: no batch that the run delivered holds more than 2,500 entries."""
    _, log = V.forwarder_sinks(spark, sf, FORWARD_SINCE)
    sizes = log.groupBy("batch_id").agg(F.sum(F.when(F.col("metric").isin("entries", "rejected"), F.col("lines"))).alias("lines"))
    return sizes.agg(F.count_if(F.col("lines") > V.ENTRIES).alias("batches_over"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"))


def stream_drop_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ST10: the drop counts of all batches of the run, from its commit log."""
    _, log = V.forwarder_sinks(spark, sf, FORWARD_SINCE)
    return log.where(F.col("metric").isNotNull()).groupBy("metric").agg(F.sum("lines").alias("lines"))


def stream_tail_from_now(spark: SparkSession, sf: str) -> DataFrame:
    """What a forwarder delivers that starts at the end of what is there."""
    return _delivered(V.tail_from_now(spark, sf)).groupBy("kind", "severity").agg(F.count(F.lit(1)).alias("lines"))


PANE, STREAM_WATERMARK = 6 * 3600, "1 hour"


def stream_rate_per_series(spark: SparkSession, sf: str) -> DataFrame:
    """A5 + W4 streamed: counter rates per series over the last seven days of
    closed panes, from the panes that keyed state left in the sink."""
    rows = V.counters_from(V.samples(spark, sf), V.bucket_width(spark, sf)).select(
        "series_key", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id", "counter")
    panes = V.ordered_stream(spark, "rate-panes", sf, rows, ["us", "event_id"], lambda s: SF.rate_panes(
        s.withColumn("event_ts", F.timestamp_micros("us")), "series_key", "counter", f"{PANE} seconds", STREAM_WATERMARK))
    end = V.closed_end(spark, sf, PANE)
    return SF.rates_from_panes(panes, "series_key", WEEK, end)


def stream_churn(spark: SparkSession, sf: str) -> DataFrame:
    """A20 + U3 streamed: series active, appeared and disappeared per closed day."""
    rows = V.samples(spark, sf).select("series_key", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id")
    changes = V.ordered_stream(spark, "changes", sf, rows, ["us", "event_id"], lambda s: SF.series_changes(
        s.withColumn("event_ts", F.timestamp_micros("us")), "series_key", DAY, STREAM_WATERMARK))
    return SF.churn_from_changes(changes, DAY)


def stream_top_series(spark: SparkSession, sf: str) -> DataFrame:
    """T1 streamed: the ten series with most samples, whether a stream's Space-Saving
    counters (fewer than there are series) hold them, and whether their bounds do."""
    samples = V.samples(spark, sf)
    # a skewed stream: a sample of user u comes once more for every power of two that divides u
    more = F.explode(F.sequence(F.lit(0), F.bit_count(F.col("user_id").bitwiseXOR(F.col("user_id") - 1)).cast("int")))
    rows = samples.select("series_key", "event_id", more.alias("copy"))
    said = V.updated(spark, "heavy", sf, rows, ["event_id", "copy"], lambda s: SF.heavy_hitters(s, "series_key", counters=64, parts=8), ["part"])
    held = said.select(F.inline(F.arrays_zip("items", "n", "error")))
    exact = S.top_k(rows.groupBy("series_key").agg(F.count(F.lit(1)).alias("samples")), 10, by="samples")
    both = exact.join(held, F.col("items") == F.col("series_key"), "left")
    within = (F.col("n") >= F.col("samples")) & (F.col("n") - F.col("error") <= F.col("samples"))
    return both.select("series_key", "samples", F.col("n").isNotNull().alias("held"), F.coalesce(within, F.lit(False)).alias("within_bounds"))


def stream_sliding_state(spark: SparkSession, sf: str) -> DataFrame:
    """ST8 streamed: counts over a day every six hours per type, from a ring of panes."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type"]).select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id", "event_type")
    out = V.ordered_stream(spark, "sliding", sf, ev, ["us", "event_id"], lambda s: SF.sliding_counts(
        s.withColumn("event_ts", F.timestamp_micros("us")), "event_type", DAY, PANE, STREAM_WATERMARK))
    return out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def stream_retention(spark: SparkSession, sf: str) -> DataFrame:
    """ST6: entries younger than 7 days, seen from the newest."""
    ev = _events_et(spark, sf)
    kept = W.retained(ev, "event_ts", 7, now=ev.select(F.max("event_ts")).scalar())
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("entries"))


def stored_range_counts(spark: SparkSession, sf: str) -> DataFrame:
    """P8 over the stored layout: a time range reads only the dates it touches."""
    rows = LY.read_range(spark, V.stored_samples(spark, sf), dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 12, 18))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("samples"))


def stream_periodic_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """ST7: last cumulative counter per service and day."""
    obs = W.event_time(V.service_obs(spark, sf))
    out = W.periodic_snapshot(obs, ["service"], "ingested", every="1 day")
    return out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def stream_running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """ST9: running counter per series, a keyed aggregate in update mode over
    several micro-batches; what the sink holds is each series' last update."""
    rows = V.samples(spark, sf).select("event_type", F.col("value").cast("decimal(18,2)").alias("v"), "event_id")
    out = V.updated(spark, "totals", sf, rows, ["event_id"], lambda s: W.running_totals(s, ["event_type"], "v"), ["event_type"])
    return out.select("event_type", F.col("total").cast("double").alias("total"), "samples")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """ST11: replayed entries (every event delivered twice) deduplicated by id;
    read from the sink of a streaming run."""
    def twice() -> DataFrame:
        return W.deduplicated(_events_stream(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))), ["event_id"])

    d = V.sunk(spark, "dedup", sf, twice)
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("entries"))


def stream_late_rejection(spark: SparkSession, sf: str) -> DataFrame:
    """ST5: entries older than 168 h before the newest entry are rejected."""
    ev = _events_et(spark, sf)
    now = ev.select(F.max("event_ts")).scalar()
    kept = W.reject_late(ev, "event_ts", 168, now=now)
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("accepted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fns = [
        topk_latest, topk_rate, rate_per_series, count_over_time_tumbling, count_over_time_sliding,
        count_over_time_last_step_total, count_over_time_plain_total, series_cardinality, series_churn,
        histogram_buckets, histogram_quantiles, quantiles_merged, cardinality_merged, label_cardinality,
        log_error_lines, log_window_count, log_latest_lines, log_parse_lenient, log_parse_strict, log_entry_payload, log_stream_counts,
        log_range_count_total,
        exposition_sum, exposition_pages_sum, exposition_labelled, exposition_selected, exposition_first, exposition_last, exposition_active_series,
        exposition_named, exposition_drop_prefix_sum,
        trace_span_counts, trace_service_tag_search, trace_field_search, reconcile_expected_found, reconcile_lost_ids,
        backend_ratio, trace_keep_matches_else_all, trace_process_exists, search_result_counts, trace_response_counts,
        trace_response_labelled, trace_response_tags,
        latency_percentiles_recent, latency_percentiles_by_type, latency_summary_stats, errors_per_query,
        peak_ingest, trace_drop_rate, resource_usage, resource_series, throughput, counter_delta,
        storage_fill_in, bytes_per_item, relative_difference, format_storage, service_assembly,
        known_services, load_volume, cpu_from_deltas, memory_share, text_truncate, text_utf8_repair,
        trace_search_with_fallback, trace_search_strict_wins, tag_inspection, query_latency_table,
        stream_sliding_counts, stream_periodic_snapshot, stream_running_totals, stream_dedup,
        stream_late_rejection, stream_sink_steps, stream_sink_snapshot, stream_sink_forwarder, stream_forwarder_pair, stream_forwarder_batches, stream_drop_counts,
        stream_tail_from_now, stream_rate_per_series, stream_sliding_state, stream_churn, stream_top_series, stream_retention,
        stored_range_counts,
        run_latest, run_query_errors, *REPORTS,
    ]
    return {f.__name__: f for f in fns}
