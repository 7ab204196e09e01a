"""Run-report operators over observation tables (A9-A18, A21, A22, J1-J3,
J6, J7, P18-P20, P26).

``service_obs``: one row per (observation time, service) with cumulative
ingest counters, resource use and storage size.  ``query_obs``: one row per
(observation time, query key) with latency and success.  Everything is a
grouped aggregate or a join of aggregates; the optional ``by`` list adds e.g.
``scenario`` to every grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.numeric import bytes_to_mb, first_nonzero, safe_ratio
from orrery.functions.text import format_bytes
from orrery.operators.quantiles import quantile_table


def service_class(service: Column | str, classes: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Class of a service by substring (P19), first matching class wins."""
    s = F.col(service) if isinstance(service, str) else service
    expr = None
    for label, needles in classes.items():
        cond = F.lit(False)
        for n in needles:
            cond = cond | s.contains(n)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def query_name(key: Column | str) -> Column:
    """Text after the last ``:`` of a query key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.substring_index(k, ":", -1)


def peak_ingest(service_obs: DataFrame, ingested: Sequence[str], dropped: str,
                classes: Mapping[str, Sequence[str]], by: Sequence[str] = (), service: str = "service") -> DataFrame:
    """Per service: max over observations of the cumulative ingested counter
    (first non-zero of ``ingested`` columns, P20) and of dropped (A9)."""
    ing = first_nonzero(*ingested)
    return service_obs.groupBy(*by, service).agg(
        F.max(ing).cast("long").alias("total_ingested"),
        F.coalesce(F.max(F.col(dropped)), F.lit(0)).cast("long").alias("total_dropped"),
    ).withColumn("type", service_class(service, classes))


def nonzero_or_fail(counts: DataFrame, col: str, message: str) -> DataFrame:
    """Fail the job when a count is 0 (P21): no fallback value.  The check
    runs inside the query (``raise_error``), so no driver round trip."""
    c = F.col(col)
    return counts.withColumn(col, F.when(c == 0, F.raise_error(F.lit(message)).cast(counts.schema[col].dataType))
                             .otherwise(c))


def error_counts(query_obs: DataFrame, key: str = "query_key", success: str = "success") -> DataFrame:
    """Rows whose success is false or absent, per query key."""
    return query_obs.groupBy(key).agg(
        F.count_if(~F.coalesce(F.col(success), F.lit(False))).alias("errors")
    )


def run_latency_percentiles(query_obs: DataFrame, key: str = "query_key", value: str = "latency_ms",
                            ts: str = "ts", tiebreak: Sequence[str] = ("event_id",),
                            success: str = "success") -> DataFrame:
    """Run manifest percentiles over successful queries (P18 + A11):
    median; exclusive p90 from n >= 10 and p99 from n >= 100, else the most
    recent latency."""
    ok = query_obs.filter(F.col(success))
    return quantile_table(ok, [key], value, [ts, *tiebreak], ts, "recent")


def summary_stats(values: DataFrame, by: Sequence[str], value: str, tiebreak: Sequence[str],
                  exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """mean, p50, p90, p99, min, max per group (A12): small-n p90/p99 = max.

    ``exact=False`` trades exactness for a single aggregation pass:
    ``percentile_approx`` sketches (bounded memory per group, merged
    map-side), relative rank error about ``1/accuracy``.
    """
    if not by:
        return summary_stats(values.withColumn("_all", F.lit(0)), ["_all"], value, tiebreak, exact,
                             accuracy).drop("_all")
    if not exact:
        v = F.col(value)
        return values.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(v, 0.5, accuracy).alias("p50"),
            F.when(F.count(F.lit(1)) >= 10, F.percentile_approx(v, 0.9, accuracy)).otherwise(F.max(v)).alias("p90"),
            F.when(F.count(F.lit(1)) >= 100, F.percentile_approx(v, 0.99, accuracy)).otherwise(F.max(v))
            .alias("p99"),
            (F.sum(v.cast("double")) / F.count(F.lit(1))).alias("mean"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )
    return quantile_table(values, by, value, tiebreak, None, "max", stats=True)


def latency_with_errors(latency: DataFrame, errors: DataFrame, key: str = "query_key") -> DataFrame:
    """Latency table left-joined with error counts, missing = 0."""
    return latency.join(errors, key, "left").withColumn("errors", F.coalesce(F.col("errors"), F.lit(0)).cast("long"))


def trace_summary(query_obs: DataFrame, ingest_obs: DataFrame, backend: str = "backend",
                  success: str = "success") -> DataFrame:
    """Traces / spans per backend from search results, else from ingest
    counters, with drop rate (A10).

    Max trace and span counts over successful searches; if either is 0 the
    span total is the max non-zero ``spans_received`` and dropped the max
    non-zero ``spans_dropped`` (0 if none); otherwise dropped is 0.  Drop
    rate = dropped / spans * 100, 0 when spans is 0.
    """
    q = query_obs.filter(F.col(success)).groupBy(backend).agg(
        F.coalesce(F.max("trace_count"), F.lit(0)).alias("q_traces"),
        F.coalesce(F.max("span_count"), F.lit(0)).alias("q_spans"),
    )
    i = ingest_obs.groupBy(backend).agg(
        F.max(F.nullif(F.col("spans_received"), F.lit(0))).alias("i_spans"),
        F.max(F.nullif(F.col("spans_dropped"), F.lit(0))).alias("i_dropped"),
    )
    j = q.join(i, backend, "full")
    qt, qs = F.coalesce("q_traces", F.lit(0)), F.coalesce("q_spans", F.lit(0))
    fallback = (qt == 0) | (qs == 0)
    use_ingest = fallback & F.col("i_spans").isNotNull()
    spans = F.when(use_ingest, F.col("i_spans")).otherwise(qs)
    dropped = F.when(use_ingest, F.coalesce(F.col("i_dropped"), F.lit(0))).otherwise(F.lit(0))
    return j.select(
        backend,
        qt.cast("long").alias("traces"),
        spans.cast("long").alias("spans"),
        dropped.cast("long").alias("dropped"),
        safe_ratio(dropped * F.lit(100.0), spans).alias("drop_rate_pct"),
    )


def resource_usage(service_obs: DataFrame, by: Sequence[str] = (), service: str = "service",
                   cpu: str = "cpu_percent", mem: str = "memory_bytes") -> DataFrame:
    """Mean / max CPU %% and memory MB per service."""
    mb = bytes_to_mb(mem)
    return service_obs.groupBy(*by, service).agg(
        F.avg(cpu).alias("avg_cpu_pct"), F.max(cpu).alias("max_cpu_pct"),
        F.avg(mb).alias("avg_mem_mb"), F.max(mb).alias("max_mem_mb"),
    )


def resource_series(service_obs: DataFrame, service: str = "service", ts: str = "ts",
                    cpu: str = "cpu_percent", mem: str = "memory_bytes") -> DataFrame:
    """Per service ordered (ts, cpu, memory MB) (A17): range-partitioned sort."""
    return service_obs.select(service, ts, F.col(cpu).alias("cpu_pct"), bytes_to_mb(mem).alias("mem_mb")).orderBy(
        service, ts
    )


def throughput(df: DataFrame, ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """Items per second: count / (last - first) (A18); 0 when elapsed is 0."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("items"), (F.max(us) - F.min(us)).alias("_el"))
    return agg.select(
        *by, "items", (F.col("_el") / F.lit(1e6)).alias("elapsed_s"),
        safe_ratio(F.col("items") * F.lit(1e6), F.col("_el")).alias("per_second"),
    )


def counter_delta(snapshots: DataFrame, key: str, value: str, ts: str = "ts", start=None,
                  tiebreak: str | None = None) -> DataFrame:
    """after - before per key (J7): before = snapshot at (or first after)
    ``start`` (run start; default the first snapshot), after = the last."""
    order = F.struct(ts, tiebreak) if tiebreak else F.col(ts)
    s = snapshots if start is None else snapshots.filter(F.col(ts) >= F.lit(start))
    agg = s.groupBy(key).agg(F.min_by(value, order).alias("before"), F.max_by(value, order).alias("after"))
    return agg.withColumn("delta", F.col("after") - F.col("before"))


def last_observation(df: DataFrame, key: Sequence[str], ts: str, cols: Sequence[str],
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row per key (W5), by ``ts``, then ``tiebreak``; of rows equal in
    those too, the one with the largest ``cols``, so a result can't vary."""
    agg = df.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(ts, *tiebreak, *cols)).alias("_last"))
    return agg.select(*key, *[F.col("_last")[c].alias(c) for c in cols])


def storage_fill_in(primary: DataFrame, second: DataFrame, key: str = "service", a: str = "size_a",
                    b: str = "size_b") -> DataFrame:
    """Final storage per service: primary size, the second measurement where
    the primary is missing or 0; sizes <= 0 dropped (J2)."""
    j = primary.join(second, key, "full")
    size = F.coalesce(F.nullif(F.col(a), F.lit(0)), F.col(b))
    return j.select(key, size.cast("long").alias("storage_bytes")).filter(F.col("storage_bytes") > 0)


def restrict_services(df: DataFrame, known: Sequence[str], service: str = "service") -> DataFrame:
    """Ignore services outside the known list (J6): ``isin`` on a fixed list."""
    return df.filter(F.col(service).isin(list(known)))


def bytes_per_item(storage: DataFrame, items: DataFrame, key: str = "service") -> DataFrame:
    """Stored bytes per sample / line / span (A21): guarded ratio of J2 and A9."""
    j = storage.join(items, key)
    return j.select(key, "storage_bytes", "total_ingested",
                    F.when(F.col("total_ingested") > 0, F.col("storage_bytes") / F.col("total_ingested"))
                    .alias("bytes_per_item"))


def load_volume(scenarios: DataFrame, rate: str, elapsed: str) -> DataFrame:
    """Load estimate ``int(rate * elapsed)`` (P26) — an estimate, not a count."""
    return scenarios.withColumn("estimated_items", (F.col(rate) * F.col(elapsed)).cast("long"))


def _service_of(key: Column, services: Sequence[str]) -> Column:
    """First service name contained in a query key."""
    expr = None
    for s in services:
        expr = F.when(key.contains(s), F.lit(s)) if expr is None else expr.when(key.contains(s), F.lit(s))
    return expr if expr is not None else F.lit(None).cast("string")


def _count_text(c: Column, unit: str) -> Column:
    """``f"{n:,} unit"`` for an integer count (thousands separators)."""
    return F.concat(F.format_number(c.cast("long"), 0), F.lit(f" {unit}"))


def summary_tables(manifest: DataFrame, service_obs: DataFrame, query_obs: DataFrame,
                   services: Mapping[str, Sequence[str]], materialize_inputs: bool = False) -> dict[str, DataFrame]:
    """The seven run-summary tables (K4): load_volume, metrics, logs, traces,
    storage, ingest, resources.

    ``manifest``: one run's manifest row (``runs.read_manifests``);
    ``service_obs`` / ``query_obs``: that run's exploded observations;
    ``services``: kind -> service names, kinds ``metrics``, ``logs``,
    ``traces`` (a query key belongs to the first service name it contains).
    Every table is an aggregate or a join of aggregates; nothing is collected.
    ``materialize_inputs`` writes the exploded observations once to the shared
    checkpoint folder, so the seven tables read them instead of re-parsing
    the run's JSON each time.
    """
    if materialize_inputs:
        from orrery.session import materialize

        service_obs = materialize(service_obs, "service_obs")
        query_obs = materialize(query_obs, "query_obs")
    tables: dict[str, DataFrame] = {}
    lv = manifest.select(F.col("load_volume").alias("lv"))

    def lv_get(k: str) -> Column:
        return F.coalesce(F.col("lv")[k], F.lit(0.0))

    tables["load_volume"] = lv.select(F.explode(F.array(
        F.struct(F.lit("Time Series").alias("metric"), _count_text(lv_get("series_total"), "series").alias("value"),
                 _count_text(lv_get("metrics_series"), "active").alias("rate")),
        F.struct(F.lit("Log Lines").alias("metric"), _count_text(lv_get("log_lines"), "lines").alias("value"),
                 F.format_string("%.0f lines/sec", lv_get("log_rate")).alias("rate")),
        F.struct(F.lit("Trace Spans").alias("metric"), _count_text(lv_get("traces_spans"), "spans").alias("value"),
                 F.format_string("%.0f spans/sec", lv_get("spans_rate")).alias("rate")),
    )).alias("r")).select("r.*")

    lat = manifest.select(F.explode("query_latencies").alias("query_key", "l")).select(
        "query_key", "l.p50", "l.p90", "l.p99")
    errors = error_counts(query_obs)
    for kind in ("metrics", "logs"):
        names = list(services.get(kind, []))
        sel = lat.withColumn("service", _service_of(F.col("query_key"), names)).filter(F.col("service").isNotNull())
        t = sel.select("service", query_name("query_key").alias("query"), "query_key", "p50", "p90", "p99")
        if kind == "logs":
            t = latency_with_errors(t, errors)
        tables[kind] = t.drop("query_key")

    trace_names = list(services.get("traces", []))
    tq = query_obs.withColumn("backend", _service_of(F.col("query_key"), trace_names)).filter(
        F.col("backend").isNotNull() & F.col("query_key").endswith("traces_by_label"))
    ti = service_obs.filter(F.col("service").isin(trace_names)).withColumn("backend", F.col("service"))
    tables["traces"] = trace_summary(tq, ti)

    st = manifest.select(F.explode("final_storage_bytes").alias("service", "storage_bytes"))
    tables["storage"] = st.select("service", format_bytes("storage_bytes").alias("storage_size"), "storage_bytes")

    kinds = {n: k for k, ns in services.items() for n in ns}
    kind = F.create_map(*[x for n, k in kinds.items() for x in (F.lit(n), F.lit(k))])[F.col("service")]
    ingested = (F.when(kind == "metrics", first_nonzero("samples_ingested", "samples_appended"))
                .when(kind == "logs", first_nonzero("lines_ingested", "rows_ingested"))
                .otherwise(F.coalesce(F.col("spans_received"), F.lit(0.0))))
    dropped = (F.when(kind == "metrics", F.col("samples_dropped")).when(kind == "logs", F.col("lines_dropped"))
               .otherwise(F.col("spans_dropped")))
    unit = F.when(kind == "metrics", "Samples").when(kind == "logs", "Lines").otherwise("Spans")
    ing = service_obs.filter(F.col("service").isin(list(kinds))).groupBy("service").agg(
        F.first(unit).alias("type"),
        F.max(ingested).cast("long").alias("total_ingested"),
        F.coalesce(F.max(dropped), F.lit(0.0)).cast("long").alias("total_dropped"),
    )
    tables["ingest"] = ing
    tables["resources"] = resource_usage(service_obs.filter(F.col("service").isin(list(kinds))))
    return tables
