"""Trace operators over span rows and over trace-search results
(A7, A8, P11-P17, J4, J5, U2).

Span rows: ``(trace_id, service, attrs MAP<STRING,STRING>, ...)``, one row per
span.  A tag search returns whole traces: every span of each trace that has at
least one matching span, computed as a semi join on ``trace_id`` (both sides
shuffled on the trace id, where AQE splits a hot one, unless the spans are
already dealt to partitions by it: those stay as they are).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.tags import attrs_match, tag_json_to_map, tag_string_to_map


def search(spans: DataFrame, predicate: Column, trace: str = "trace_id") -> DataFrame:
    """All spans of traces that have a span matching ``predicate``."""
    hits = spans.filter(predicate).select(trace).distinct()
    return spans.join(hits, trace, "left_semi")


def parse_tag_string(tags: str) -> dict[str, str]:
    """``"k=v k2=v2"`` -> dict: pairs split on spaces, key/value on the first ``=``."""
    out = {}
    for pair in tags.split(" "):
        if pair:
            k, _, v = pair.partition("=")
            out[k] = v
    return out


def tag_search(spans: DataFrame, tags: str | Column, attrs: str = "attrs") -> DataFrame:
    """``tags="k=v k=v"`` search.

    A literal tag string is parsed up front into plain equalities, which
    Catalyst can simplify and push into the scan; a column of tag strings is
    matched with ``str_to_map`` per row.
    """
    if isinstance(tags, str):
        return search(spans, attrs_match(attrs, parse_tag_string(tags)))
    return search(spans, attrs_match(attrs, tag_string_to_map(tags)))


def service_tag_search(spans: DataFrame, service: str, tags_json: str | Column, attrs: str = "attrs",
                       service_col: str = "service") -> DataFrame:
    """Service equality AND JSON map of tags."""
    wanted = json.loads(tags_json) if isinstance(tags_json, str) else tag_json_to_map(tags_json)
    if isinstance(wanted, dict):
        wanted = {str(k): str(v) for k, v in wanted.items()}
    return search(spans, (F.col(service_col) == F.lit(service)) & attrs_match(attrs, wanted))


def has_field(field: str, value: str, attrs: str = "attrs") -> Column:
    return F.col(attrs)[field] == F.lit(value)


def field_search(spans: DataFrame, field: str, value: str, attrs: str = "attrs") -> DataFrame:
    """``field="value"`` on span attributes."""
    return search(spans, has_field(field, value, attrs))


def trace_counts(found: DataFrame, by: Sequence[str] = (), trace: str = "trace_id") -> DataFrame:
    """Distinct non-empty trace ids, total spans, mean spans per trace.

    Empty ids count as spans but not as traces; mean is 0 with no traces.
    """
    t = F.nullif(F.col(trace), F.lit(""))
    # by trace first: spans dealt by trace are not shuffled again
    per = found.groupBy(*by, F.col(trace)).agg(F.count(F.lit(1)).alias("_n"))
    agg = per.groupBy(*by).agg(F.count(t).alias("traces"), F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("spans"))
    return agg.withColumn(
        "spans_per_trace",
        F.when(F.col("traces") > 0, F.col("spans") / F.col("traces")).otherwise(F.lit(0.0)),
    )


def result_span_count(spans_array: Column, span_count: Column) -> Column:
    """Spans of one search-result trace (A8): array length, else the
    ``spanCount`` field when non-zero, else 1."""
    n = F.coalesce(F.size(spans_array), F.lit(-1))
    return F.when(n > 0, n).otherwise(F.coalesce(F.nullif(span_count.cast("long"), F.lit(0)), F.lit(1)))


def search_result_counts(results: DataFrame, by: Sequence[str] = (), trace: str = "traceID",
                         spans: str = "spans", span_count: str = "spanCount") -> DataFrame:
    """Trace and span totals over trace-search result rows (A7 + A8).

    One row per returned trace; per-row array sizes, then a plain aggregate.
    """
    sc = F.col(span_count) if span_count in results.columns else F.lit(None)
    n = result_span_count(F.col(spans), sc)
    return results.groupBy(*by).agg(
        F.count_distinct(F.nullif(F.col(trace), F.lit(""))).alias("traces"),
        F.sum(n).cast("long").alias("spans"),
    )


def keep_matches_else_all(df: DataFrame, matched: Column, by: Sequence[str] = ()) -> DataFrame:
    """Use the matching rows if there are any (per group), else all rows.

    The match count is an aggregate joined back on the group keys (a single
    row without groups), never a per-row pairing.
    """
    flagged = df.withColumn("_m", matched)
    if by:
        counts = flagged.groupBy(*by).agg(F.count_if("_m").alias("_n_matched"))
        j = flagged.join(counts, list(by))
    else:
        n = flagged.agg(F.count_if("_m")).scalar()
        j = flagged.withColumn("_n_matched", n)
    return j.filter(F.col("_m") | (F.col("_n_matched") == 0)).drop("_m", "_n_matched")


def search_with_fallback(spans: DataFrame, strict: Column, loose: Column, trace: str = "trace_id") -> DataFrame:
    """Search with ``strict``; when it finds nothing at all, repeat with
    ``loose`` (P16).  One pass finds the traces either predicate names, with
    what each matched; which of them count is decided on those few."""
    hits = spans.filter(strict | loose).groupBy(trace).agg(
        F.max(F.coalesce(strict, F.lit(False))).alias("_strict"), F.max(F.coalesce(loose, F.lit(False))).alias("_loose"))
    any_strict = hits.agg(F.coalesce(F.max("_strict"), F.lit(False))).scalar()
    kept = hits.filter(F.when(any_strict, F.col("_strict")).otherwise(F.col("_loose"))).select(trace)
    return spans.join(kept, trace, "left_semi")


def search_with_fallback_counts(spans: DataFrame, strict: Column, loose: Column, trace: str = "trace_id") -> DataFrame:
    """``trace_counts`` of ``search_with_fallback`` in a single pass: spans and
    matches per trace once, the choice and the totals on one row of sums."""
    t = F.nullif(F.col(trace), F.lit(""))
    per = spans.groupBy(trace).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.coalesce(strict, F.lit(False))).alias("_s"), F.max(F.coalesce(loose, F.lit(False))).alias("_l"))
    sums = per.agg(*[e.alias(f"{name}_{k}") for k, hit in (("s", F.col("_s")), ("l", F.col("_l"))) for name, e in (
        ("traces", F.count(F.when(hit, t))), ("spans", F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0))))])
    pick = lambda name: F.when(F.col("spans_s") > 0, F.col(f"{name}_s")).otherwise(F.col(f"{name}_l")).alias(name)
    return sums.select(pick("traces"), pick("spans")).withColumn(
        "spans_per_trace", F.when(F.col("traces") > 0, F.col("spans") / F.col("traces")).otherwise(F.lit(0.0)))


def benchmark_tag_rows(spans: DataFrame, attrs: str = "attrs", needle: str = "benchmark") -> DataFrame:
    """P17 as rows: one (key, value) row per attribute whose lower-cased key
    contains ``needle``.  Explode then a plain filter — both stay in generated
    code, unlike a lambda over the map."""
    tags = spans.select(F.explode(attrs).alias("key", "value"))
    return tags.filter(F.lower("key").contains(needle))


def process_tag_traces(process_tags: DataFrame, a: tuple[str, str], b: tuple[str, str],
                       trace: str = "trace_id", process: str = "process_id") -> DataFrame:
    """Traces where one process carries both tags (P14), on flat
    ``(trace, process, key, value)`` rows: aggregate per (trace, process)."""
    k, v = F.col("key"), F.col("value")
    is_a, is_b = (k == a[0]) & (v == a[1]), (k == b[0]) & (v == b[1])
    # Only the two wanted tags matter: drop every other tag row before the shuffle.
    per_proc = process_tags.filter(is_a | is_b).groupBy(trace, process).agg(
        F.max((k == a[0]) & (v == a[1])).alias("_a"), F.max((k == b[0]) & (v == b[1])).alias("_b")
    )
    return per_proc.filter(F.col("_a") & F.col("_b")).select(trace).distinct()


def process_predicate_traces(spans: DataFrame, a: Column, b: Column, process: str, trace: str = "trace_id") -> DataFrame:
    """Traces where spans of one process satisfy both predicates (P14), from
    the span rows themselves: two flags per (trace, process)."""
    per_proc = spans.filter(a | b).groupBy(trace, process).agg(
        F.max(F.coalesce(a, F.lit(False))).alias("_a"), F.max(F.coalesce(b, F.lit(False))).alias("_b"))
    return per_proc.filter(F.col("_a") & F.col("_b")).select(trace).distinct()


def expected_vs_found(expected: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """Generated versus found per key (J5): full outer join of two aggregates.

    ``expected`` and ``found`` are ``(key..., expected)`` / ``(key..., found)``.
    """
    j = expected.join(found, list(key), "full")
    e = F.coalesce(F.col("expected"), F.lit(0)).cast("long")
    f = F.coalesce(F.col("found"), F.lit(0)).cast("long")
    return j.select(
        *key, e.alias("expected"), f.alias("found"), (e == f).alias("complete"),
        F.concat(f.cast("string"), F.lit("/"), e.cast("string")).alias("found_of_expected"),
    )


def backend_ratio(counts: DataFrame, backend: str, base: str, other: str, by: Sequence[str] = ()) -> DataFrame:
    """other / base for traces and spans, only where both are > 0.

    ``counts`` is the long table of A7 results with a ``backend`` column;
    pivot on the two named backends (fixed list, no discovery pass).
    """
    p = counts.groupBy(*by).pivot(backend, [base, other]).agg(
        F.first("traces").alias("traces"), F.first("spans").alias("spans")
    )
    bt, bs, ot, os_ = (F.col(f"{base}_traces"), F.col(f"{base}_spans"), F.col(f"{other}_traces"),
                       F.col(f"{other}_spans"))
    return p.select(
        *by,
        F.when((bt > 0) & (ot > 0), ot / bt).alias("trace_ratio"),
        F.when((bs > 0) & (os_ > 0), os_ / bs).alias("span_ratio"),
    )
