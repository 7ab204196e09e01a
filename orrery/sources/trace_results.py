"""Trace-search responses as rows: one row per returned trace (A7, A8, P14,
P15, P17 on the nested form).

A response file holds one JSON object with the traces under ``data`` or, where
that is missing or empty, under ``traces`` (§2.8: nested get with a fallback key).
Each trace: ``traceID``, ``spans[]`` (with tags), optional ``spanCount`` and
``processes`` (process id -> tags).  Reading with an explicit schema keeps
only these fields; ``explode`` turns the array into rows inside each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.tags import any_process_has_both, tags_with_key_containing
from orrery.operators.traces import result_span_count

KV = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))

TRACE = T.StructType([
    T.StructField("traceID", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("spanID", T.StringType()), T.StructField("tags", KV),
    ]))),
    T.StructField("spanCount", T.LongType()),
    T.StructField("processes", T.MapType(T.StringType(), T.StructType([T.StructField("tags", KV)]))),
])

RESPONSE = T.StructType([
    T.StructField("data", T.ArrayType(TRACE)),
    T.StructField("traces", T.ArrayType(TRACE)),
])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All traces of all response files under ``path``, with the file as
    ``response`` and the key they stood under as ``shape``."""
    r = spark.read.schema(RESPONSE).option("multiLine", "true").json(path)
    full = F.coalesce(F.size("data") > 0, F.lit(False))
    rows = r.select(
        F.col("_metadata.file_path").alias("response"),
        F.when(full, F.lit("data")).otherwise(F.lit("traces")).alias("shape"),
        F.explode(F.when(full, F.col("data")).otherwise(F.col("traces"))).alias("t"),
    )
    return rows.select("response", "shape", "t.*")


def span_count() -> Column:
    """Spans of a returned trace (A8).  Under ``data`` the list is whole, so its
    length counts, 0 included; under ``traces`` a summary may leave the list out,
    so its ``spanCount`` counts where there is none, and 1 where that is 0 too."""
    listed = F.coalesce(F.size("spans"), F.lit(0))
    return F.when(F.col("shape") == "data", F.greatest(listed, F.lit(0))).otherwise(
        result_span_count(F.col("spans"), F.col("spanCount"))).cast("long")


def labelled(results: DataFrame, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """Keep traces where one process carries both tags; if none in a response
    does, keep that response's traces as returned (P14 + P15)."""
    m = results.withColumn("_m", F.coalesce(any_process_has_both("processes", a, b), F.lit(False)))
    n = m.groupBy("response").agg(F.count_if("_m").alias("_n"))
    return m.join(n, "response").filter(F.col("_m") | (F.col("_n") == 0)).drop("_m", "_n")


def counts(results: DataFrame) -> DataFrame:
    """Traces and spans per response (A7 + A8)."""
    return results.groupBy("response").agg(
        F.count_distinct(F.nullif(F.col("traceID"), F.lit(""))).alias("traces"), F.sum(span_count()).alias("spans"))


def benchmark_tags(results: DataFrame) -> DataFrame:
    """Process tags whose key contains 'benchmark' (P17), one row per tag."""
    tags = results.select("response", "traceID", F.explode(F.map_values("processes")).alias("p"))
    return tags.select("response", "traceID", F.explode(tags_with_key_containing(F.col("p.tags"))).alias("tag")) \
        .select("response", "traceID", "tag.key", "tag.value")
