"""Benchmark-run artifacts: manifests and observations as tables
(S6, S7, K3, K4, U1).

A run directory holds ``manifest.json`` (one object) and ``observations.json``
(a JSON array of observation objects); ``write_run`` writes both.  Explicit schemas keep the scan to the
fields used and drop debug sub-objects.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.operators.quantiles import quantile_table

INGEST = T.StructType([
    T.StructField(n, T.DoubleType()) for n in (
        "samples_ingested", "samples_appended", "samples_dropped", "lines_ingested", "rows_ingested",
        "lines_dropped", "spans_received", "spans_dropped", "series_count",
    )
])

SERVICE = T.StructType([
    T.StructField("docker_stats", T.StructType([
        T.StructField("cpu_percent", T.DoubleType()),
        T.StructField("memory_bytes", T.LongType()),
        T.StructField("memory_percent", T.DoubleType()),
    ])),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("ingest_metrics", INGEST),
    T.StructField("storage_size_bytes", T.LongType()),
])

QUERY = T.StructType([
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("trace_count", T.LongType()),
    T.StructField("span_count", T.LongType()),
])

OBSERVATION = T.StructType([
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("scenario", T.StringType()),
    T.StructField("load_volume", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("services", T.MapType(T.StringType(), SERVICE)),
    T.StructField("queries", T.MapType(T.StringType(), QUERY)),
])

MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("scenarios", T.ArrayType(T.StringType())),
    T.StructField("host_info", T.StructType([
        T.StructField("platform", T.StringType()), T.StructField("ram_gb", T.IntegerType()),
    ])),
    T.StructField("load_volume", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("final_storage_bytes", T.MapType(T.StringType(), T.LongType())),
    T.StructField("query_latencies", T.MapType(T.StringType(), T.StructType([
        T.StructField("p50", T.DoubleType()), T.StructField("p90", T.DoubleType()),
        T.StructField("p99", T.DoubleType()),
    ]))),
])


def _run_id() -> F.Column:
    """The folder of the run, from ``<run>/observations.json`` or, as ``write_run``
    lays it out, ``run_id=<run>/file=observations.jsonl/part-...``."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/(?:run_id=)?([^/]+)/(?:file=)?(?:manifest|observations)\.jsonl?(?:/[^/]+)?$", 1)


def _there(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def read_observations(spark: SparkSession, runs_root: str) -> DataFrame:
    """All observations of all runs under ``runs_root``, with ``run_id`` from the
    folder name (S6).  A run is one JSON array (``observations.json``), which a
    single task reads, or part files of JSON lines (``observations.jsonl``)."""
    reader = spark.read.schema(OBSERVATION)
    forms = [(os.path.join(runs_root, "*", "*observations.json"), "true"), (os.path.join(runs_root, "*", "*observations.jsonl"), "false")]
    found = [reader.option("multiLine", whole).json(p) for p, whole in forms if _there(spark, p)]
    found = found or [reader.option("multiLine", "true").json(forms[0][0])]  # the reader's own error
    each = [df.withColumn("run_id", _run_id()) for df in found]
    return each[0] if len(each) == 1 else each[0].unionByName(each[1])


def read_manifests(spark: SparkSession, runs_root: str) -> DataFrame:
    df = spark.read.schema(MANIFEST).option("multiLine", "true").json(os.path.join(runs_root, "*", "*manifest.json"))
    return df.withColumn("_mtime", F.col("_metadata.file_modification_time")).withColumn("run_dir", _run_id())


def latest_run(manifests: DataFrame) -> DataFrame:
    """The run whose manifest was modified last (S7, T3): one row or none; of
    runs modified at one time the last by name."""
    return manifests.agg(F.max_by(F.col("run_dir"), F.struct("_mtime", "run_dir")).alias("run_id")).filter(
        F.col("run_id").isNotNull()
    )


def service_obs(observations: DataFrame) -> DataFrame:
    """Explode services: one row per (observation, service) (A17 input)."""
    e = observations.select("run_id", "timestamp", "scenario", F.explode("services").alias("service", "s"))
    return e.select(
        "run_id", "scenario", F.timestamp_micros((F.col("timestamp") * 1e6).cast("long")).alias("ts"),
        "service",
        F.coalesce(F.col("s.docker_stats.cpu_percent"), F.lit(0.0)).alias("cpu_percent"),
        F.coalesce(F.col("s.docker_stats.memory_bytes"), F.lit(0)).alias("memory_bytes"),
        "s.ingest_metrics.*",
        F.col("s.storage_size_bytes").alias("storage_size_bytes"),
        F.col("s.metrics").alias("metrics"),
    )


def query_obs(observations: DataFrame) -> DataFrame:
    """Explode queries: one row per (observation, query key)."""
    e = observations.select("run_id", "timestamp", "scenario", F.explode("queries").alias("query_key", "q"))
    return e.select(
        "run_id", "scenario", F.timestamp_micros((F.col("timestamp") * 1e6).cast("long")).alias("ts"),
        "query_key", "q.*",
    )


def union_observations(*frames: DataFrame) -> DataFrame:
    """Scenario observations plus the final snapshot."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def manifests(observations: DataFrame, timestamp: str, platform: str | None = None, ram_gb: int | None = None) -> DataFrame:
    """A manifest per run from its observations: scenarios in order of
    appearance, the last load volume and storage sizes seen, and latency
    percentiles per query (median; exclusive p90 and p99; A11).

    The maps hold one entry per service or query of a run.
    """
    services = service_obs(observations)
    last = services.filter(F.col("storage_size_bytes") > 0).groupBy("run_id", "service").agg(
        F.max_by("storage_size_bytes", F.struct("ts", "storage_size_bytes")).alias("size"))
    storage = last.groupBy("run_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("service", "size")))).alias("final_storage_bytes"))
    ok = query_obs(observations).filter("success")
    q = quantile_table(ok, ["run_id", "query_key"], "latency_ms", ["ts"], "ts", "recent")
    latencies = q.groupBy("run_id").agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("query_key", F.struct("p50", "p90", "p99").alias("l"))))).alias("query_latencies"))
    load = observations.groupBy("run_id").agg(F.max_by("load_volume", F.col("timestamp")).alias("load_volume"))
    seen = observations.groupBy("run_id", "scenario").agg(F.min("timestamp").alias("at"))
    order = seen.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("at", "scenario"))).alias("s"))
    return load.join(order, "run_id").join(storage, "run_id", "left").join(latencies, "run_id", "left").select(
        "run_id", F.lit(timestamp).alias("timestamp"), F.col("s.scenario").alias("scenarios"),
        F.struct(F.lit(platform).cast("string").alias("platform"), F.lit(ram_gb).cast("int").alias("ram_gb")).alias("host_info"),
        "load_volume", "final_storage_bytes", "query_latencies")


def write_run(observations: DataFrame, manifest: DataFrame, root: str) -> None:
    """Run artifacts (K3) under ``root``, read back by ``read_observations`` and
    ``read_manifests``: per run part files of JSON lines, one an observation, dealt
    by time and in order of time within a part, and one manifest object.  No task
    holds a run; its parts are as many as its observations need."""
    fields = [f.name for f in OBSERVATION.fields]
    lines = observations.select("run_id", "timestamp", F.lit("observations.jsonl").alias("file"), F.to_json(F.struct(*fields)).alias("value"))
    dealt = lines.repartitionByRange("run_id", "timestamp").sortWithinPartitions("run_id", "timestamp").drop("timestamp")
    dealt.write.mode("append").partitionBy("run_id", "file").text(root)
    one = manifest.select("run_id", F.lit("manifest.json").alias("file"), F.to_json(F.struct(*[f.name for f in MANIFEST.fields])).alias("value"))
    one.write.mode("append").partitionBy("run_id", "file").text(root)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Summary tables (K4) as Parquet, one folder per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(path, name))
