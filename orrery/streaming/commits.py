"""A commit log over a stream's sinks (K2, ST2, ST10).

A micro-batch is written to ``<sink>/batch_id=<id>`` of every sink, in overwrite
mode, and then one small file ``<log>/batch-<id>.json``, put in place by a
rename, says that all sinks hold it and what it counted.  Readers take the batches that
the log names: one that was written to some sinks only isn't seen in any, and a
replay after a restart writes all of them, and the same file, again.  Counts are
part of that file, so a batch counts once, however often it ran.

A micro-batch may hold several batches (``together``): each has an id, a folder in
every sink and counts of its own, and one file commits all of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "batch_id long, metric string, lines long"


def _place(spark: SparkSession, log: str, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/{name}" if name else log)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def withdraw(spark: SparkSession, log: str, batch_id: int) -> None:
    """Takes a batch out of sight, before a replay writes its sinks again."""
    files, target = _place(spark, log, f"batch-{batch_id:020d}.json")
    files.delete(target, False)


def record(spark: SparkSession, log: str, batch_id: int, counts: Mapping[int, Mapping[str, int]]) -> None:
    """Puts the micro-batch's file in place: a line per batch in it and count, the file whole or absent."""
    files, target = _place(spark, log, f"batch-{batch_id:020d}.json")
    _, passing = _place(spark, log, f"_batch-{batch_id:020d}.json")
    lines = [line for b, of in counts.items() for line in
             [{"batch_id": b, "metric": k, "lines": int(v)} for k, v in of.items()] or [{"batch_id": b}]]
    out = files.create(passing, True)
    try:
        out.write(bytearray("".join(json.dumps(x) + "\n" for x in lines).encode()))
    finally:
        out.close()
    if not files.rename(passing, target):
        raise OSError(f"can't put {target} in place")


def entries(spark: SparkSession, log: str) -> DataFrame:
    """(batch_id, metric, lines) of all committed batches; empty if there is none yet."""
    files, path = _place(spark, log, "")
    if not files.exists(path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(log)


def totals(spark: SparkSession, log: str) -> DataFrame:
    """(metric, lines) over all committed batches (ST10)."""
    counted = entries(spark, log).where(F.col("metric").isNotNull())
    return counted.groupBy("metric").agg(F.sum("lines").alias("lines"))


def visible(spark: SparkSession, log: str, sink: str, schema: str = "value string", fmt: str = "text") -> DataFrame:
    """Rows of a sink's committed batches, with ``batch_id``.  The join is on the
    partition column, so folders of batches that aren't committed are not read."""
    files, folders = _place(spark, sink, "batch_id=*")
    if not files.globStatus(folders):
        return spark.createDataFrame([], f"batch_id long, {schema}")
    rows = spark.read.schema(f"{schema}, batch_id long").format(fmt).option("basePath", sink).load(sink)
    return rows.join(entries(spark, log).select("batch_id").distinct(), "batch_id", "left_semi")


def atomic_writer(sinks: Sequence[str], log: str, counted: Mapping[str, Column], split: Callable[[DataFrame], Sequence[DataFrame]] | None = None,
                  fmt: str = "text", together: int = 1) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes a batch to all sinks and then commits it.

    ``split`` gives the rows of each sink, all rows by default; ``counted`` are
    aggregates over the batch that go into the log with it.  With ``together`` > 1 a
    micro-batch holds up to so many batches, numbered from 0 by its column ``batch``,
    which ``split`` keeps; their ids are those after ``together`` times the
    micro-batch's, so ``together`` stays the same as long as the sinks do.
    """

    def write_all(batch: DataFrame, micro_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            first = micro_id * together
            aggregates = [F.count(F.lit(1)).alias("_n"), *[c.alias(k) for k, c in counted.items()]]
            rows = batch.groupBy("batch").agg(*aggregates).orderBy("batch").collect()
            withdraw(spark, log, micro_id)
            parts = split(batch) if split else [batch] * len(sinks)
            for sink, part in zip(sinks, parts, strict=True):
                for k in range(together):  # what an earlier attempt left
                    files, folder = _place(spark, sink, f"batch_id={first + k}")
                    files.delete(folder, True)
                named = part.withColumn("batch_id", F.col("batch") + first).drop("batch")
                named.write.mode("append").partitionBy("batch_id").format(fmt).save(sink)
            record(spark, log, micro_id, {first + r["batch"]: {k: r[k] for k in counted} for r in rows})
        finally:
            batch.unpersist()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            counts = batch.agg(*[c.alias(k) for k, c in counted.items()]).first().asDict() if counted else {}
            withdraw(batch.sparkSession, log, batch_id)
            parts = split(batch) if split else [batch] * len(sinks)
            for sink, rows in zip(sinks, parts, strict=True):
                rows.write.mode("overwrite").format(fmt).save(f"{sink}/batch_id={batch_id}")
            record(batch.sparkSession, log, batch_id, {batch_id: counts})
        finally:
            batch.unpersist()

    return write_all if together > 1 else write
