"""Event-time streaming aggregates (ST5-ST9, ST11).

Driver timestamps are ``timestamp_ntz``, which ``withWatermark`` rejects;
``event_time`` casts to ``timestamp`` (session time zone UTC).  All windows
are left-open ``(start, end]`` like the batch operators: ``window()`` is
applied to ``ts - 1 microsecond`` (the watermark is set on that column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.series import slide_steps

# Late-data limit of the reference log store: 168 hours.
LATE_LIMIT = "168 hours"


def event_time(df: DataFrame, ts: str = "ts", out: str = "event_ts") -> DataFrame:
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def _left_open(ts: str) -> Column:
    return F.col(ts) - F.expr("INTERVAL 1 MICROSECOND")


def reject_late(df: DataFrame, ts: str = "event_ts", limit_hours: int = 168, now: Column | None = None) -> DataFrame:
    """Stateless ingest rule (ST5): drop entries older than ``limit_hours``."""
    now = F.current_timestamp() if now is None else now
    return df.filter(F.col(ts) >= now - F.make_dt_interval(hours=F.lit(limit_hours)))


def retained(df: DataFrame, ts: str, days: int, now: Column | None = None) -> DataFrame:
    """Retention view (ST6): rows younger than ``days``.  On a table
    partitioned by date the predicate prunes whole partitions."""
    now = F.current_timestamp() if now is None else now
    return df.filter(F.col(ts) >= now - F.make_dt_interval(days=F.lit(days)))


def sliding_counts(df: DataFrame, keys: Sequence[str], width: str, slide: str, watermark: str = LATE_LIMIT,
                   ts: str = "event_ts") -> DataFrame:
    """Sliding ``count_over_time`` over a stream (ST8): watermark + window.

    Output column ``window_end`` plus keys and ``n``; append mode emits a
    window once the watermark passes its end.  Spark assigns each event to
    ``width / slide`` windows, so state and work grow by that ratio; to have the
    windows as rows of a table rather than of a stream, ``step_counts`` streamed
    to it and ``sliding_from_steps`` over it count each event once.
    """
    shifted = df.withColumn("_et", _left_open(ts)).withWatermark("_et", watermark)
    return (
        shifted.groupBy(F.window("_et", width, slide).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.end").alias("window_end"), *keys, "n")
    )


def step_counts(df: DataFrame, keys: Sequence[str], step: str, watermark: str = LATE_LIMIT,
                ts: str = "event_ts") -> DataFrame:
    """Counts per key and step (left-open tumbling windows): one state entry
    per (key, step), each event counted once.  Sliding counts of any width
    are sums of consecutive steps."""
    shifted = df.withColumn("_et", _left_open(ts)).withWatermark("_et", watermark)
    return (
        shifted.groupBy(F.window("_et", step).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.end").alias("window_end"), *keys, "n")
    )


def sliding_from_steps(steps: DataFrame, key: str, width_seconds: int, step_seconds: int) -> DataFrame:
    """Sliding counts (ST8) from the table that ``step_counts`` writes: a range
    frame over the steps, so no event is expanded into its windows."""
    us = F.unix_micros(F.col("window_end").cast("timestamp"))
    buckets = steps.select(key, (us / F.lit(step_seconds * 1_000_000)).cast("long").alias("_i"), F.col("n").alias("_n"))
    return slide_steps(buckets, width_seconds, step_seconds, key)


def periodic_snapshot(df: DataFrame, keys: Sequence[str], value: str, every: str = "2 seconds",
                      watermark: str = "10 seconds", ts: str = "event_ts") -> DataFrame:
    """Observation every ``every`` (ST7): last value of a counter per key and
    tumbling interval; of values at one time the largest."""
    shifted = df.withColumn("_et", _left_open(ts)).withWatermark("_et", watermark)
    return (
        shifted.groupBy(F.window("_et", every).alias("w"), *keys)
        .agg(F.max_by(value, F.struct(ts, value)).alias(value), F.count(F.lit(1)).alias("samples"))
        .select(F.col("w.end").alias("window_end"), *keys, value, "samples")
    )


def running_totals(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Monotone counter per series over the whole stream (ST9): a keyed
    streaming aggregate, emitted in update mode."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("samples"))


def deduplicated(df: DataFrame, ids: Sequence[str], watermark: str = LATE_LIMIT, ts: str = "event_ts") -> DataFrame:
    """Exactly-once per entry (ST11): duplicates that retries can cause are
    removed while their id is within the watermark."""
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(ids))
