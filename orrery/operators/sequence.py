"""Per-series ordered operations that survive a hot series.

``lag`` and running sums need rows of one series in order.  Partitioning a
window by the series alone puts a hot series (say a third of all rows) into a
single task.  Here the window is partitioned by ``(series, time bucket)``; what
a bucket needs from earlier ones is carried over from a summary of one row per
series and bucket, whose own window has at most ``time span / bucket width``
rows per series: ten years of one-hour buckets are 88,000.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 86400
# Rows one window task should sort at most (per series and bucket).
TARGET_ROWS_PER_BUCKET = 2_000_000


def choose_bucket_seconds(df: DataFrame, keys: Sequence[str], ts: str,
                          target_rows: int = TARGET_ROWS_PER_BUCKET, probe_seconds: int = 3600) -> int:
    """Bucket width so that the hottest series holds about ``target_rows``
    rows per bucket, for callers that don't know their data's density.

    One job: rows per (series, hour) with map-side partial counts, reduced to
    the maximum.  Hourly density over the target gives sub-hour buckets (a
    series with a third of all rows is cut into many tasks); sparse data gets
    wide ones (fewer boundaries to stitch).  Results never depend on the width,
    only the task sizes do.
    """
    probe = time_bucket(ts, probe_seconds)
    peak = df.groupBy(*keys, probe.alias("_p")).count().agg(F.max("count")).first()[0]
    return max(1, probe_seconds * target_rows // peak) if peak else DEFAULT_BUCKET_SECONDS


def bucket_column(bucket_seconds: int) -> str:
    """Name of the bucket column; helpers that find it already present reuse
    it, so a chain of them keeps one ``(series, bucket)`` partitioning and the
    data is shuffled once."""
    return f"_bucket_{bucket_seconds}"


def _with_bucket(df: DataFrame, ts: str, bucket_seconds: int) -> tuple[DataFrame, str, bool]:
    b = bucket_column(bucket_seconds)
    if b in df.columns:
        return df, b, True
    return df.withColumn(b, time_bucket(ts, bucket_seconds)), b, False


def time_bucket(ts: Column | str, bucket_seconds: int) -> Column:
    """Integer bucket index of a timestamp (or timestamp_ntz) column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(bucket_seconds * 1_000_000)).cast("long")


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    sums: Mapping[str, Column | str] | None = None,
    previous: Sequence[str] = (),
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    prefix: str = "prev_",
    keep_bucket: bool = False,
) -> DataFrame:
    """Running sums and previous values of a series, all in one window pass.

    Each ``out: value`` of ``sums`` adds ``out``, the running sum of ``value``
    per series in ``order`` (inclusive).  Each name in ``previous`` adds its value
    on the series' previous row as ``prev_<name>``; a name in ``sums`` may be
    asked for too.  ``order`` is a total order within a series, and its first
    element grows with ``ts``, so buckets are ordered.

    The last row of each bucket, as the pass leaves it, is the bucket's summary;
    it reads the same shuffled rows as the pass, so Spark reuses that shuffle
    wherever both need the same columns.
    """
    keys, order, sums = list(keys), list(order), dict(sums or {})
    plain = [c for c in previous if c not in sums]
    data, b, had = _with_bucket(df, ts, bucket_seconds)
    for i, v in enumerate(sums.values()):
        data = data.withColumn(f"_v{i}", F.col(v) if isinstance(v, str) else v)
    in_bucket = Window.partitionBy(*keys, b).orderBy(*order)
    upto = in_bucket.rowsBetween(Window.unboundedPreceding, 0)
    local = data.select(
        "*", *[F.sum(f"_v{i}").over(upto).alias(f"_s{i}") for i in range(len(sums))],
        *[F.lag(c).over(in_bucket).alias(f"_p{i}") for i, c in enumerate(plain)],
        F.row_number().over(in_bucket).alias("_row"),
        F.lead(F.lit(1)).over(in_bucket).alias("_more"),
    )
    tails = local.filter(F.col("_more").isNull())
    by_bucket = Window.partitionBy(*keys).orderBy(b)
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(b).alias("_b"),
        *[F.sum(f"_s{i}").over(earlier).alias(f"_o{i}") for i in range(len(sums))],
        *[F.lag(c).over(by_bucket).alias(f"_c{i}") for i, c in enumerate(plain)],
        (F.row_number().over(by_bucket) > 1).alias("_before"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(b) == F.col("_b")]
    joined = local.join(carry, same, "left")
    first = F.col("_row") == 1

    out = {}
    for i, name in enumerate(sums):
        zero = F.lit(0).cast(local.schema[f"_s{i}"].dataType)
        out[name] = F.coalesce(F.col(f"_o{i}"), zero) + F.col(f"_s{i}")
    for i, name in enumerate(plain):
        out[prefix + name] = F.when(first, F.col(f"_c{i}")).otherwise(F.col(f"_p{i}"))
    for i, name in enumerate(sums):
        if name in previous:
            out[prefix + name] = F.when(~first | F.col("_before"), out[name] - F.col(f"_v{i}"))
    keep = [c for c in df.columns if c not in out] + ([b] if keep_bucket and not had else [])
    return joined.select(*keep, *[c.alias(k) for k, c in out.items()])


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], ts: str,
                  bucket_seconds: int = DEFAULT_BUCKET_SECONDS, prefix: str = "prev_",
                  keep_bucket: bool = False) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` on the previous row of the same series."""
    return ordered(df, keys, order, ts, None, cols, bucket_seconds, prefix, keep_bucket)


def with_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | str, out: str, ts: str,
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS, keep_bucket: bool = False) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per series in ``order`` (inclusive)."""
    return ordered(df, keys, order, ts, {out: value}, (), bucket_seconds, keep_bucket=keep_bucket)
