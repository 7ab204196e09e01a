"""Stored layout for sample / log / span tables at scale.

Tables are written partitioned by UTC date, and inside each date clustered by
the series key and sorted by (series, ts): time-range queries read only the
dates they touch (partition pruning), and per-series scans find each series
in few row groups (min/max statistics on the sort key).  Retention (ST6) is a
date predicate on the same column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_COL = "date"


def with_date(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(DATE_COL, F.to_date(F.col(ts)))


def write_partitioned(df: DataFrame, path: str, ts: str = "ts", key: str = "series_key",
                      rows_per_file: int = 5_000_000, mode: str = "overwrite") -> None:
    """Write ``df`` partitioned by date, clustered and sorted by (key, ts).

    A date gets as many files as its rows need (counted first; one row per
    date).  Rows go to a file by key and hour, so a key that holds most of a date
    is split over its files too, and no task gets more than about
    ``rows_per_file`` rows unless a key has that many in an hour.
    """
    d = with_date(df, ts)
    files = d.groupBy(DATE_COL).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_files"))
    hour = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(3_600_000_000))
    dealt = d.join(files, DATE_COL).withColumn("_f", F.pmod(F.xxhash64(F.col(key), hour), F.col("_files")))
    (
        dealt.repartition(DATE_COL, "_f").sortWithinPartitions(DATE_COL, "_f", key, ts).drop("_f", "_files")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_COL)
        .parquet(path)
    )


def read_range(spark: SparkSession, path: str, start: dt.datetime | None = None, end: dt.datetime | None = None,
               ts: str = "ts") -> DataFrame:
    """Read rows with ``start < ts <= end``; the date predicate prunes
    partitions before any file is opened."""
    df = spark.read.parquet(path)
    cond: Column | None = None
    if start is not None:
        cond = (F.col(DATE_COL) >= F.lit(start.date())) & (F.col(ts) > F.lit(start))
    if end is not None:
        c = (F.col(DATE_COL) <= F.lit(end.date())) & (F.col(ts) <= F.lit(end))
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df
