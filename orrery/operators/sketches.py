"""Mergeable summaries: quantiles from logarithmic buckets (A11, A12) and distinct
counts from HyperLogLog sketches (A19).

Both are made once per day and group and stored; any range of days is answered
from the stored rows, without the samples.  The exact operators stay
(``quantiles.quantile_table``, ``series.series_cardinality``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative error of a quantile.
ERROR = 0.01
#: log2 of the registers of a distinct-count sketch.
LG_K = 12


def _gamma(error: float) -> float:
    return (1 + error) / (1 - error)


def log_bucket(value: Column, error: float = ERROR) -> Column:
    """Bucket of a positive value: all values of a bucket are within ``error`` of its middle."""
    return F.ceil(F.log(value) / math.log(_gamma(error))).cast("int")


def quantile_sketch(df: DataFrame, by: Sequence[str], value: str, error: float = ERROR) -> DataFrame:
    """(by, sign, bucket, n): counts per logarithmic bucket of the magnitude.

    Rows add up: sketches of two sets are the sketch of both.  A group has at most
    ``log(largest / smallest) / (2 * error)`` rows for either sign.  Null and NaN
    values don't count; infinities are rejected by the cast of their bucket.
    """
    v = F.col(value).cast("double")
    sign = F.signum(v).cast("int")
    bucket = F.when(v == 0, F.lit(0)).otherwise(log_bucket(F.abs(v), error))
    some = df.where(F.col(value).isNotNull() & ~F.isnan(v))
    return some.groupBy(*by, sign.alias("sign"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged_quantiles(sketch: DataFrame, by: Sequence[str], fractions: dict[str, tuple[int, int]], error: float = ERROR) -> DataFrame:
    """Per group n and the exclusive quantiles ``name: (i, m)`` of all rows of the
    sketch that agree in ``by``.

    The two values that an exclusive quantile lies between are each known within
    ``error`` of their size, and so is the quantile for values of one sign.
    Ranks below the first or above the last value take that value.
    """
    gamma = _gamma(error)
    middle = F.col("sign") * F.pow(F.lit(gamma), F.col("bucket").cast("double")) * (2 / (1 + gamma))
    merged = sketch.groupBy(*by, "sign", "bucket").agg(F.sum("n").alias("n")).withColumn("v", F.when(F.col("sign") == 0, 0.0).otherwise(middle))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ranked = merged.withColumn("to", F.sum("n").over(group.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "total", F.sum("n").over(group))

    def at(rank: Column) -> Column:
        r = F.greatest(F.lit(1).cast("long"), F.least(rank, F.col("total")))
        return F.max(F.when((r > F.col("to") - F.col("n")) & (r <= F.col("to")), F.col("v")))

    aggregates = [F.max("total").alias("n")]
    for name, (i, m) in fractions.items():
        j = F.floor(F.lit(i) * (F.col("total") + 1) / F.lit(m)).cast("long")
        aggregates += [at(j).alias(f"_{name}_a"), at(j + 1).alias(f"_{name}_b")]
    got = ranked.groupBy(*by).agg(*aggregates)
    out = []
    for name, (i, m) in fractions.items():
        part = F.lit(i) * (F.col("n") + 1) % F.lit(m)
        out.append(((F.col(f"_{name}_a") * (F.lit(m) - part) + F.col(f"_{name}_b") * part) / F.lit(m)).alias(name))
    return got.select(*by, "n", *out)


def distinct_sketch(df: DataFrame, by: Sequence[str], key: str, lg_k: int = LG_K) -> DataFrame:
    """(by, sketch): a HyperLogLog sketch of ``key`` per group, a few KB."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, F.lit(lg_k)).alias("sketch"))


def merged_distinct(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimated distinct keys of all sketches that agree in ``by``."""
    return sketch.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("series"))


def distinct_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that an estimate keeps to within so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)
