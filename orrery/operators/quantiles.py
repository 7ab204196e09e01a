"""Exact quantiles without putting a group in one task.

The reference's percentiles use Python's *exclusive* quantile definition,
which no built-in Spark aggregate computes, and an exact answer needs the
values at two ranks.  They are found by counting, not by numbering rows:

1. count per (group, value) with partial aggregation: ties are one row;
2. every value falls in a bucket that is a pure function of the value
   (``value_bucket``), so nothing is sampled and a recomputed plan gives the
   same buckets; counts per (group, bucket) and a running sum over them give
   each bucket's rank range;
3. only buckets that hold a wanted rank are joined back to the counted values
   and summed in value order, per (group, bucket).

A window task holds the buckets of one group (a few thousand per power of two
its values span) or the distinct values of one bucket (within 0.025 % of one
another), however many rows the group has.

Exclusive quantile i/m of n sorted values v[1..n] (n >= m):
``j = floor(i*(n+1)/m)``, ``d = i*(n+1) - j*m``,
``q = (v[j]*(m-d) + v[j+1]*d) / m``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per unit of the natural logarithm of a value.
BUCKETS_PER_LOG = 4096
# Beyond any |bucket| of a finite non-zero double: keeps the signs apart.
_OFFSET = 1 << 40


def value_bucket(value: Column | str) -> Column:
    """A long that never decreases as the value grows: the logarithm of the
    magnitude, cut finely, with the sign in front; NaN is above infinity, as
    Spark orders it."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    inf = F.lit(float("inf"))

    def size(x: Column) -> Column:
        return F.when(x == inf, F.lit(2 * _OFFSET)).otherwise(F.floor(F.log(x) * BUCKETS_PER_LOG).cast("long") + _OFFSET)

    return (
        F.when(F.isnan(v), F.lit(4 * _OFFSET))
        .when(v > 0, size(v))
        .when(v < 0, -size(-v))
        .otherwise(F.lit(0).cast("long"))
    )


def _excl_parts(i: int, m: int) -> tuple[Column, Column]:
    n1 = F.col("_n") + 1
    j = F.floor(F.lit(i) * n1 / F.lit(m)).cast("long")
    d = F.lit(i) * n1 - j * F.lit(m)
    return j, d


def quantile_table(df: DataFrame, group: Sequence[str], value: str, tiebreak: Sequence[str],
                   recent_ts: str | None, small_n: str, stats: bool = False) -> DataFrame:
    """Per group: n, p50 (median), p90, p99 with the chosen small-n rule; with
    ``stats`` also mean, min and max.

    small_n = "recent": below the quantile's n the most recent value (A11; the
    last by ``recent_ts``, then ``tiebreak``); small_n = "max": below it the
    maximum (A12).  Rows without a value don't count.
    """
    group = list(group)
    if not group:  # one group: a constant key keeps every step a keyed aggregate
        return quantile_table(df.withColumn("_all", F.lit(0)), ["_all"], value, tiebreak, recent_ts,
                              small_n, stats).drop("_all")
    recent = small_n == "recent"
    last = [F.max(F.struct(recent_ts, *tiebreak)).alias("_at")] if recent else []
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_k"), *last
    ).withColumn("_b", value_bucket("_v"))

    parts = [F.sum("_k").alias("_m")]
    parts += [F.max(F.struct("_at", "_v")).alias("_last")] if recent else []
    parts += [F.sum(F.col("_v").cast("double") * F.col("_k")).alias("_sum")] if stats else []
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    buckets = counted.groupBy(*group, "_b").agg(*parts).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_b").alias("_bb"), "_m",
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
        F.sum("_m").over(whole).alias("_n"),
        *([F.max("_last").over(whole)["_v"].alias("_recent")] if recent else []),
        *([(F.sum("_sum").over(whole) / F.sum("_m").over(whole)).alias("_mean")] if stats else []),
    )

    n = F.col("_n")
    j90, d90 = _excl_parts(9, 10)
    j99, d99 = _excl_parts(99, 100)
    ranks = {
        "_m_lo": F.floor((n + 1) / 2).cast("long"), "_m_hi": F.ceil((n + 1) / 2).cast("long"),
        "_a90": j90, "_b90": j90 + 1, "_a99": j99, "_b99": j99 + 1, "_low": F.lit(1), "_high": n,
    }
    wanted = F.lit(False)
    for r in ranks.values():
        wanted = wanted | ((r > F.col("_before")) & (r <= F.col("_before") + F.col("_m")))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    near = counted.join(buckets.filter(wanted), [*same, F.col("_b") == F.col("_bb")])
    upto = Window.partitionBy(*group, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_to", F.col("_before") + F.sum("_k").over(upto))

    def at(r: Column) -> Column:
        return F.max(F.when((r > F.col("_to") - F.col("_k")) & (r <= F.col("_to")), F.col("_v")))

    more = [c for c, there in (("_recent", recent), ("_mean", stats)) if there]
    found = near.groupBy(*group).agg(F.first("_n").alias("_n"), *[at(r).alias(k) for k, r in ranks.items()],
                                     *[F.first(c).alias(c) for c in more])
    p90 = (F.col("_a90") * (F.lit(10) - d90) + F.col("_b90") * d90) / F.lit(10)
    p99 = (F.col("_a99") * (F.lit(100) - d99) + F.col("_b99") * d99) / F.lit(100)
    small = F.col("_recent" if recent else "_high")
    return found.select(
        *group,
        n.cast("long").alias("n"),
        ((F.col("_m_lo") + F.col("_m_hi")) / F.lit(2)).alias("p50"),
        F.when(n >= 10, p90).otherwise(small).alias("p90"),
        F.when(n >= 100, p99).otherwise(small).alias("p99"),
        *([F.col("_mean").alias("mean"), F.col("_low").alias("min"), F.col("_high").alias("max")] if stats else []),
    )
