"""Metric-series operators: last value, top-k, rate, range counts, cardinality,
churn and histogram buckets (A2, A4, A5, A19, A20, A23, W1-W4, T1).

Inputs are sample tables ``(series_key, ts, value, ...)``.  Evaluation time
``end`` defaults to the newest sample of the input (a scalar subquery, so no
driver round trip); pass a literal to let Parquet skip row groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.keys import label_filter
from orrery.operators.sequence import DEFAULT_BUCKET_SECONDS, _with_bucket

US = 1_000_000


def resolve_end(df: DataFrame, ts: str = "ts", end=None) -> Column:
    """Evaluation time as a column: ``end`` itself if it is a Column, a literal
    if given, else max(ts) of ``df`` (scalar subquery)."""
    if isinstance(end, Column):
        return end
    if end is None:
        return df.select(F.max(ts)).scalar()
    return F.lit(end).cast(df.schema[ts].dataType)


def _us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _ceil_to(us: Column, step_us: int) -> Column:
    """Smallest multiple of ``step_us`` >= ``us`` (exact integer arithmetic)."""
    return us + F.pmod(-us, F.lit(step_us))


def range_bounds(df: DataFrame, seconds: int, ts: str = "ts", end=None) -> tuple[Column, Column | None]:
    """``(end - seconds, end]`` as columns the Parquet reader can use.

    Without ``end`` the range ends at the newest sample, so there is only the
    lower bound (the upper one is None): a scalar subquery that is the whole
    side of the comparison.  The difference of a subquery and an interval, or
    one of two subqueries that Spark merges, would not reach the scan.
    """
    gap = F.make_dt_interval(secs=F.lit(seconds))
    if end is None:
        return df.select(F.max(ts) - gap).scalar(), None
    e = resolve_end(df, ts, end)
    return e - gap, e


def in_range(df: DataFrame, seconds: int, end=None, ts: str = "ts", anchor: DataFrame | None = None) -> DataFrame:
    """Samples in ``(end - seconds, end]`` (P8); ``end`` defaults to the newest
    sample of ``anchor`` (default: ``df`` itself)."""
    low, high = range_bounds(df if anchor is None else anchor, seconds, ts, end)
    return df.filter(F.col(ts) > low if high is None else (F.col(ts) > low) & (F.col(ts) <= high))


def select_series(df: DataFrame, labels: Mapping[str, str] | None = None, labels_col: str = "labels") -> DataFrame:
    """Label equality selector."""
    return df.filter(label_filter(labels_col, labels)) if labels else df


def latest_per_series(df: DataFrame, key: str = "series_key", ts: str = "ts", value: str = "value",
                      tiebreak: str | None = None) -> DataFrame:
    """Last value of each series (W3): by ``ts``, then ``tiebreak``, then the
    larger value, so samples of one time can't make the result vary.  Partial
    aggregates leave a map task: a hot series costs one row each.
    """
    order = F.struct(F.col(ts), *([F.col(tiebreak)] if tiebreak else []), F.col(value))
    return df.groupBy(key).agg(F.max_by(value, order).alias("value"), F.max(ts).alias("last_ts"))


def top_k(df: DataFrame, k: int, by: str = "value", key: str = "series_key") -> DataFrame:
    """Top ``k`` rows by ``by`` desc, ties by key (T1) -> TakeOrderedAndProject."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(key)).limit(k)


def newest(df: DataFrame, n: int, ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """The ``n`` most recent rows (T2), order fixed by (ts desc, tiebreak)."""
    return df.orderBy(F.col(ts).desc(), F.col(tiebreak)).limit(n)


def topk_latest(samples: DataFrame, k: int = 10, seconds: int = 7 * 86400, labels=None, end=None) -> DataFrame:
    """Top k series by current value over a time range (P4 + P8 + W3 + T1)."""
    # anchored on the whole input, not the selection
    s = in_range(select_series(samples, labels), seconds, end, anchor=samples)
    return top_k(latest_per_series(s).select("series_key", "value"), k)


def counter_rate(counters: DataFrame, seconds: int, end=None, value: str = "counter", key: str = "series_key",
                 ts: str = "ts", tiebreak: str = "event_id",
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS, anchor: DataFrame | None = None) -> DataFrame:
    """Per-series counter rate over ``(end - seconds, end]``.

    increase = sum over consecutive samples in range of ``v - prev`` when
    ``v >= prev``, else ``v`` (counter reset); rate = increase / seconds.
    Series with fewer than two samples in range give no row.  No
    extrapolation to the range edges.  Exact when ``value`` is decimal.
    """
    s, b, _ = _with_bucket(in_range(counters, seconds, end, ts, anchor), ts, bucket_seconds)

    def step(v: Column, p: Column) -> Column:
        return F.when(v >= p, v - p).when(p.isNotNull(), v)

    # Increases inside each (series, bucket), reusing that partitioning when the
    # input carries it; then one row a bucket with its ends, and the increases
    # between the end of one and the start of the next.
    in_bucket = Window.partitionBy(key, b).orderBy(ts, tiebreak)
    s = s.select(key, b, ts, tiebreak, value, step(F.col(value), F.lag(value).over(in_bucket)).alias("_inc"))
    at = F.struct(ts, tiebreak)
    ends = s.groupBy(key, b).agg(
        F.sum("_inc").alias("_inc"), F.count(F.lit(1)).alias("_n"),
        F.min_by(value, at).alias("_first"), F.max_by(value, at).alias("_last"))
    between = step(F.col("_first"), F.lag("_last").over(Window.partitionBy(key).orderBy(b)))
    agg = ends.withColumn("_between", between).groupBy(key).agg(
        F.sum(F.coalesce("_inc", F.lit(0)) + F.coalesce("_between", F.lit(0))).alias("increase"), F.sum("_n").alias("samples"))
    return agg.filter(F.col("samples") >= 2).select(
        key,
        F.col("increase").cast("double").alias("increase"),
        (F.col("increase").cast("double") / F.lit(float(seconds))).alias("rate"),
        "samples",
    )


def topk_rate(counters: DataFrame, k: int = 10, seconds: int = 7 * 86400, labels=None, end=None,
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS, anchor: DataFrame | None = None) -> DataFrame:
    """Top k series by counter rate (P4 + P8 + A5 + T1) — the flagship query."""
    r = counter_rate(select_series(counters, labels), seconds, end, bucket_seconds=bucket_seconds,
                     anchor=counters if anchor is None else anchor)
    return top_k(r.select("series_key", "rate", "samples"), k, by="rate")


def count_tumbling(df: DataFrame, seconds: int, key: str = "series_key", ts: str = "ts") -> DataFrame:
    """Count per series in left-open windows ``(end - w, end]`` aligned to the epoch (A4)."""
    end_us = _ceil_to(_us(F.col(ts)), seconds * US)
    return (
        df.groupBy(key, F.timestamp_micros(end_us).cast("timestamp_ntz").alias("window_end"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def count_sliding(df: DataFrame, seconds: int, step_seconds: int, key: str = "series_key",
                  ts: str = "ts") -> DataFrame:
    """``count_over_time[w]`` evaluated on a step grid (A4 + W2).

    Every grid end ``t`` (a multiple of the step) whose window ``(t - w, t]``
    holds a sample gets one row.  Plan, with no row repeated per window:

    1. count per (series, step index) — map-side partial aggregation; the
       result has at most ``time span / step`` rows per series, however many
       samples a hot series has;
    2. after each non-empty step, add the empty grid points up to the next
       non-empty step or ``w/step - 1`` points, whichever comes first, so each
       grid point exists exactly once;
    3. one range-frame sum over the last ``w/step`` step indexes.
    """
    s_us = step_seconds * US
    idx = (_ceil_to(_us(F.col(ts)), s_us) / F.lit(s_us)).cast("long")  # exact: multiple of the step
    buckets = df.groupBy(key, idx.alias("_i")).agg(F.count(F.lit(1)).alias("_n"))
    return slide_steps(buckets, seconds, step_seconds, key)


def slide_steps(buckets: DataFrame, seconds: int, step_seconds: int, key: str) -> DataFrame:
    """Steps 2 and 3 of ``count_sliding`` over counts (key, _i, _n) per step index."""
    if seconds % step_seconds:
        raise ValueError("window must be a multiple of the step")
    k, s_us = seconds // step_seconds, step_seconds * US
    by_series = Window.partitionBy(key).orderBy("_i")
    gap = F.coalesce(F.lead("_i").over(by_series) - F.col("_i"), F.lit(k))
    fill = F.least(gap, F.lit(k)) - 1
    # the step itself (offset 0, with the count) and the empty points after it
    points = buckets.withColumn("_fill", fill).select(
        key, "_i", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_fill"))).alias("_d")
    ).select(
        key, (F.col("_i") + F.col("_d")).alias("_i"),
        F.when(F.col("_d") == 0, F.col("_n")).otherwise(F.lit(0).cast("long")).alias("_n"),
    )
    frame = Window.partitionBy(key).orderBy("_i").rangeBetween(-(k - 1), 0)
    counted = points.select(key, "_i", F.sum("_n").over(frame).alias("n"))
    return counted.select(
        key, F.timestamp_micros(F.col("_i") * F.lit(s_us)).cast("timestamp_ntz").alias("window_end"), "n"
    )


def count_last_step_total(df: DataFrame, seconds: int, step_seconds: int, end=None, key: str = "series_key",
                          ts: str = "ts", mode: str = "last_step", range_seconds: int | None = None,
                          anchor: DataFrame | None = None) -> DataFrame:
    """Range count, last emitted step per series, summed over series (A2).

    ``last_step``: a range query over ``[end - range, end]`` at ``step`` (grid
    ``end - j*step``) evaluates ``count_over_time[w]``; each series
    contributes its value at the last step where it emitted.  ``range``
    defaults to ``w``.  ``plain``: rows in ``(end - w, end]``.

    Closed form per series with last sample L: the last emitted step is
    ``end`` if ``L > end - w``, else the largest grid step below ``L + w``;
    series whose step falls before ``end - range`` contribute nothing.
    """
    if mode == "plain":
        return in_range(df, seconds, end, ts, anchor).agg(F.count(F.lit(1)).alias("total"))
    rng = seconds if range_seconds is None else range_seconds
    w_us, s_us, r_us = seconds * US, step_seconds * US, rng * US
    # Only samples that can fall in some counted window: (end - range - w, end].
    low, high = range_bounds(df if anchor is None else anchor, rng + seconds, ts, end)
    end_us = _us(low) + F.lit(r_us + w_us) if high is None else _us(high)
    u = _us(F.col(ts))
    recent = df.filter(F.col(ts) > low if high is None else (F.col(ts) > low) & (F.col(ts) <= high))
    last = recent.groupBy(key).agg(F.max(u).alias("_L"))
    g = F.when(F.col("_L") > end_us - F.lit(w_us), end_us).otherwise(
        end_us - F.lit(s_us) * (F.floor((end_us - (F.col("_L") + F.lit(w_us))) / F.lit(s_us)).cast("long") + 1)
    )
    steps = last.select(key, g.alias("_g")).filter(F.col("_g") >= end_us - F.lit(r_us))
    hit = recent.join(steps, key).filter((u > F.col("_g") - F.lit(w_us)) & (u <= F.col("_g")))
    return hit.agg(F.count(F.lit(1)).alias("total"))


def series_cardinality(df: DataFrame, by: Sequence[str] = (), key: str = "series_key",
                       approximate: bool = False) -> DataFrame:
    """Distinct series per group (A19); ``approximate`` uses HyperLogLog++."""
    f = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.groupBy(*by).agg(f.alias("series"))


def series_churn(df: DataFrame, seconds: int = 86400, key: str = "series_key", ts: str = "ts") -> DataFrame:
    """Series active / appeared / disappeared per interval.

    appeared: active in interval i, not in i-1; disappeared: active in i-1,
    not in i (reported at i).  One pass: an active (series, interval) says "here"
    in its interval and "was here" in the next; per (series, interval) the two
    flags meet, per interval they are counted.
    """
    w_us = seconds * US
    u = _us(F.col(ts))
    active = df.select(key, ((u - F.pmod(u, F.lit(w_us))) / F.lit(w_us)).cast("long").alias("_i")).distinct()
    said = active.select(key, F.inline(F.array(
        F.struct(F.col("_i"), F.lit(True).alias("_here")), F.struct((F.col("_i") + 1).alias("_i"), F.lit(False).alias("_here")))))
    met = said.groupBy(key, "_i").agg(F.max("_here").alias("_here"), F.max(~F.col("_here")).alias("_was"))
    here, was = F.col("_here"), F.col("_was")
    return met.groupBy("_i").agg(
        F.count_if(here).alias("active"), F.count_if(here & ~was).alias("appeared"), F.count_if(was & ~here).alias("disappeared"),
    ).select(
        F.timestamp_micros(F.col("_i") * F.lit(w_us)).cast("timestamp_ntz").alias("interval_start"),
        "active", "appeared", "disappeared",
    )


def histogram_buckets(df: DataFrame, bounds: Sequence[float], key: str = "series_key",
                      value: str = "value") -> DataFrame:
    """Cumulative bucket counts ``count(value <= le)`` per series."""
    aggs = [F.count_if(F.col(value) <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(key).agg(*aggs)
    pairs = ", ".join(f"cast('{float(b)!r}' as double), _b{i}" for i, b in enumerate(bounds))
    return wide.select(key, F.expr(f"stack({len(bounds)}, {pairs}) as (le, cum_count)"))


def merged_buckets(buckets: DataFrame, by: Sequence[str], key: str = "series_key") -> DataFrame:
    """Cumulative buckets (by, le, cum_count) of several series as one.

    Where the series' bounds differ, a series takes part at bounds of the others
    with what it would hold there if its values were spread evenly between its
    own bounds (from 0 on below a positive first one).  ``+Inf`` is infinity; what
    a series holds above its last finite bound is spread nowhere, it joins at
    ``+Inf``.  There is a row per series and bound of its group meanwhile.
    """
    if not by:
        return merged_buckets(buckets.withColumn("_all", F.lit(0)), ["_all"], key).drop("_all")
    own = buckets.select(*by, key, "le", F.col("le").alias("_le"), F.col("cum_count").cast("double").alias("_c"))
    grid = own.select(*by, key).distinct().join(own.select(*by, "le").distinct(), list(by))
    series = Window.partitionBy(*by, key).orderBy("le")
    upto, after = series.rowsBetween(Window.unboundedPreceding, 0), series.rowsBetween(1, Window.unboundedFollowing)
    at = grid.join(own, [*by, key, "le"], "left").select(
        *by, "le", *[F.last(c, ignorenulls=True).over(upto).alias(f"_low{c}") for c in ("_le", "_c")],
        *[F.first(c, ignorenulls=True).over(after).alias(f"_high{c}") for c in ("_le", "_c")])
    high, base = F.col("_high_le"), F.coalesce("_low_c", F.lit(0.0))
    low = F.coalesce("_low_le", F.least(high, F.lit(0.0)))
    share = F.when(high > low, F.greatest(F.col("le") - low, F.lit(0.0)) / (high - low)).otherwise(F.lit(0.0))
    held = F.when(high.isNull() | (high == F.lit(float("inf"))), base).otherwise(base + (F.col("_high_c") - base) * share)
    return at.groupBy(*by, "le").agg(F.sum(held).alias("cum_count"))


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Quantile ``q`` from cumulative buckets (by, le, cum_count) by interpolation
    in the bucket that its rank, q times the total, falls in (A23).

    The first bucket begins at 0 if its bound is positive, else its bound is the
    answer; a rank above the last finite bound gives that bound; a group without
    values, or without a finite bound, gives null.  Buckets of no values are
    passed over.  Needs the ``+Inf`` bucket only where values lie above the others.
    """
    group = Window.partitionBy(*by)
    c, le = F.col("_c"), F.col("le")
    rows = buckets.select(*by, "le", F.col("cum_count").cast("double").alias("_c"))
    rows = rows.select(*by, "le", "_c", F.lag("le").over(group.orderBy("le")).alias("_before"),
                       F.coalesce(F.lag("_c").over(group.orderBy("le")), F.lit(0.0)).alias("_under"), F.max("_c").over(group).alias("_total"))
    rank = F.lit(float(q)) * F.col("_total")
    low = F.coalesce("_before", F.least(le, F.lit(0.0)))
    inside = low + (le - low) * ((rank - F.col("_under")) / (c - F.col("_under")))
    value = F.when(le == F.lit(float("inf")), F.col("_before")).when((le <= low) | (c <= F.col("_under")), le).otherwise(inside)
    hit = (c >= rank) & (c > 0)
    return rows.groupBy(*by).agg(F.min_by(F.when(hit, value), F.when(hit, le)).alias("quantile"), F.max("_total").alias("count"))
