"""Keyed state: counter rates, sliding counts, churn and heavy hitters of a stream
(A5, W4, ST8, A20, U3, T1).

All but the last run over panes, in two steps.  A native windowed aggregate first makes one row a series
and pane (a step of time, left-open), so that a hot series' samples are dealt by
time and each sample is looked at once.  The rows of a series then come in the
order of their panes, since a pane is given out when the watermark passes its
end, and a second step carries over what the next pane needs: keyed state, or for
churn, where that is the interval before, a native aggregate over both.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
US, MS = 1_000_000, 1_000
#: Parts that the series of ``rate_panes`` are dealt to; a part's state is one value.
PARTS = 256


def with_state_store(spark: SparkSession) -> None:
    """Sets the session to the state store that keyed state with timers needs; a
    commit writes what has changed, not the whole state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _panes(df: DataFrame, key: str, step: str, watermark: str, ts: str, **aggregates: Column) -> DataFrame:
    """One row per key and left-open pane, given out when the watermark passes its end."""
    shifted = df.withColumn("_et", F.col(ts) - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_et", watermark)
    grouped = shifted.groupBy(F.window("_et", step).alias("w"), key).agg(*[c.alias(k) for k, c in aggregates.items()])
    return grouped.select(F.col("w").alias("w"), F.unix_millis("w.end").alias("pane"), key, *aggregates)


class _Rates(StatefulProcessor):
    """State of a part of the series: the last sample's value of each, in one value.
    A row per pane, with the increase between the last sample before and its first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "keys array<string>, values array<decimal(38,6)>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        panes = pd.concat(list(rows)).sort_values("pane", kind="stable")
        held = dict(zip(*self.last.get(), strict=True)) if self.last.exists() else {}
        between = []
        for series, first, last in zip(panes["key"], panes["first"], panes["last"], strict=True):
            before = held.get(series)
            between.append(None if before is None else first - before if first >= before else first)
            held[series] = last
        self.last.update((list(held), list(held.values())))
        yield pd.DataFrame({"key": panes["key"], "pane": panes["pane"].astype("int64"), "samples": panes["samples"].astype("int64"),
                            "inside": panes["inside"], "between": pd.Series(between, index=panes.index, dtype=object)})

    def close(self) -> None:
        pass


def rate_panes(df: DataFrame, key: str, value: str, step: str, watermark: str, ts: str = "event_ts", tiebreak: str = "event_id") -> DataFrame:
    """A stream of counter samples as one row per series and pane: key, pane (its
    end in milliseconds), samples, inside (the increase between the pane's own
    samples) and between (that from the last sample before, null for the first
    pane of a series).  A value below the one before is a reset and counts whole.

    In a pane the samples are put in order of time, so files and batches may mix
    them as far as the watermark allows.  Series are dealt to PARTS by hash, so
    that a micro-batch asks for state once a part, not once a series.
    """
    with_state_store(df.sparkSession)
    sample = F.struct(F.col(ts).alias("t"), F.col(tiebreak).alias("i"), F.col(value).cast("decimal(38,6)").alias("v"))
    panes = _panes(df, key, step, watermark, ts, all=F.array_sort(F.collect_list(sample)))
    panes = panes.where(F.size("all") > 0)
    steps = F.zip_with(F.slice("all", F.lit(2), F.size("all")), F.slice("all", F.lit(1), F.size("all") - 1), lambda n, p: F.when(
        n["v"] >= p["v"], n["v"] - p["v"]).otherwise(n["v"]))
    zero = F.lit(0).cast("decimal(38,6)")
    panes = panes.select("w", "pane", F.col(key).cast("string").alias("key"), F.size("all").cast("long").alias("samples"), F.get("all", F.lit(0))["v"].alias("first"),
                         F.element_at("all", -1)["v"].alias("last"),
                         F.aggregate(steps, zero, lambda a, x: (a + x).cast("decimal(38,6)")).alias("inside"))
    dealt = panes.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    return dealt.groupBy("part").transformWithStateInPandas(
        _Rates(), "key string, pane long, samples long, inside decimal(38,6), between decimal(38,6)", "append", "eventTime")


def rates_from_panes(panes: DataFrame, key: str, seconds: int, end: Column) -> DataFrame:
    """Counter rates over ``(end - seconds, end]`` from what ``rate_panes`` wrote;
    ``end`` (milliseconds) and the range are whole panes.  As in the batch
    operator, the increase from before the range to its first sample doesn't
    count, and a series needs two samples."""
    inside = panes.where((F.col("pane") > end - seconds * MS) & (F.col("pane") <= end))
    first = F.min_by("between", "pane")  # from before the range
    got = inside.groupBy("key").agg(F.sum("samples").alias("samples"), F.sum("inside").alias("i"), F.sum("between").alias("b"), first.alias("f"))
    increase = (F.col("i") + F.coalesce("b", F.lit(0)) - F.coalesce("f", F.lit(0))).cast("double")
    return got.where("samples >= 2").select(F.col("key").alias(key), increase.alias("increase"), (increase / float(seconds)).alias("rate"), "samples")


class _Ring(StatefulProcessor):
    """State of a key: the counts of the panes that a window still covers, and the
    last grid end given out.  Ends without a pane of their own come by timer."""

    def __init__(self, step_ms: int, panes: int):
        self.step, self.panes = step_ms, panes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", "pane long", "n long")
        self.at = handle.getValueState("at", "pane long")

    def _held(self) -> dict[int, int]:
        return {k[0]: v[0] for k, v in self.ring.iterator()}

    def _closed(self, timer_values: object) -> int:
        """The last grid end that the watermark has passed: panes up to there are here."""
        return timer_values.getCurrentWatermarkInMs() // self.step * self.step

    def _advance(self, held: dict[int, int], at: int, to: int) -> tuple[list[tuple[int, int]], int]:
        """Grid ends after ``at`` up to ``to`` whose window holds something."""
        out = []
        while held and at < to:
            at += self.step
            for p in [p for p in held if p <= at - self.step * self.panes]:
                del held[p]
                self.ring.removeKey((p,))
            if held:
                out.append((at, sum(n for p, n in held.items() if p <= at)))
        return out, max(at, to) if not held else at

    def _given(self, key: tuple, out: list[tuple[int, int]]) -> pd.DataFrame:
        return pd.DataFrame({"key": pd.Series([key[0]] * len(out), dtype=object), "pane": pd.Series([p for p, _ in out], dtype="int64"),
                             "n": pd.Series([n for _, n in out], dtype="int64")})

    def _keep(self, held: dict[int, int], at: int) -> None:
        self.at.update((at,))
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if held:
            self.handle.registerTimer(at + self.step)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        panes = pd.concat(list(rows)).sort_values("pane")
        held, at, out = self._held(), self.at.get()[0] if self.at.exists() else 0, []
        for pane, n in zip(panes["pane"].tolist(), panes["n"].tolist(), strict=True):
            given, at = self._advance(held, at, pane - self.step)
            at = pane - self.step
            held[pane] = n
            self.ring.updateValue((pane,), (n,))
            last, at = self._advance(held, at, pane)
            out += given + last
        given, at = self._advance(held, at, self._closed(timerValues))
        self._keep(held, at)
        yield self._given(key, out + given)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        held, at = self._held(), self.at.get()[0]
        out, at = self._advance(held, at, self._closed(timerValues))
        self._keep(held, at)
        yield self._given(key, out)

    def close(self) -> None:
        pass


def sliding_counts(df: DataFrame, key: str, width_seconds: int, step_seconds: int, watermark: str, ts: str = "event_ts") -> DataFrame:
    """``count_over_time`` of a stream on a step grid (ST8): key, window_end, n for
    every grid end whose window ``(end - width, end]`` holds something, each once.

    Every event is counted in one pane; a window is the sum of the panes in the
    key's ring.  State is at most ``width / step`` panes a key.
    """
    if width_seconds % step_seconds:
        raise ValueError("window must be a multiple of the step")
    with_state_store(df.sparkSession)
    panes = _panes(df, key, f"{step_seconds} seconds", watermark, ts, n=F.count(F.lit(1)))
    ring = panes.select("w", "pane", F.col(key).cast("string").alias("key"), "n").groupBy("key").transformWithStateInPandas(
        _Ring(step_seconds * MS, width_seconds // step_seconds), "key string, pane long, n long", "append", "eventTime")
    return ring.select(F.col("key").alias(key), F.timestamp_millis("pane").alias("window_end"), "n")


def series_changes(df: DataFrame, key: str, step_seconds: int, watermark: str, ts: str = "event_ts") -> DataFrame:
    """Activity of series on a stream (A20, U3): key, pane (the interval's end in
    milliseconds; intervals are left-closed) and change: ``active``, ``appeared``
    (not active in the interval before) or ``disappeared`` (active in the one
    before, silent in this one, known when the watermark passes its end).

    A series takes state while it is active and for one interval more: two native
    windowed aggregates, one a series and interval, the other over the interval
    and the one before it, which is given out when the watermark passes its end.
    """
    with_state_store(df.sparkSession)
    seen = df.withWatermark(ts, watermark).groupBy(F.window(ts, f"{step_seconds} seconds").alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    seen = seen.select("w", F.unix_millis("w.end").alias("at"), F.col(key).cast("string").alias("key"))
    # an interval and the one before it: every row is the later half of one pair and the earlier half of the next
    pairs = seen.groupBy(F.window("w", f"{2 * step_seconds} seconds", f"{step_seconds} seconds").alias("pair"), "key").agg(
        F.max("at").alias("newest"), F.min("at").alias("oldest"))
    pane = F.unix_millis("pair.end")
    now, before = F.col("newest") == pane, F.col("oldest") < pane
    said = F.filter(F.array(F.when(now, "active"), F.when(now & ~before, "appeared"), F.when(~now, "disappeared")), lambda c: c.isNotNull())
    return pairs.select("key", pane.alias("pane"), F.explode(said).alias("change"))


def churn_from_changes(changes: DataFrame, step_seconds: int) -> DataFrame:
    """interval_start, active, appeared, disappeared per interval, from what ``series_changes`` wrote."""
    counted = changes.groupBy("pane").agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("active", "appeared", "disappeared")])
    start = F.timestamp_millis(F.col("pane") - step_seconds * MS).cast("timestamp_ntz")
    return counted.select(start.alias("interval_start"), "active", "appeared", "disappeared")


class _SpaceSaving(StatefulProcessor):
    """State of a partition of the keys: at most ``size`` counters (key, n, error).
    A key without a counter takes over the smallest one: its n is what the key may
    have had at most, and that of the counter taken over is its error."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counters = handle.getMapState("counters", "item string", "n long, error long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = {k[0]: (v[0], v[1]) for k, v in self.counters.iterator()}
        came = pd.concat(list(rows)).groupby("item")["n"].sum().sort_index().sort_values(ascending=False, kind="stable")
        changed, gone = set(), set()
        smallest = [(n, item) for item, (n, _) in held.items()]
        heapq.heapify(smallest)
        for item, n in came.items():
            if item in held:
                held[item] = (held[item][0] + int(n), held[item][1])
            elif len(held) < self.size:
                held[item] = (int(n), 0)
            else:
                while held.get(smallest[0][1], (None,))[0] != smallest[0][0]:
                    heapq.heappop(smallest)  # the counter has grown since, or is gone
                least, out = heapq.heappop(smallest)
                del held[out]
                gone.add(out)
                held[item] = (least + int(n), least)
            heapq.heappush(smallest, (held[item][0], item))
            changed.add(item)
        for item in gone - held.keys():
            if self.counters.containsKey((item,)):
                self.counters.removeKey((item,))
        for item in changed & held.keys():
            self.counters.updateValue((item,), held[item])
        yield pd.DataFrame({"part": [key[0]], "items": [list(held)], "n": [[v[0] for v in held.values()]], "error": [[v[1] for v in held.values()]]})

    def close(self) -> None:
        pass


def heavy_hitters(df: DataFrame, key: str, counters: int = 1024, parts: int = 64) -> DataFrame:
    """Space-Saving counters of a stream's keys (T1), a row a part of the keys and
    micro-batch that touched it: part, items, n, error.

    Keys are dealt to parts by hash, so counters of different parts never meet:
    together they are the counters of the whole stream.  A key's true count is at
    most its n and at least n - error; one without a counter has at most the
    smallest n of its part, which is at most the part's rows / ``counters``.  Rows
    are counted per key before they are dealt, so a key that holds a third of the
    stream sends a row a task.
    """
    with_state_store(df.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            found = batch.column(0).drop_null().value_counts()
            for item, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
                total[item] += n
            if len(total) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["item", "n"])
                total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["item", "n"])

    dealt = df.select(F.col(key).cast("string").alias("item")).mapInArrow(counted, "item string, n long").withColumn(
        "part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    return dealt.groupBy("part").transformWithStateInPandas(
        _SpaceSaving(counters), "part long, items array<string>, n array<long>, error array<long>", "update", "none")


def heaviest(said: DataFrame, k: int) -> DataFrame:
    """The k keys of largest n (ties by key) from the last row of every part: item,
    n, least (n - error), and sure, that no key outside can have had more."""
    each = said.select(F.inline(F.arrays_zip("items", "n", "error"))).select(F.col("items").alias("item"), "n", (F.col("n") - F.col("error")).alias("least"))
    top = each.orderBy(F.desc("n"), "item").limit(k + 1)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "item"))  # k + 1 rows
    ranked = top.withColumn("rank", rank).withColumn("next", F.max(F.when(F.col("rank") == k + 1, F.col("n"))).over(Window.partitionBy()))
    return ranked.where(F.col("rank") <= k).select("item", "n", "least", (F.col("least") >= F.coalesce("next", F.lit(0))).alias("sure"))


def run_to_end(stream: DataFrame, path: str, checkpoint: str, keep: Sequence[str] = ()) -> DataFrame:
    """Streams into Parquet files until all that is there is processed, and reads them."""
    out = stream.select(*keep) if keep else stream
    query = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(
        processingTime="0 seconds").start(path)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return stream.sparkSession.read.schema(out.schema).parquet(path)
