"""Log forwarding as a Structured Streaming job (S8-S10, P1-P3, P7, K1, K2,
ST1-ST4, ST10).

tail (whole files, or at most so many lines a micro-batch) -> UTF-8 repair ->
lenient parse -> relabel / keep -> micro-batch trigger -> write to all sinks,
then commit.

Delivery: the reference retries a batch with backoff and keeps it until a
send succeeds (at-least-once).  Here the checkpoint records offsets, and
``foreachBatch`` writes each batch to ``<sink>/batch_id=<id>`` in overwrite
mode, so a replayed batch replaces its own output: effectively once per sink.
The commit log (``streaming/commits.py``) makes the sinks one: a batch is visible
in all of them or in none, and carries its drop counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orrery.operators.logs import event_seconds, parse_lenient, parse_strict, payload
from orrery.session import scratch_path
from orrery.sources.tail import tail
from orrery.streaming.commits import atomic_writer

# Flush policy of the reference forwarder, 2,500 entries or
# 0.5 s (its alternative reader: 100 entries or 1.0 s).  The micro-batch
# trigger is the time rule; ``tail.ENTRIES`` the entry rule.
BATCH_INTERVAL = "500 milliseconds"


def tail_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Follow a directory of log files as a stream of raw lines.

    Each row: ``raw`` (line text) and ``source`` (file path).
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source"))


def forwarded_entries(lines: DataFrame, strict: bool = False, arrival: Column | None = None,
                      since: Column | float | None = None, with_rejects: bool = False) -> DataFrame:
    """Parse raw lines into forwarded entries (P1 or P2; blank lines dropped).

    ``since``: tail-from-now (S9) — keep entries whose event time (epoch s) is
    at or after this value.  ``with_rejects`` keeps what the strict parse
    rejects, marked; the lenient parse rejects nothing.
    """
    if strict:
        parsed = parse_strict(lines, "raw", arrival, with_rejects)
    else:
        parsed = parse_lenient(lines, "raw", arrival)
        parsed = parsed.withColumn("rejected", F.lit(False)) if with_rejects else parsed
    return parsed.filter(F.col("event_time") >= since) if since is not None else parsed


def entry_json(entries: DataFrame) -> DataFrame:
    """One JSON text per entry (K1 payload)."""
    return entries.select(payload(entries).alias("value"))


def idempotent_writer(sinks: Sequence[str], fmt: str = "text"):
    """``foreachBatch`` function writing a batch to every sink (K1, K2).

    Each sink gets ``<sink>/batch_id=<id>`` in overwrite mode, so a replay of
    the same batch id leaves the sink unchanged.  With two sinks the batch is
    persisted once and written twice; each sink is idempotent on its own
    (the pair is not atomic).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        many = len(sinks) > 1
        if many:
            batch.persist()
        try:
            for sink in sinks:
                batch.write.mode("overwrite").format(fmt).save(f"{sink}/batch_id={batch_id}")
        finally:
            if many:
                batch.unpersist()

    return write


def drop_counts() -> dict[str, Column]:
    """What every batch counts (ST10): lines that became entries, plain-text ones
    among them, lines rejected, and entries whose own time can't be read."""
    return {k: F.count_if(c) for k, c in (
        ("entries", ~F.col("rejected")), ("plain", F.col("plain")), ("rejected", F.col("rejected")), ("untimed", F.col("untimed")))}


def commit_log(checkpoint: str) -> str:
    """Where a forwarder's commit log lies: beside its checkpoint."""
    return checkpoint.rstrip("/") + "-commits"


def start_forwarder(spark: SparkSession, source: str, sinks: Sequence[str], checkpoint: str | None = None,
                    strict: bool = False, keep_service: str | None = None,
                    available_now: bool = False, name: str = "forwarder", since: float | None = None,
                    dead_letter: str | None = None, files_per_trigger: int | None = None,
                    entries_per_batch: int | None = None, from_end: bool = False, batches_per_trigger: int = 1) -> StreamingQuery:
    """Run the forwarder: tail ``source``, parse, optionally keep one service
    (P7 on the ``service`` field), deliver JSON lines to ``sinks``.

    ``entries_per_batch`` bounds a batch by lines, wherever in a file they
    end (ST1; ``tail.ENTRIES`` is the reference's number), ``files_per_trigger``
    by files.  A micro-batch is one batch, or up to ``batches_per_trigger`` (with
    ``entries_per_batch`` only; the same number as long as the checkpoint lives),
    which tasks read and deliver side by side, each with an id, folders and counts
    of its own.  ``from_end`` starts at what is there at first start, unread (S9;
    with ``entries_per_batch`` only); ``since`` (epoch seconds) drops entries of an
    earlier time of their own.  ``dead_letter`` receives the raw lines the strict
    parse rejects (ST4).

    Sinks and dead letters are read through ``commits.visible`` with
    ``commit_log(checkpoint)``, drops (ST10) by ``commits.totals``; they are in
    the query's progress too, under ``observedMetrics[name]``, where Spark keeps
    the last hundred batches.

    The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>`` —
    the shared folder the cluster names, so a restarted driver resumes.
    """
    if checkpoint is None:
        checkpoint = scratch_path(spark, f"streams/{name}")
    if from_end and not entries_per_batch:
        raise ValueError("from_end needs entries_per_batch")
    if batches_per_trigger > 1 and not entries_per_batch:
        raise ValueError("batches_per_trigger needs entries_per_batch")
    if entries_per_batch:
        lines = tail(spark, source, checkpoint.rstrip("/") + "-progress/offset.json", entries_per_batch, "end" if from_end else "beginning",
                     batches_per_trigger)
    else:
        lines = tail_lines(spark, source, files_per_trigger)
    entries = forwarded_entries(lines, strict=strict, since=since, with_rejects=True)
    if keep_service:
        entries = entries.filter(F.col("rejected") | (F.col("fields")["service"] == keep_service))
    entries = observed_drops(entries, name)
    kept = ~F.col("rejected")
    batch_no = ["batch"] if batches_per_trigger > 1 else []
    out = entries.select(*batch_no, payload(entries).alias("value"), "rejected", "raw", (kept & ~F.col("is_json")).alias("plain"),
                         (kept & F.col("is_json") & event_seconds(F.col("_time")).isNull()).alias("untimed"))
    targets = [*sinks, *([dead_letter] if dead_letter else [])]

    def split(batch: DataFrame) -> list[DataFrame]:
        sent = batch.filter(kept).select(*batch_no, "value")
        return [sent] * len(sinks) + [batch.filter("rejected").select(*batch_no, F.col("raw").alias("value"))] * bool(dead_letter)

    w = out.writeStream.foreachBatch(atomic_writer(targets, commit_log(checkpoint), drop_counts(), split, together=batches_per_trigger)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=BATCH_INTERVAL)
    return w.start()


def observed_drops(entries: DataFrame, name: str = "forwarder") -> DataFrame:
    """Drop accounting (ST10): per-batch metrics on the stream itself — lines
    that became entries, plain-text ones among them, lines rejected, and entries
    whose own time can't be read (they took the arrival time)."""
    rejected = F.col("rejected") if "rejected" in entries.columns else F.lit(False)
    return entries.observe(
        name,
        F.count_if(~rejected).alias("entries"),
        F.count_if(~F.col("is_json") & ~rejected).alias("plain"),
        F.count_if(rejected).alias("rejected"),
        F.count_if(F.col("is_json") & event_seconds(F.col("_time")).isNull()).alias("untimed"),
    )
