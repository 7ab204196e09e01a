"""Exposition-format text (metrics pages) as tables.

Input is a line table ``(page keys..., line_no, line)``: a scraped page landed
as text and split into lines (``pages_to_lines``), so every page is handled by
the tasks that hold its lines and no page is assembled in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.keys import series_key
from orrery.functions.text import line_tokens, metric_name, py_float

# Label pair inside ``{...}``: name="value" with backslash escapes.
LABEL_PAIR = r'([a-zA-Z_][a-zA-Z0-9_]*)="((?:[^"\\]|\\.)*)"' 


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed scrape snapshots, one file per page: (path, text)."""
    return (
        spark.read.option("wholetext", "true").text(path)
        .select(F.col("_metadata.file_path").alias("page"), F.col("value").alias("text"))
    )


def pages_to_lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """Split page text into ``(line_no, line)`` rows, keeping the page columns."""
    keep = [c for c in pages.columns if c != text]
    return pages.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Per line: metric ``name`` and ``value`` (last whitespace token).

    Comment (``#``) and blank lines are dropped.  Lines with fewer than two
    tokens get a NULL name, values Python's ``float()`` rejects a NULL value;
    they are discarded after aggregation (``metric_sums``), so the tokenizer
    is never inlined into a pushed-down filter and run twice.
    """
    l = F.col(line)
    body = lines.filter(~l.startswith("#") & (F.trim(l) != ""))
    toks = line_tokens(l)
    two = F.size(toks) >= 2
    return body.select(
        "*",
        F.when(two, metric_name(toks[0])).alias("name"),
        F.when(two, py_float(F.element_at(toks, -1))).alias("value"),
    )


def metric_sums(lines: DataFrame, page: Sequence[str], line: str = "line") -> DataFrame:
    """``{name: sum of values over all label sets}`` per page.

    Names whose every value failed to parse do not appear (the check runs on
    the aggregated rows).
    """
    p = parse_lines(lines, line)
    agg = p.groupBy(*page, "name").agg(F.sum("value").alias("value"), F.count("value").alias("_n"))
    # value is NULL whenever name is, so one test on the aggregated count
    # drops both; a test on ``name`` would be pushed below the aggregate.
    return agg.filter(F.col("_n") > 0).drop("_n")


def selected_sums(lines: DataFrame, page: Sequence[str], ingested: tuple[str, str], dropped: tuple[str, str],
                  line: str = "line") -> DataFrame:
    """Sum of the last token over lines containing both needles.

    A line is counted as ingested if it holds both ``ingested`` needles, else
    as dropped if it holds both ``dropped`` needles.  Totals are float sums;
    the caller truncates them to integers (the reference's ``int()``).
    """
    l = F.col(line)
    toks = line_tokens(l)
    v = py_float(F.element_at(toks, -1))
    body = ~F.coalesce(F.get(toks, F.lit(0)), F.lit("#")).startswith("#") & (F.size(toks) >= 2)
    is_in = body & l.contains(ingested[0]) & l.contains(ingested[1])
    is_drop = body & ~is_in & l.contains(dropped[0]) & l.contains(dropped[1])
    return lines.groupBy(*page).agg(
        F.coalesce(F.sum(F.when(is_in, v)), F.lit(0.0)).alias("ingested"),
        F.coalesce(F.sum(F.when(is_drop, v)), F.lit(0.0)).alias("dropped"),
    )


def matched_value(lines: DataFrame, page: Sequence[str], literal: str, which: str = "first",
                  line: str = "line", line_no: str = "line_no") -> DataFrame:
    """Value of the first (S3) or last (S4) line containing ``literal``.

    Candidates are non-comment lines with the literal and at least two
    tokens.  first: the earliest candidate decides, an unparsable value
    there gives 0 (the scan stops at it); last: the latest candidate whose
    value parses.  Pages without a candidate give 0.
    """
    l = F.col(line)
    toks = line_tokens(l)
    two = F.size(toks) >= 2
    # Only cheap predicates filter rows; the token checks become NULL
    # orderings (ignored by min_by / max_by) so each line is split once.
    cand = lines.filter(l.contains(literal) & ~F.trim(l).startswith("#")).select(
        *page, line_no, two.alias("_two"), F.when(two, py_float(F.element_at(toks, -1))).alias("_v")
    )
    if which == "first":
        agg = F.min_by(F.coalesce("_v", F.lit(0.0)), F.when(F.col("_two"), F.col(line_no)))
    else:
        agg = F.max_by("_v", F.when(F.col("_two") & F.col("_v").isNotNull(), F.col(line_no)))
    return cand.groupBy(*page).agg(agg.alias("value")).filter(F.col("value").isNotNull())


def active_series(lines: DataFrame, page: Sequence[str], prefix: str, line: str = "line") -> DataFrame:
    """Lines starting with ``prefix`` and containing ``{``."""
    l = F.col(line)
    return lines.groupBy(*page).agg(F.count_if(l.startswith(prefix) & l.contains("{")).alias("series"))


def named_metrics(sums: DataFrame, page: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Pick named counters from S1 output, missing = 0 (S12): one row per
    page, one column per name."""
    cols = [F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0.0)).alias(n) for n in names]
    return sums.groupBy(*page).agg(*cols)


def prefix_sum(sums: DataFrame, page: Sequence[str], prefix: str, out: str = "value") -> DataFrame:
    """Sum of all metrics whose name starts with ``prefix`` (A14); 0 when none."""
    v = F.when(F.col("name").startswith(prefix), F.col("value"))
    return sums.groupBy(*page).agg(F.coalesce(F.sum(v), F.lit(0.0)).alias(out))


def total_drops(sums: DataFrame, page: Sequence[str], dropped_prefix: str, rejected_name: str) -> DataFrame:
    """Dropped (prefix sum) plus rejections (one named counter)."""
    rej = F.when(F.col("name") == rejected_name, F.col("value"))
    drop = F.when(F.col("name").startswith(dropped_prefix), F.col("value"))
    return sums.groupBy(*page).agg(
        (F.coalesce(F.sum(drop), F.lit(0.0)) + F.coalesce(F.sum(rej), F.lit(0.0))).alias("drops")
    )


def labelled_samples(lines: DataFrame, line: str = "line") -> DataFrame:
    """Per sample line: ``name``, ``labels`` map, canonical ``series_key`` and
    ``value`` (labelled mode: one row per series instead of one sum per name)."""
    p = parse_lines(lines, line)
    label_text = F.regexp_extract(F.col(line), r"\{(.*)\}", 1)
    labels = F.map_from_arrays(
        F.regexp_extract_all(label_text, F.lit(LABEL_PAIR), 1),
        F.regexp_extract_all(label_text, F.lit(LABEL_PAIR), 2),
    )
    return p.withColumn("labels", labels).withColumn("series_key", series_key(F.col("name"), F.col("labels")))


def series_sums(lines: DataFrame, page: Sequence[str], line: str = "line") -> DataFrame:
    """Sum per (page, series) — the labelled counterpart of ``metric_sums``."""
    p = labelled_samples(lines, line)
    agg = p.groupBy(*page, "series_key").agg(F.sum("value").alias("value"), F.count("value").alias("_n"))
    return agg.filter(F.col("_n") > 0).drop("_n")
