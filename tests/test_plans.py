"""Plan-shape checks: what the physical plans must (not) contain at any scale."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "collect_list", "collect_set"]


def plan(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def plans(spark):
    every = E.queries()
    return {name: plan(spark, every[name](spark, SF_SMALL)) for name in E._catalog.queries()}


def test_no_pairs_no_python_no_collect(plans):
    for name, p in plans.items():
        for bad in FORBIDDEN:
            assert bad not in p, f"{name}: {bad}"


def test_label_and_time_filters_reach_the_scan(plans):
    p = plans["topk_latest"]
    assert "EqualTo(event_type,click)" in p
    scan = re.search(r"ReadSchema: (struct<[^\n]*>)", p).group(1)
    assert "props" not in scan


def test_tag_search_pushed_to_parquet(plans):
    p = plans["trace_span_counts"]
    assert "EqualTo(l_returnflag,R)" in p and "EqualTo(l_linestatus,F)" in p
    assert "o_orderstatus" not in p  # the orders join is not needed here


def test_ordered_ops_split_hot_series_by_time_bucket(plans):
    """lag / running sum over the samples are partitioned by (series, day),
    never by the series alone, so a hot series spreads over many tasks."""
    p = plans["topk_rate"]
    lag = re.findall(r"lag\(counter#\d+[^\n]*?windowspecdefinition\(([^,]*), ([^,]*),", p)
    run = re.findall(r"sum\(_v0#\d+\) windowspecdefinition\(([^,]*), ([^,]*),", p)
    assert lag and run
    for key, second in lag + run:
        assert key.startswith("series_key") and second.startswith("_bucket_"), (key, second)


def test_streaming_sinks_are_idempotent(spark, tmp_path):
    from orrery.streaming.forwarder import idempotent_writer
    df = spark.createDataFrame([("a",)], "value string")
    w = idempotent_writer([str(tmp_path / "s")], fmt="text")
    w(df, 3)
    w(df, 3)
    assert spark.read.text(str(tmp_path / "s")).count() == 1


@pytest.mark.parametrize("name", ["topk_latest", "count_over_time_plain_total", "count_over_time_last_step_total",
                                  "log_window_count", "log_range_count_total"])
def test_time_ranges_prune_the_scan(plans, name):
    """The lower bound reaches the Parquet reader (the upper one is the newest row)."""
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plans[name])
    scans = [p for p in pushed if re.search(r"GreaterThan(OrEqual)?\(ts,", p)]
    # each scan of the rows; others read the newest ts
    assert scans and all(p in scans for p in pushed if p), pushed


def final_plan(spark, df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().executedPlan().toString()


@pytest.mark.parametrize("name", ["topk_rate", "cpu_from_deltas", "series_churn", "count_over_time_sliding",
                                  "trace_process_exists", "trace_search_with_fallback"])
def test_one_pass_over_the_rows(spark, name):
    """The rows are read once; a further scan reads ts alone (for the newest sample)."""
    p = final_plan(spark, E.queries()[name](spark, SF_SMALL))
    read = [c for c in re.findall(r"FileScan parquet \[([^\]]*)\]", p) if re.sub(r"#\d+L?", "", c) != "ts"]
    assert len(read) <= 1, read
    if name in ("topk_rate", "cpu_from_deltas"):
        # what later buckets need is read off the same shuffled rows
        assert "ReusedExchange" in p


def test_stored_range_prunes_partitions(spark):
    p = final_plan(spark, E.queries()["stored_range_counts"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(date" in p and "GreaterThan(ts," in p
