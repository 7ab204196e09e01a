import math

from pyspark.sql import functions as F

from orrery.operators import logs as L
from orrery.sources import exposition as X


def _lines(spark, lines):
    return spark.createDataFrame([("p", i, l) for i, l in enumerate(lines)], "page string, line_no int, line string")


def test_exposition_sum_edges(spark):
    lines = ["# HELP x", "", "a 1", 'a{k="x y"} 2', "b nope", "b", "c NaN"]
    got = {r.name: r.value for r in X.metric_sums(_lines(spark, lines), ["page"]).collect()}
    assert got["a"] == 3.0 and math.isnan(got["c"]) and "b" not in got


def test_exposition_trailing_timestamp(spark):
    got = X.metric_sums(_lines(spark, ["a 1 1700000000"]), ["page"]).first()
    assert got.value == 1700000000.0


def test_selected_first_last(spark):
    lines = ["# m ok 9", "m{x} ok 1", "other 5", "m{y} ok 2", "m{z} ok 3"]
    df = _lines(spark, lines)
    s = X.selected_sums(df, ["page"], ("m{", "ok"), ("zz", "zz")).first()
    assert s.ingested == 6.0 and s.dropped == 0.0
    assert X.matched_value(df, ["page"], "ok", "first").first().value == 1.0
    assert X.matched_value(df, ["page"], "ok", "last").first().value == 3.0
    assert X.active_series(df, ["page"], "m").first().series == 3


def test_first_match_unparsable_stops(spark):
    df = _lines(spark, ["m ok bad", "m ok 4"])
    assert X.matched_value(df, ["page"], "ok", "first").first().value == 0.0
    assert X.matched_value(df, ["page"], "ok", "last").first().value == 4.0


def test_named_metrics_missing_zero(spark):
    s = X.metric_sums(_lines(spark, ["a 1", "b 2"]), ["page"])
    r = X.named_metrics(s, ["page"], ["a", "zz"]).first()
    assert r.a == 1.0 and r.zz == 0.0


def _parse(spark, lines, strict=False):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "id int, raw string")
    arrival = F.timestamp_seconds(F.lit(100))
    f = L.parse_strict if strict else L.parse_lenient
    return {r.id: r for r in f(df, "raw", arrival).collect()}


def test_parse_lenient_edges(spark):
    got = _parse(spark, ["   ", '2024-01-01T00:00:00Z stdout F {"timestamp":5.0}', '{"_time":1,"timestamp":5}',
                         'x {"a":1} tail', "plain words"])
    assert 0 not in got
    assert got[1].is_json and float(got[1]._time) == got[1].event_time == 5.0
    assert got[2]._time == "1"
    assert not got[3].is_json and got[3]._msg == 'x {"a":1} tail' and got[3].event_time == 100.0
    assert got[4]._msg == "plain words"


def test_parse_strict_edges(spark):
    got = _parse(spark, ['pre {"a":1}', '{"a":1}', "[1, 2]"], strict=True)
    assert not got[0].is_json and got[0]._msg == 'pre {"a":1}'
    assert got[1].is_json and got[1].event_time == 100.0
    assert 2 not in got  # valid JSON but not an object: skipped like the reference


def test_log_filters(spark):
    df = spark.createDataFrame(
        [("/app", '{"svc":"a","level":"x"} ERROR'), ("/app", '{"svc":"b"} ERROR'), ("/other", '{"svc":"a"} ERROR'),
         ("/app", '{"svc":"a"} error')], "container string, line string")
    got = L.error_lines(df, "app", {"svc": "a"}, "ERROR").collect()
    assert len(got) == 1


def test_labelled_series_sorted_keys(spark):
    lines = ['m{b="2",a="x \\"y\\""} 1', 'm{a="x \\"y\\"",b="2"} 2', "m 5", "m{} 1", "# m{a=\"1\"} 9"]
    got = {r.series_key: r.value for r in X.series_sums(_lines(spark, lines), ["page"]).collect()}
    assert got == {'m{a="x \\"y\\"",b="2"}': 3.0, "m{}": 6.0}


def test_strict_parse_dead_letter_view(spark):
    df = spark.createDataFrame([(0, "[1, 2]"), (1, '{"a": 1}'), (2, "words"), (3, '"text"')], "id int, raw string")
    got = {r.id: r.rejected for r in L.parse_strict(df, "raw", F.timestamp_seconds(F.lit(1)), with_rejects=True)
           .collect()}
    assert got == {0: True, 1: False, 2: False, 3: True}
