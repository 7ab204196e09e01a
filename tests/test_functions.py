import json
import math

from pyspark.sql import functions as F

from orrery.functions.keys import series_key
from orrery.functions.numeric import cpu_percent, first_nonzero, memory_percent
from orrery.functions.tags import any_process_has_both, attrs_match, tag_string_to_map, tags_with_key_containing
from orrery.functions.text import format_bytes, py_float, strict_json_object, strict_json_value, utf8_repair


def _py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def test_py_float_matches_python(spark):
    cases = ["1", "1.0", "1.0d", "1_000", "1__0", "_1", "nan", "NaN", "+Inf", "-inf", "infinity", "1e3", ".5",
             "5.", "abc", "0x10", " 2 ", "1e", "+", "-0", "1.5E-3", "1_0.2_5"]
    got = dict(spark.createDataFrame([(c,) for c in cases], "t string").select("t", py_float("t").alias("v")).collect())
    for c in cases:
        want = _py_float(c)
        if want is None:
            assert got[c] is None, c
        elif math.isnan(want):
            assert math.isnan(got[c]), c
        else:
            assert got[c] == want, c


def _py_obj(s):
    try:
        v = json.loads(s)
    except ValueError:
        return False
    return isinstance(v, dict)


def _py_val(s):
    try:
        json.loads(s)
        return True
    except ValueError:
        return False


def test_strict_json_matches_python(spark):
    cases = ['{"a":1}', '{"a":1} xyz', "{'a':1}", '{"a":1,}', '{"a":{"b":2}}', "[1]", '"x"', '{"a":1}}',
             '{"a" : 1 }', "{}", '{"a":NaN}', "{a:1}", '{"a":[1,2]}', '{"a":"x\\"y"}', '{"a":1}\n',
             '{"a":01}', '{"a":.5}', '{"a":1e5}', "1", "null", "true", '{"a":1,"a":2}', '{"a":{"b":2,}}', '{"a":[1,]}', '{"a":[1 2]}', "[1,]", "{\"a\":{'b':2}}", '{"a":"it\'s"}', '{"a":{"b":1}} {"c":1}', '{"a":tru}', '{"a":"\\u00e9"}']
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    rows = df.select("t", strict_json_object(F.trim("t")).isNotNull().alias("o"),
                     strict_json_value(F.trim("t")).alias("v")).collect()
    for r in rows:
        assert r.o == _py_obj(r.t.strip()), r.t
        assert r.v == _py_val(r.t.strip()), r.t


def test_duplicate_key_keeps_last(spark):
    m = spark.createDataFrame([('{"a":1,"a":2}',)], "t string").select(strict_json_object("t").alias("m")).first().m
    assert m["a"] == "2"


def test_format_bytes(spark):
    def py(n):
        x = float(n)
        for u in ["B", "KB", "MB", "GB", "TB"]:
            if x < 1024.0:
                return f"{x:.2f} {u}"
            x /= 1024.0
        return f"{x:.2f} PB"

    vals = [0, 5, 1023, 1024, 1152, 1536, 1024**2 - 1, 1024**5, 3 * 1024**5 + 7, 2**40, 123456789, 10**15, 1049]
    got = dict(spark.createDataFrame([(v,) for v in vals], "n long").select("n", format_bytes("n").alias("f"))
               .collect())
    for v in vals:
        assert got[v] == py(v), v
    assert got[1023] == "1023.00 B" and got[1024] == "1.00 KB" and got[1024**5] == "1.00 PB"


def test_utf8_repair(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),)], "b binary")
    assert df.select(utf8_repair(F.col("b").cast("string")).alias("s")).first().s == "a�b"


def test_series_key_sorted(spark):
    df = spark.createDataFrame([({"z": "1", "a": "2", "m": "3"},)], "labels map<string,string>")
    k = df.select(series_key(F.lit("m"), "labels").alias("k")).first().k
    assert k == 'm{a="2",m="3",z="1"}'


def test_tag_predicates(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"a": "1"},)], "attrs map<string,string>")
    got = [r.m for r in df.select(attrs_match("attrs", tag_string_to_map(F.lit("a=1 b=2"))).alias("m")).collect()]
    assert got == [True, False]


def test_process_exists_same_process(spark):
    schema = "processes map<string, struct<tags: array<struct<key:string,value:string>>>>"
    split = {"p1": {"tags": [{"key": "app", "value": "x"}]}, "p2": {"tags": [{"key": "run", "value": "r"}]}}
    same = {"p1": {"tags": [{"key": "app", "value": "x"}, {"key": "run", "value": "r"},
                            {"key": "Benchmark_X", "value": "v"}]}}
    df = spark.createDataFrame([(split,), (same,)], schema)
    got = [r.m for r in df.select(any_process_has_both("processes", ("app", "x"), ("run", "r")).alias("m")).collect()]
    assert got == [False, True]
    tags = df.select(F.explode(F.map_values("processes")).alias("p")).select(
        tags_with_key_containing(F.col("p.tags")).alias("t")).collect()
    assert [len(r.t) for r in tags] == [0, 0, 1]


def test_numeric_helpers(spark):
    r = spark.range(1).select(
        first_nonzero(F.lit(0), F.lit(None), F.lit(3), scales=[1, 1, 1024]).alias("a"),
        first_nonzero(F.lit(0), F.lit(0)).alias("b"),
        cpu_percent(F.lit(50), F.lit(0), F.lit(4)).alias("c0"),
        cpu_percent(F.lit(50), F.lit(100), F.lit(4)).alias("c"),
        memory_percent(F.lit(5), F.lit(0)).alias("m0"),
    ).first()
    assert (r.a, r.b, r.c0, r.c, r.m0) == (3072.0, 0.0, 0.0, 200.0, 0.0)
