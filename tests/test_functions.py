import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom import KeyPath, ReaderOptions
from eventloom.functions.derive import ntz_to_millis, seconds_to_minutes, with_structured_fields
from eventloom.functions.keypaths import integer_at, string_at, type_at, value_at
from eventloom.functions.levels import level_from_logtype, level_from_name, level_name
from eventloom.functions.text import (
    render_structured,
    render_unstructured,
    repair_utf8,
    template_of,
    variables_of,
)
from eventloom.schema import LEVEL_NAMES


def kvs(spark, *user_texts, auto="{}"):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(user_texts)], "i int, t string")
    return rows.select("i", F.parse_json(F.lit(auto)).alias("auto_kv"), F.try_parse_json("t").alias("user_kv"))


def column(frame, expr):
    return [r[0] for r in frame.orderBy("i").select(expr).collect()]


def test_dotted_key_is_one_part(spark):
    frame = kvs(spark, '{"a.b":1,"a":{"b":2}}')
    assert column(frame, integer_at(KeyPath(False, ("a.b",)))) == [1]
    assert column(frame, integer_at(KeyPath(False, ("a", "b")))) == [2]


@pytest.mark.parametrize("key", ["it's", 'say "x"', "both ' and \"", "a]b", "", "$", "é", "x y", "0", "x']['y", 'x"]["y', "a[0]"])
def test_any_key_name_resolves(spark, key):
    import json

    frame = kvs(spark, json.dumps({key: {"in": 7}, "other": 1}), json.dumps([{"in": 7}]))
    assert column(frame, integer_at(KeyPath(False, (key, "in")))) == [7, None]
    assert column(kvs(spark, json.dumps({"in": {key: "v"}})), string_at(KeyPath(False, ("in", key)))) == ["v"]


def test_whole_path_and_namespace_must_match(spark):
    frame = kvs(spark, '{"a":{"b":1}}', auto='{"b":2}')
    assert column(frame, integer_at(KeyPath(False, ("b",)))) == [None]
    assert column(frame, integer_at(KeyPath(False, ("a",)))) == [None]
    assert column(frame, integer_at(KeyPath(False, ("a", "b", "c")))) == [None]
    assert column(frame, integer_at(KeyPath(True, ("b",)))) == [2]
    assert column(frame, type_at(KeyPath(False, ()))) == [None]
    assert column(frame, value_at(None, "bigint")) == [None]


def test_level_from_name(spark):
    texts = {"Error": 5, "warn": 4, " warn": 0, "NONE": 0, "none": 0, "view": 0, "ınfo": 0, "": 0, "fatal": 6,
             "TRACE": 1, "dEbUg": 2, "INFO": 3, None: 0, "ſ": 0, "LENGTH": 0}
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert column(frame, level_from_name(F.col("t"))) == list(texts.values())


def test_level_from_logtype(spark):
    texts = {" INFORMATION": 3, " info": 0, "éINFO": 0, "INFO": 0, "xWARNING": 4, "": 0, "x": 0, None: 0,
             "\nFATAL": 6, "  ERROR": 0, " TRACEDEBUG": 1}
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert column(frame, level_from_logtype(F.col("t"))) == list(texts.values())


def test_level_names(spark):
    frame = spark.range(8).withColumnRenamed("id", "i")
    assert column(frame, level_name(F.col("i").cast("tinyint"))) == [*LEVEL_NAMES, None]


def test_structured_fields_take_only_the_right_types(spark):
    options = ReaderOptions(KeyPath(False, ("l",)), KeyPath(False, ("t",)), KeyPath(False, ("o",)))
    texts = ['{"t":12}', '{"t":"12"}', '{"t":1.5}', '{"t":true}', '{"t":null}', "{}", '{"t":1e3}',
             '{"t":12345678901234567890}', '{"l":5}', '{"l":null}', '{"l":"Warn"}']
    frame = with_structured_fields(kvs(spark, *texts), options)
    assert column(frame, "timestamp") == [12] + [0] * 10
    assert column(frame, "log_level") == [0] * 10 + [4]
    offsets = {-90: -1, -5400: -90, -59: 0, 5341: 89, 0: 0}
    frame = with_structured_fields(kvs(spark, *['{"o":%d}' % s for s in offsets]), options)
    assert column(frame, "utc_offset") == list(offsets.values())
    frame = with_structured_fields(kvs(spark, '{"l":"INFO","t":1,"o":60}'), ReaderOptions())
    assert frame.select("log_level", "timestamp", "utc_offset").first() == (0, 0, 0)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_ntz_millis_ignore_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamps = ["2024-03-10 02:30:00.123999", "2024-11-03 01:30:00", "1969-12-31 23:59:59.9995", "1970-01-01 00:00:00"]
        frame = spark.createDataFrame(list(enumerate(stamps)), "i int, s string")
        got = column(frame, ntz_to_millis(F.col("s").cast("timestamp_ntz")))
        assert got == [1710037800123, 1730597400000, -1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_render_structured(spark):
    frame = kvs(spark, '{"k":5,"a":null}', "not json", auto='{"z":1,"b":"é"}')
    assert column(frame, render_structured()) == [
        '{"auto-generated":{"b":"é","z":1},"user-generated":{"a":null,"k":5}}',
        "{}",
    ]


def test_repair_utf8(spark):
    frame = spark.createDataFrame([(0, bytearray(b"a\xffb")), (1, bytearray("é".encode()))], "i int, b binary")
    assert column(frame, repair_utf8(F.col("b"))) == ["a�b", "é"]


def test_templates(spark):
    frame = spark.createDataFrame(
        [(0, " ERROR user=8 at 10.0.0.1:80 ok"), (1, "none here"), (2, "a1"), (3, ""), (4, "keep \x11 5"), (5, None)],
        "i int, m string",
    )
    assert column(frame, template_of(F.col("m"))) == [
        " ERROR user=\x11 at \x11:\x11 ok", "none here", "\x11", "", "keep \x11 5", None]
    assert column(frame, variables_of(F.col("m"))) == [["8", "10.0.0.1", "80"], [], ["a1"], [], None, None]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="ab1 .-=\né\x11一", max_size=30), min_size=1, max_size=30))
def test_rendering_undoes_templates(spark, messages):
    frame = spark.createDataFrame(list(enumerate(messages)), "i int, m string")
    frame = frame.select("i", template_of(F.col("m")).alias("l"), variables_of(F.col("m")).alias("v"))
    assert column(frame, render_unstructured(F.col("l"), F.col("v"))) == messages


def test_rendering_refuses_wrong_variable_count(spark):
    frame = spark.createDataFrame([(0, "a \x11 b \x11", ["1"])], "i int, l string, v array<string>")
    with pytest.raises(Exception, match="cannot decode message"):
        column(frame, render_unstructured(F.col("l"), F.col("v")))


def test_long_runs_without_digits_stay_fast(spark):
    frame = spark.createDataFrame([(0, "a" * 400_000)], "i int, m string")
    assert column(frame, variables_of(F.col("m"))) == [[]]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(-(2**62), 2**62), min_size=1, max_size=20))
def test_minutes_cut_toward_zero(spark, seconds):
    frame = spark.createDataFrame(list(enumerate(seconds)), "i int, s bigint")
    assert column(frame, seconds_to_minutes(F.col("s"))) == [abs(s) // 60 * (1 if s >= 0 else -1) for s in seconds]
