import fnmatch

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom import kv
from eventloom.functions.predicates import wildcard_to_regex


def truth(spark, predicate, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    frame = rows.select("i", F.parse_json(F.lit('{"lvl":"Info"}')).alias("auto_kv"), F.parse_json("t").alias("user_kv"))
    return [r[0] for r in frame.orderBy("i").select(predicate).collect()]


def test_numbers_compare_with_numbers_only(spark):
    texts = ['{"k":60}', '{"k":"60"}', "{}", '{"k":null}', '{"k":49.5}', '{"k":1e3}', '{"k":true}', '{"k":[60]}']
    expected = [True, False, False, False, False, True, False, False]
    assert truth(spark, kv("k") >= 50, *texts) == expected
    assert truth(spark, ~(kv("k") >= 50), *texts) == [not e for e in expected]
    assert truth(spark, kv("k") < 49.6, *texts) == [False] * 4 + [True] + [False] * 3


def test_large_integers_compare_exactly(spark):
    big = 2**53 + 1
    texts = ['{"k":%d}' % big, '{"k":%d}' % (big - 1)]
    assert truth(spark, kv("k").eq(big), *texts) == [True, False]
    assert truth(spark, kv("k") > big - 1, *texts) == [True, False]
    assert truth(spark, kv("k") < 2**70, *texts) == [True, True]


def test_equality_by_type(spark):
    texts = ['{"k":"Abc"}', '{"k":true}', '{"k":1}', '{"k":null}', "{}", '{"k":"true"}']
    assert truth(spark, kv("k").eq("aBC"), *texts) == [True, False, False, False, False, False]
    assert truth(spark, kv("k").eq("abc", case_sensitive=True), *texts) == [False] * 6
    assert truth(spark, kv("k").eq(True), *texts) == [False, True, False, False, False, False]
    assert truth(spark, kv("k").eq(1), *texts) == [False, False, True, False, False, False]
    assert truth(spark, kv("k").eq(None), *texts) == [False, False, False, True, False, False]
    assert truth(spark, kv("k").exists(), *texts) == [True, True, True, True, False, True]


def test_namespaces_are_apart(spark):
    assert truth(spark, kv("lvl", auto=True).eq("INFO"), '{"lvl":"x"}') == [True]
    assert truth(spark, kv("lvl").eq("INFO"), '{"lvl":"x"}') == [False]


def test_and_or_not(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":1}', '{"b":"x"}', "{}"]
    a, b = kv("a").eq(1), kv("b").eq("x")
    assert truth(spark, a & b, *texts) == [True, False, False, False]
    assert truth(spark, a | b, *texts) == [True, True, True, False]
    assert truth(spark, ~(a | b), *texts) == [False, False, False, True]


def test_wildcards(spark):
    texts = ['{"k":"api-one"}', '{"k":"API"}', '{"k":"a.i-x"}', '{"k":"api\\nline\\n"}', '{"k":5}', '{"k":"a*c"}']
    assert truth(spark, kv("k").matches("api*"), *texts) == [True, True, False, True, False, False]
    assert truth(spark, kv("k").matches("a?i-*", case_sensitive=True), *texts) == [True, False, True, False, False, False]
    assert truth(spark, kv("k").matches("API", case_sensitive=True), *texts) == [False, True, False, False, False, False]
    assert truth(spark, kv("k").matches(r"a\*c"), *texts) == [False] * 5 + [True]
    assert truth(spark, kv("k").matches("api?line"), *texts) == [False] * 6


@settings(max_examples=15, deadline=None)
@given(st.text(alphabet="ab*?.[]$^+ \n", max_size=8), st.lists(st.text(alphabet="ab.[]$^+ \n", max_size=6), min_size=1))
def test_wildcards_against_a_model(spark, pattern, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(F.col("t").rlike(wildcard_to_regex(pattern, True))).collect()]
    model = pattern.replace("[", "[[]")
    assert got == [fnmatch.fnmatchcase(t, model) for t in texts]


def test_only_numbers_can_be_ordered(spark):
    with pytest.raises(TypeError):
        kv("k") >= "50"
