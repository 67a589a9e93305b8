"""Keys kept as plain columns: the same answers as from the VARIANT column, from a filter the scan takes."""

import re

import pytest
from pyspark.sql import functions as F

from eventloom import kv
from eventloom.functions.kept import KeptLeaf, keep_keys, kept_column
from eventloom.plans.log_table import LogTable
from eventloom.schema import AUTO, IDX, USER, KeyPath
from eventloom.sources.store import append_events, store_events
from tests.helpers import events, values
from tests.test_plans import plan

K = KeyPath(False, ("k",))
LEAVES = [
    "1", "50", "-50", "0", "9007199254740992", "9007199254740993", "-9007199254740993", "9223372036854775807", "-9223372036854775808",
    "49.5", "50.0", "-0.5", "1e300", "-1e300", "123456789012345678901", '"50"', '"a*b"', '"ABC"', '"abc"', '"é"', '""', "true", "false",
    "null", "{}", '{"a":1}', "[1]", '{"k":50}',
]
NUMBERS = [0, 50, 49.5, 50.0, -0.5, -50.5, 2**53, 2**53 + 1, -(2**53) - 1, 2.0**53, 2.0**60, 2**63 - 1, -(2**63), 2**64, -(2**70), 1e300, float("inf")]


def made(spark):
    rows = [("s", i, i, 3, f'{{"k":{leaf}}}') for i, leaf in enumerate(LEAVES)]
    return events(spark, rows + [("s", len(rows), 0, 3, "{}"), ("s", len(rows) + 1, 0, 3, '{"K":1}'), ("s", len(rows) + 2, 0, 3, "no json")])


def comparisons(leaf):
    for number in NUMBERS:
        yield from (leaf.eq(number), leaf < number, leaf <= number, leaf > number, leaf >= number)
    for text in ("50", "abc", "É", ""):
        yield from (leaf.eq(text), leaf.eq(text, case_sensitive=True))
    yield from (leaf.eq(True), leaf.eq(False), leaf.eq(None), leaf.exists(), leaf.matches("a*"), leaf.matches("A*", case_sensitive=True))


def test_kept_keys_answer_as_the_variant_does(spark):
    frame = keep_keys(made(spark), [K])
    plain, kept = list(comparisons(kv("k"))), list(comparisons(KeptLeaf(K)))
    both = [c.alias(f"c{i}") for i, c in enumerate(plain)], [c.alias(f"c{i}") for i, c in enumerate(kept)]
    want, got = (frame.select(IDX, *cs).orderBy(IDX).collect() for cs in both)
    for x, y in zip(want, got, strict=True):
        wrong = [i for i in range(len(plain)) if x[f"c{i}"] != y[f"c{i}"]]
        assert not wrong, (x[IDX], wrong)


def test_names_stay_apart():
    paths = [KeyPath(a, p) for a in (True, False) for p in (("k",), ("K",), ("a.b",), ("a", "b"), ("a_b",), ("é",), ("",))]
    assert len({kept_column(p, "long").lower() for p in paths}) == len(paths)


def test_a_number_is_pushed_into_the_scan(spark, tmp_path):
    store_events(keep_keys(made(spark), [K]), str(tmp_path / "t"))
    log = LogTable.stored(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(log.filter(predicate=log.kv("k") >= 50).filtered_events().select(IDX))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert f"GreaterThanOrEqual({kept_column(K, 'long')},50)" in re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert USER not in text and AUTO not in text
    assert type(log.kv("k")) is KeptLeaf and type(log.kv("other")) is not KeptLeaf and type(log.kv("k", auto=True)) is not KeptLeaf
    found = log.filter(predicate=log.kv("k") >= 50)
    assert values(found.filtered_index_map(), IDX) == values(LogTable(made(spark)).filter(predicate=kv("k") >= 50).filtered_index_map(), IDX)
    assert found.page(0, 3, use_filter=True).columns == LogTable(made(spark)).page(0, 3).columns
    with pytest.raises(TypeError):
        log.kv("k") >= True


def test_all_loads_keep_the_same_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    append_events(keep_keys(made(spark).limit(0), [K]), path, "nothing")
    append_events(keep_keys(made(spark), [K]), path, "1")
    with pytest.raises(ValueError, match="kept keys differ"):
        append_events(made(spark), path, "2")
    append_events(keep_keys(made(spark), [K]), path, "3")
    log = LogTable.appended(spark, path)
    assert log.filter(predicate=log.kv("k").eq(50)).filtered_events().where(F.col(IDX) > 0).count() == 4
