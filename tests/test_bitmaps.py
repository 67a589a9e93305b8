"""Filters kept as bitmaps: equal to the filters themselves, combined and paged without reading the events."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom import kv
from eventloom.operators import bitmaps, filters
from eventloom.plans.log_table import LogTable
from eventloom.schema import IDX, LEVEL, STREAM, UNSTRUCTURED
from tests.helpers import events, values
from tests.test_plans import plan

CHUNK = 1 << bitmaps.BITS


def made(spark):
    """Matches at the ends of chunks, a stream with gaps between its chunks, one of one event, one that keeps all."""
    rng = random.Random(5)
    places = sorted({0, 1, 7, 8, CHUNK - 1, CHUNK, CHUNK + 1, 5 * CHUNK - 1, *(rng.randrange(6 * CHUNK) for _ in range(400))})
    rows = [("a", i, i, rng.randrange(7), f'{{"k":{rng.randrange(100)}}}') for i in places]
    return events(spark, [*rows, ("b", 0, 0, 5, '{"k":60}'), ("c", 0, 0, 1, '{"k":1}'), ("c", CHUNK, 0, 5, '{"k":99}')])


def test_kept_filters_equal_evaluated_ones(spark):
    log = LogTable(made(spark))
    some = {"levels": log.filter(levels=[4, 5, 6]), "pairs": log.filter(predicate=kv("k") >= 50), "none": log.filter(levels=[])}
    kept = {name: table.keep() for name, table in some.items()}
    cases = [(kept[n], some[n]._condition) for n in some]
    for x, y in (("levels", "pairs"), ("levels", "none")):
        cases.append((kept[x] & kept[y], some[x]._condition & some[y]._condition))
        cases.append((kept[x] | kept[y], some[x]._condition | some[y]._condition))
    columns = (STREAM, "filtered_idx", IDX)
    for table, condition in cases:
        plain = LogTable(log.events, condition=condition)
        assert values(table.filtered_index_map(), *columns) == values(plain.filtered_index_map(), *columns)
        for begin, end in ((3, 40), (0, 10**6)) if table is not kept["pairs"] else ((0, 1), (0, 0), (-1, 3)):
            want = plain.page(begin, end, use_filter=True).collect()
            assert table.page(begin, end, use_filter=True).collect() == want
    got = kept["levels"].only("a").filtered_index_map()
    assert values(got, *columns) == values(some["levels"].only("a").filtered_index_map(), *columns)


def test_full_and_null_conditions(spark):
    frame = spark.range(0, 2 * CHUNK + 5).select(F.lit("s").alias(STREAM), F.col("id").alias(IDX), F.lit(3).alias(LEVEL))
    full = bitmaps.match_bitmaps(frame, F.lit(True))
    assert values(full, "_chunk", "_all", "_n") == [(0, CHUNK, CHUNK), (1, CHUNK, CHUNK), (2, 5, 5)]
    assert bitmaps.kept_index_map(full).count() == 0  # keeps all of a structured stream: not active
    assert bitmaps.kept_index_map(full, UNSTRUCTURED).where(F.col("filtered_idx") == F.col(IDX)).count() == 2 * CHUNK + 5
    null = bitmaps.match_bitmaps(frame, F.lit(None).cast("boolean"))
    assert values(null, "_n", "_bits") == [(0, None)] * 3 and bitmaps.kept_index_map(null).count() == 0
    assert bitmaps.kept_index_map(bitmaps.match_bitmaps(frame.limit(0), F.lit(True))).count() == 0


def test_a_conjunction_scans_no_events(spark, tmp_path):
    path = str(tmp_path / "events")
    made(spark).write.parquet(path)
    log = LogTable(spark.read.parquet(path))
    one, two = log.filter(levels=[5]).keep(), log.filter(predicate=kv("k") >= 50).keep()
    for p in (tmp_path / "events").glob("*.parquet"):
        p.write_bytes(b"")  # the events can't be read any more
    met = one & two
    assert met.filtered_index_map().count() > 0
    text = plan(met.filtered_index_map())
    assert path not in text and "Window" not in text


def test_what_does_not_combine(spark):
    log, other = LogTable(made(spark)), LogTable(made(spark))
    with pytest.raises(ValueError, match="no filter"):
        log.keep()
    with pytest.raises(ValueError, match="keep"):
        log.filter(levels=[1]) & log.filter(levels=[2]).keep()
    with pytest.raises(ValueError, match="same table"):
        log.filter(levels=[1]).keep() & other.filter(levels=[2]).keep()
    with pytest.raises(ValueError, match="list too short"):
        log.filter(levels=[5]).keep().page(0, 2, use_filter=True, strict=True)
    assert filters.filter_condition() is None
