import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom import kv
from eventloom.operators import filters, paging
from eventloom.plans.log_table import LogTable
from eventloom.schema import IDX, LOGTYPE, STREAM, UNSTRUCTURED, VARS
from tests.helpers import events, values

FOUR = [("a", i, i * 10, lvl, '{"k":%d}' % i) for i, lvl in enumerate([0, 5, 3, 5])]


def test_level_filter(spark):
    e = events(spark, FOUR)
    kept = lambda levels: [r[0] for r in values(filters.filter_events(e, levels), IDX)]
    assert kept(None) == [0, 1, 2, 3]
    assert kept([]) == []
    assert kept([0]) == [0]
    assert kept([5, 5]) == kept([5]) == [1, 3]
    assert kept([3, 5, 0]) == kept([0, 3, 5]) == [0, 1, 2, 3]


def test_both_filters_intersect_in_stream_order(spark):
    e = events(spark, FOUR)
    both = filters.filter_events(e, [5], kv("k") >= 2)
    assert values(both, IDX) == [(3,)]


def test_predicates_are_ignored_for_unstructured_streams(spark):
    with pytest.warns(UserWarning, match="ignored"):
        condition = filters.filter_condition(None, kv("k") >= 2, UNSTRUCTURED)
    assert condition is None


def test_filter_that_keeps_everything(spark):
    e = events(spark, FOUR + [("b", 0, 0, 1)])
    active = lambda c, kind: values(filters.filter_summary(e, c, kind), STREAM, "n_matches", "is_active")
    every = filters.filter_condition(range(7))
    assert active(every, "structured") == [("a", 4, False), ("b", 1, False)]
    assert active(every, "unstructured") == [("a", 4, True), ("b", 1, True)]
    assert active(filters.filter_condition([1]), "structured") == [("a", 0, True), ("b", 1, False)]
    assert active(None, "unstructured") == [("a", 4, False), ("b", 1, False)]


def test_index_map_follows_activity(spark):
    e = events(spark, FOUR + [("b", 0, 0, 1)])
    condition = filters.filter_condition([1, 5])
    columns = (STREAM, "filtered_idx", IDX)
    assert values(filters.filtered_index_map(e, condition), *columns) == [("a", 0, 1), ("a", 1, 3)]
    assert values(filters.filtered_index_map(e, condition, UNSTRUCTURED), *columns) == [
        ("a", 0, 1), ("a", 1, 3), ("b", 0, 0)]


def test_page_bounds(spark):
    e = events(spark, FOUR)
    numbers = lambda b, n: [r["log_event_num"] for r in paging.page(e, b, n).collect()]
    assert numbers(0, 4) == [1, 2, 3, 4]
    assert numbers(1, 3) == [2, 3]
    assert numbers(4, 4) == numbers(0, 0) == []
    assert numbers(0, 5) == numbers(3, 2) == []
    for b, n in [(0, 5), (3, 2), (5, 5), (-1, 2)]:
        with pytest.raises(ValueError):
            paging.page(e, b, n, strict=True)
    for b, n in [(4, 4), (0, 0), (0, 4)]:
        assert paging.page(e, b, n, strict=True).count() == n - b


def test_page_of_streams_of_different_length(spark):
    e = events(spark, FOUR + [("b", 0, 0, 1), ("b", 1, 1, 1)])
    assert values(paging.page(e, 1, 3), STREAM, "log_event_num") == [("a", 2), ("a", 3)]
    with pytest.raises(ValueError):
        paging.page(e, 1, 3, strict=True)


def test_page_of_no_events(spark):
    e = events(spark, FOUR).where("false")
    assert paging.page(e, 0, 1).count() == 0
    with pytest.raises(ValueError):
        paging.page(e, 0, 1, strict=True)


def test_filtered_page(spark):
    e = events(spark, FOUR)
    c = filters.filter_condition([5])
    numbers = lambda b, n, c=c, kind="structured": [r["log_event_num"] for r in paging.page_filtered(e, c, b, n, kind).collect()]
    assert numbers(0, 2) == [2, 4]
    assert numbers(1, 2) == [4]
    assert numbers(2, 2) == numbers(0, 3) == numbers(2, 1) == []
    assert numbers(0, 1, None) == []
    assert numbers(0, 1, filters.filter_condition(range(7))) == []
    for b, n, condition in [(0, 3, c), (0, 1, None), (0, 1, filters.filter_condition(range(7))), (2, 1, c)]:
        with pytest.raises(ValueError):
            paging.page_filtered(e, condition, b, n, strict=True)
    assert paging.page_filtered(e, c, 2, 2, strict=True).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=120), st.sets(st.integers(0, 6), max_size=4), st.integers(0, 6))
def test_filtered_lists_against_a_model(spark, levels, wanted, bits):
    """Any chunk size gives the same list; one stream holds most rows."""
    rows = [("hot", i, i, lvl) for i, lvl in enumerate(levels)] + [("b", 0, 0, 1), ("b", 1, 1, 2)]
    e = events(spark, rows).repartition(3)
    c = filters.filter_condition(wanted)
    model = {}
    for stream, idx, _, lvl in rows:
        if lvl in wanted:
            model.setdefault(stream, []).append(idx)
    sizes = {"hot": len(levels), "b": 2}
    got = values(filters.filtered_index_map(e, c, UNSTRUCTURED, bits), STREAM, "filtered_idx", IDX)
    assert got == sorted((s, n, i) for s, hits in model.items() for n, i in enumerate(hits))
    end = len(model.get("hot", [])) // 2
    begin = end // 2
    page = paging.page_filtered(e.where(F.col(STREAM) == "hot"), c, begin, end, "structured", bits=bits)
    hits = model.get("hot", [])
    active = len(hits) != sizes["hot"]
    assert [r["log_event_num"] for r in page.collect()] == ([i + 1 for i in hits[begin:end]] if active else [])


def test_pages_cover_the_table(spark):
    rng = random.Random(3)
    rows = [("a", i, rng.randrange(99), rng.randrange(7), '{"k":%d}' % rng.randrange(9)) for i in range(53)]
    e = events(spark, rows)
    whole = [tuple(r) for r in paging.decode(e).orderBy("log_event_num").collect()]
    pages = []
    for begin in range(0, 53, 10):
        pages += [tuple(r) for r in paging.page(e, begin, min(begin + 10, 53)).collect()]
    assert pages == whole


def test_unstructured_page(spark):
    e = events(spark, FOUR).withColumns({LOGTYPE: F.lit(" ERROR n=\x11"), VARS: F.array(F.col(IDX).cast("string"))})
    got = paging.page(e, 2, 4, UNSTRUCTURED).collect()
    assert [(r["log_event_num"], r["message"]) for r in got] == [(3, " ERROR n=2"), (4, " ERROR n=3")]


def test_decoded_messages_are_valid_text(spark):
    e = events(spark, FOUR[:1])
    bad = F.lit(b"a\xffb").cast("string")
    e = e.withColumns({LOGTYPE: F.concat(bad, F.lit("\x11")), VARS: F.array(bad), "user_kv": F.to_variant_object(F.struct(bad.alias("k")))})
    got = [paging.decode(e, kind).select(F.col("message").cast("binary")).first()[0] for kind in (UNSTRUCTURED, "structured")]
    assert bytes(got[0]).decode() == "a\ufffdba\ufffdb"
    assert '"k":"a\ufffdb"' in bytes(got[1]).decode()


def test_log_table(spark):
    log = LogTable(events(spark, FOUR + [("b", 0, 5, 5)]))
    assert values(log.event_counts(), STREAM, "n_events") == [("a", 4), ("b", 1)]
    assert log.filtered_index_map() is None
    assert log.filter(range(7)).filtered_index_map() is None
    errors = log.only("a").filter([5])
    assert values(errors.filtered_index_map(), "filtered_idx", IDX) == [(0, 1), (1, 3)]
    assert values(errors.filtered_events(), IDX) == [(1,), (3,)]
    assert [r["log_event_num"] for r in errors.page(1, 2, use_filter=True).collect()] == [4]
    assert [r["log_event_num"] for r in errors.page(1, 2).collect()] == [2]
    # The nearest event is looked up among all events, filtered or not.
    assert values(errors.nearest(20), STREAM, IDX) == [("a", 2)]
    assert errors.filter().filtered_index_map() is None
    probes = log.events.sparkSession.createDataFrame([("a", 25), ("b", 0)], f"{STREAM} string, target_ts bigint")
    assert values(log.nearest_many(probes), STREAM, IDX) == [("a", 2), ("b", 0)]
    assert values(log.file_names(), STREAM, "file_name") == [("a", "f0"), ("b", "f0")]
    assert values(log.file_infos(), STREAM, "log_event_idx_end") == [("a", 4), ("b", 1)]
