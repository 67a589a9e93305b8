"""Loads added to a stored table: positions go on, a load counts once, broken tries are not seen."""

import pytest
from pyspark.sql import functions as F

from eventloom.plans.log_table import LogTable
from eventloom.schema import IDX, STREAM, TS
from eventloom.sources.store import append_events, open_appended
from tests.helpers import events, values


def load(spark, stream_sizes, ts):
    return events(spark, [(s, i, ts + i, 3) for s, n in stream_sizes.items() for i in range(n)])


def test_positions_go_on_and_batches_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_events(load(spark, {"a": 5, "b": 2}, 100), path, "1", bits=2)
    assert append_events(load(spark, {"a": 3, "c": 4}, 200), path, "2", bits=2)
    before = sorted(str(p) for p in (tmp_path / "t").rglob("*"))
    assert not append_events(load(spark, {"a": 99}, 300), path, "2", bits=2)
    assert sorted(str(p) for p in (tmp_path / "t").rglob("*")) == before
    assert append_events(load(spark, {"b": 1}, 300).limit(0), path, "nothing", bits=2)
    assert append_events(load(spark, {"b": 1}, 400), path, "001", bits=2)
    table = LogTable.appended(spark, path)
    want = [("a", i, 100 + i if i < 5 else 195 + i) for i in range(8)] + [("b", 0, 100), ("b", 1, 101), ("b", 2, 400)] + [("c", i, 200 + i) for i in range(4)]
    assert values(table.events, STREAM, IDX, TS) == want
    assert values(table.event_counts(), STREAM, "n_events") == [("a", 8), ("b", 3), ("c", 4)]
    assert values(table.zones, STREAM, "chunk", "n", "min_ts", "max_ts")[:2] == [("a", 0, 4, 100, 103), ("a", 1, 4, 104, 202)]
    assert values(table.nearest(201), STREAM, IDX) == [("a", 6), ("b", 1), ("c", 1)]
    assert table.only("a").page(4, 6).count() == 2


def test_broken_tries_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    append_events(load(spark, {"a": 2}, 0), path, "1")
    for rows in ([("a", 0, 7, 1), ("a", 2, 8, 1)], [("a", 0, 7, 1), ("a", 0, 8, 1)], [("new", 1, 7, 1)]):
        with pytest.raises(ValueError, match="not dense"):
            append_events(events(spark, rows), path, "2")
    fails = load(spark, {"a": 2}, 50).withColumn(TS, F.when(F.col(IDX) == 1, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col(TS)))
    with pytest.raises(Exception, match="lost"):
        append_events(fails, path, "3")
    assert values(open_appended(spark, path)[0], IDX, TS) == [(0, 0), (1, 1)]
    assert append_events(load(spark, {"a": 1}, 90), path, "2") and append_events(load(spark, {"a": 1}, 95), path, "3")
    assert values(open_appended(spark, path)[0], IDX, TS) == [(0, 0), (1, 1), (2, 90), (3, 95)]


def test_names_and_nothing_loaded(spark, tmp_path):
    with pytest.raises(ValueError, match="batch name"):
        append_events(load(spark, {"a": 1}, 0), str(tmp_path / "t"), "a/b")
    with pytest.raises(ValueError, match="no complete load"):
        open_appended(spark, str(tmp_path / "t"))
