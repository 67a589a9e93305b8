"""Tolerant loads without holes, stored files by size, filters counted once."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom.operators import filters, paging
from eventloom.plans.log_table import LogTable
from eventloom.sources.store import open_events, store_events
from eventloom.sources.tolerant import CorruptStreamError, load_tolerant, split_broken


def _records(spark):
    rows = [("a", i, "x" if i in (4, 5, 11) else "ok") for i in range(12)]
    rows += [("b", i, "x" if i == 0 else "ok") for i in range(3)] + [("c", 0, "x")]
    return spark.createDataFrame(rows, "stream_id string, log_event_idx bigint, text string")


@pytest.mark.parametrize("bits", [0, 1, 2, 18])
def test_tolerant_load_is_dense(spark, bits):
    events, errors = load_tolerant(_records(spark), F.col("text") == "x", bits)
    got = [tuple(r) for r in events.select("stream_id", "log_event_idx", "record_idx").orderBy("stream_id", "log_event_idx").collect()]
    kept = [i for i in range(12) if i not in (4, 5, 11)]
    assert got == [("a", n, i) for n, i in enumerate(kept)] + [("b", 0, 1), ("b", 1, 2)]
    assert {tuple(r) for r in errors.collect()} == {
        ("a", 4, "corrupt"), ("a", 5, "corrupt"), ("a", 11, "incomplete"), ("b", 0, "corrupt"), ("c", 0, "incomplete")
    }


def test_strict_load_refuses(spark):
    with pytest.raises(CorruptStreamError):
        split_broken(_records(spark), F.col("text") == "x")


def test_tolerant_load_of_nothing(spark):
    events, errors = load_tolerant(_records(spark).where("false"), F.col("text") == "x")
    assert events.count() == errors.count() == 0


def _events(spark, streams, each, tasks):
    return spark.range(0, streams * each, 1, tasks).select(
        F.concat(F.lit("s"), (F.col("id") % streams).cast("string")).alias("stream_id"),
        F.expr(f"id div {streams}").alias("log_event_idx"),
        (F.expr(f"id div {streams}") % 3).cast("tinyint").alias("log_level"),
    )


def test_stored_files_follow_the_size(spark, tmp_path):
    events = _events(spark, 300, 20, 12)
    store_events(events, str(tmp_path / "t"))
    files = list(Path(tmp_path / "t").rglob("*.parquet"))
    stored = open_events(spark, str(tmp_path / "t"))
    assert len(files) <= 256 + 8  # a bucket's folder each, not one per task as well
    assert stored.count() == 6000 and stored.select("stream_id", "log_event_idx").distinct().count() == 6000


def test_a_filter_is_counted_once(spark, monkeypatch):
    calls, count = [], filters.match_offsets
    monkeypatch.setattr(filters, "match_offsets", lambda *a, **k: calls.append(1) or count(*a, **k))
    monkeypatch.setattr(paging, "match_offsets", filters.match_offsets)
    monkeypatch.setattr(paging, "decode", lambda rows, kind: rows.select("stream_id", (F.col("log_event_idx") + 1).alias("log_event_num")))
    table = LogTable(_events(spark, 2, 30, 2)).filter(levels=[1])
    pages = [[tuple(r) for r in table.page(b, b + 2, use_filter=True).collect()] for b in (0, 2)]
    assert pages == [[(s, n) for s in ("s0", "s1") for n in ns] for ns in ((2, 5), (8, 11))]
    assert len(calls) == 1


def test_pages_of_many_streams_read_one_range(spark, monkeypatch):
    events = _events(spark, 6, 40, 2)
    monkeypatch.setattr(paging, "decode", lambda rows, kind: rows.select("stream_id", F.col("log_event_idx").alias("log_event_num")))
    page = lambda: [tuple(r) for r in paging.page_filtered(events, F.col("log_level") == 1, 3, 6, bits=2).collect()]
    apart = page()
    monkeypatch.setattr(paging, "PAGE_RANGES", 2)
    assert page() == apart and len(apart) == 18
