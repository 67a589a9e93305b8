"""The zone map, ranks over any order, the sweep of file ranges and the one-scan census."""

import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventloom.operators import diagnostics, files, indexing, nearest
from eventloom.plans import driver_tables as dt
from eventloom.plans.log_table import LogTable
from eventloom.schema import IDX, STREAM, TS
from eventloom.sources.store import store_events
from tests.helpers import SF_SMALL, events, values
from tests.test_plans import plan


def made_events(spark, order):
    """Three streams: in time order, shuffled, and all at one time."""
    rng = random.Random(order)
    rows = [("a", i, 10 * (i // 3), 3) for i in range(200)]
    rows += [("b", i, rng.randrange(0, 2000), 3) for i in range(300)]
    return events(spark, rows + [("c", i, 500, 3) for i in range(90)] + [("d", 0, -5, 3)])


def stored(spark, tmp_path, bits=4):
    frame, path = made_events(spark, 1), str(tmp_path / "events")
    store_events(frame, path, bits=bits)
    return frame, LogTable.stored(spark, path)


def test_lookups_through_the_zone_map_equal_a_scan(spark, tmp_path):
    frame, log = stored(spark, tmp_path)
    assert values(log.event_counts(), STREAM, "n_events") == values(LogTable(frame).event_counts(), STREAM, "n_events")
    for target in (-6, -5, 0, 9, 10, 333, 499, 500, 501, 660, 663, 1990, 10**9):
        assert values(log.nearest(target), STREAM, IDX) == values(nearest.nearest_event(frame, target), STREAM, IDX), target
    assert values(log.only("b").nearest(700), STREAM, IDX) == values(nearest.nearest_event(frame.where("stream_id = 'b'"), 700), STREAM, IDX)
    assert log.filter(levels=[6]).zones is log.zones


def test_events_without_times_are_stored_and_counted_but_not_looked_up(spark, tmp_path):
    frame, path = made_events(spark, 1).drop(TS), str(tmp_path / "timeless")
    store_events(frame, path, bits=4)
    log = LogTable.stored(spark, path)
    assert values(log.event_counts(), STREAM, "n_events") == [("a", 200), ("b", 300), ("c", 90), ("d", 1)]
    with pytest.raises(AnalysisException):
        log.nearest(500).collect()


def test_many_chunks_to_read_are_joined(spark, tmp_path, monkeypatch):
    frame, log = stored(spark, tmp_path)
    monkeypatch.setattr(nearest, "PAGE_RANGES", 2)
    for target in (333, 700):
        assert values(log.nearest(target), STREAM, IDX) == values(nearest.nearest_event(frame, target), STREAM, IDX)


def test_a_lookup_names_its_chunks_to_the_scan(spark, tmp_path):
    _, log = stored(spark, tmp_path)
    picked = nearest._zones_to_read(log.zones, 333)
    assert sorted(tuple(r) for r in picked.where("stream_id <> 'b'").collect()) == [("a", 96, 111), ("d", 0, 0)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan(log.only("a").nearest(333))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(log_event_idx,96)" in text and "LessThanOrEqual(log_event_idx,111)" in text
    assert re.search(r"PartitionFilters: \[[^\]]*stream_bucket", text)


def test_in_a_stream_in_order_few_chunks_are_read(spark):
    zones = spark.range(100_000).select(
        F.lit("s").alias(STREAM), F.col("id").alias("chunk"), (F.col("id") * 10).alias("min_idx"), (F.col("id") * 10 + 9).alias("max_idx"),
        (F.col("id") * 7).alias("min_ts"), (F.col("id") * 7 + 7).alias("max_ts"), F.lit(10).alias("n"),
    )
    for target in (0, 6, 7, 8, 350_000, 10**9):
        assert nearest._zones_to_read(zones, target).count() <= 2


# Ranks


def test_ranks_of_any_order(spark):
    rng = random.Random(3)
    rows = [(f"s{i % 3 % 2}", rng.choice(["x", "é", "", "~"]) + str(rng.randrange(10**12)), i * 10**15 % 977, i) for i in range(2000)]
    frame = spark.createDataFrame(rows, f"{STREAM} string, word string, sparse bigint, i bigint").repartition(7)
    for order in (["word", "i"], ["sparse", "word", "i"], ["i"]):
        place = [("stream_id", "word", "sparse", "i").index(c) for c in order]
        want = []
        for s in ("s0", "s1"):
            mine = sorted((r for r in rows if r[0] == s), key=lambda r: tuple(r[k].encode() if isinstance(r[k], str) else r[k] for k in place))
            want += [(s, r[3], at) for at, r in enumerate(mine)]
        for few in (200_000, 0):  # also with the summary carried in two levels and joined by a shuffle
            got = indexing.index_by_rank(frame, order, broadcast_rows=few)
            assert values(got, STREAM, "i", IDX) == sorted(want) and got.columns == [*frame.columns, IDX]


def test_ranks_need_a_unique_order(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("a", 2)], f"{STREAM} string, t bigint")
    with pytest.raises(ValueError, match="not unique"):
        indexing.index_by_rank(frame, ["t"])
    with pytest.raises(Exception, match="t is null"):
        indexing.index_by_rank(frame.limit(1).unionByName(frame.select(STREAM, F.lit(None).cast("bigint").alias("t")).limit(1)), ["t"])
    assert indexing.index_by_rank(frame.limit(0), ["t"]).count() == 0


# Ranges of files


def owners(ranges, low, high):
    """The owner of each position, by trying every range."""
    out = []
    for at in range(low, high):
        open_ = [(-s, e, n) for s, e, n in ranges if s <= at < e]
        out.append(min(open_)[2] if open_ else None)
    return out


@pytest.mark.parametrize("bits,size", [(3, 400), (5, 400), (18, 400)])
def test_pieces_give_each_position_its_owner(spark, bits, size):
    rng = random.Random(bits)
    ranges = [(0, size, "all"), (2, size - 3, "most"), (7, 7 + 64, "long"), (size + 40, size + 41, "far")]
    for i in range(60):
        at = rng.randrange(size)
        ranges.append((at, min(size, at + rng.choice([1, 2, 9, 40, 150])), f"f{i}"))
    frame = spark.createDataFrame([("s", *r) for r in ranges] + [("t", 5, 6, "one")], f"{STREAM} string, _start bigint, _end bigint, file_name string")
    pieces = files._pieces(frame, bits).collect()
    got = [None] * (size + 41)
    for p in (p for p in pieces if p[STREAM] == "s"):
        assert p["_start"] >> bits == (p["_end"] - 1) >> bits == p["_chunk"]
        for at in range(p["_start"], p["_end"]):
            assert got[at] is None
            got[at] = p["file_name"]
    assert got == owners(ranges, 0, size + 41)
    assert [(p["_start"], p["_end"]) for p in pieces if p[STREAM] == "t"] == [(5, 6)]


def test_twenty_thousand_interleaved_files_in_a_chunk():
    n = 20_000
    low = list(range(n))
    high = [100_000 + (i * 7919) % n for i in range(n)]
    table = pa.table({"k": [1] * n, "_low": low, "_high": high, "_start": low, "_end": high, "file_name": [f"f{i}" for i in range(n)]})
    begun = time.time()
    pieces = files.sweep(table, "k")
    assert len(pieces) <= 2 * 2 * n and time.time() - begun < 10
    starts, ends = pieces.column("_from").to_pylist(), pieces.column("_to").to_pylist()
    assert starts[0] == 0 and ends[-1] == max(high) and starts[1:] == ends[:-1]


def test_files_over_many_chunks_are_not_dealt_to_each(spark):
    """500 files over 500 chunks each: two rows a file enter the sweeps of chunks, not 250,000."""
    rows = [("s", i, 4000 + i, f"f{i}") for i in range(500)]
    frame = spark.createDataFrame(rows, f"{STREAM} string, _start bigint, _end bigint, file_name string").withColumns({"_low": F.col("_start"), "_high": F.col("_end")})
    assert files._cut(frame, "_chunk", 3, only_ends=True).count() == 1000
    pieces = files._pieces(frame.drop("_low", "_high"), 3)
    assert pieces.count() <= 2 * 1000 + 600


# Census


def test_deep_objects_are_opened_to_their_leaves(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":{"g":1, "h":{}}}}}}}}'
    frame = events(spark, [("s", 0, 0, 0, deep), ("s", 1, 0, 0, '{"a":{"b":2},"x":[{"y":1}]}'), ("s", 2, 0, 0, "{}"), ("t", 0, 0, 0, deep)])
    got = sorted(("/".join(r["path"]), r["type"], r["n_events"]) for r in diagnostics.schema_census(frame).collect())
    assert got == [("a/b", "BIGINT", 1), ("a/b/c/d/e/f/g", "BIGINT", 2), ("a/b/c/d/e/f/h", "OBJECT", 2), ("x", "ARRAY", 1)]


def test_the_census_scans_once(spark, tmp_path):
    path = str(tmp_path / "events")
    dt.one_stream(spark, SF_SMALL).write.parquet(path)
    text = plan(diagnostics._open_levels(spark.read.parquet(path), 4))
    assert text.count("FileScan parquet") + text.count("Scan parquet") in (1, 2) and text.count("ReadSchema") == 1
    assert text.count("Exchange hashpartitioning") == 1 and TS not in re.search(r"ReadSchema: struct<(.*)>", text).group(1)
