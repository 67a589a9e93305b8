"""Positions and reports of a stream: as of one batch load, over empty batches, restarts and tries that were lost."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import diagnostics
from eventloom.operators.indexing import index_by_rank
from eventloom.plans.log_table import LogTable
from eventloom.schema import IDX, OFFSET, STREAM, TS
from eventloom.sources.events import structured_events
from eventloom.schema import KeyPath, ReaderOptions
from eventloom.streaming import positions
from tests.helpers import values

OPTIONS = ReaderOptions(timestamp=KeyPath(True, ("t",)), utc_offset=KeyPath(True, ("o",)))


def build(rows):
    auto = F.struct(F.col("t"), F.col("o"))
    return structured_events(rows, OPTIONS, stream=F.col(STREAM), idx=F.col(IDX), auto=auto)


def arrivals(spark, seed, batches, size):
    """Batches of (stream, at, t, o): a hot stream, others that come and go, one batch without rows."""
    rng, at = random.Random(seed), 0
    for number in range(batches):
        rows = []
        for _ in range(0 if number == 2 else size):
            at += rng.randrange(1, 1000)
            rows.append((rng.choice(["hot", "hot", f"s{number}", "s0"]), at, rng.randrange(50), rng.choice([0, 3600])))
        yield spark.createDataFrame(rows, f"{STREAM} string, at bigint, t bigint, o bigint").repartition(3)


def compare(spark, table, parts):
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    batch = build(index_by_rank(whole, ["at"]))
    assert values(LogTable.appended(spark, table).events, STREAM, IDX, TS, OFFSET) == values(batch, STREAM, IDX, TS, OFFSET)
    columns = (STREAM, IDX, OFFSET, "previous_utc_offset")
    assert values(positions.offset_changes_so_far(spark, table), *columns) == values(diagnostics.offset_changes(batch), *columns)
    columns = (STREAM, "n_events", "n_inversions", "first_bad_idx", "is_chronological")
    key = lambda rows: sorted(rows, key=repr)
    got, want = (f.select(*columns).collect() for f in (positions.chronology_so_far(spark, table), diagnostics.chronology_check(batch)))
    assert key(map(tuple, got)) == key(map(tuple, want))


def test_batches_empty_ones_and_lost_tries(spark, tmp_path, monkeypatch):
    table, parts = str(tmp_path / "t"), list(arrivals(spark, 1, 5, 40))
    for number, part in enumerate(parts):
        if number == 3:  # lost after the events were committed, and before any report or state was
            with monkeypatch.context() as patch:
                patch.setattr(positions.diagnostics, "offset_changes", lambda *_: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    positions._load(part, number, build, ["at"], table, 3)
        positions._load(part, number, build, ["at"], table, 3)
        if number in (1, 3):  # done, but the checkpoint does not know it yet
            positions._load(part, number, build, ["at"], table, 3)
    compare(spark, table, parts)
    with pytest.raises(ValueError, match="state of batch 1 is gone"):
        positions._load(parts[0], 2, build, ["at"], table, 3)


def test_a_stream_with_restarts(spark, tmp_path):
    source, table, progress = (str(tmp_path / name) for name in ("in", "t", "progress"))
    parts = list(arrivals(spark, 2, 2, 60))
    for part in parts:
        part.write.mode("append").parquet(source)
        for _ in range(2):  # the second start finds nothing new
            arriving = spark.readStream.schema(part.schema).parquet(source)
            positions.append_positions(arriving, build, ["at"], table, progress, bits=4).awaitTermination()
    compare(spark, table, parts)
