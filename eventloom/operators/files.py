"""Event counts and the ranges of positions that came from each source file."""

from __future__ import annotations

import heapq
import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.chunks import CHUNK_BITS, chunk_of, small_enough
from eventloom.schema import FILE, IDX, STREAM
from eventloom.session import settle

BROADCAST_RANGES = 10_000


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(STREAM).agg(F.count("*").alias("n_events"))


def file_infos(events: DataFrame) -> DataFrame:
    """Per source file: name, first position, position after the last, number of events.

    is_contiguous is false where other files' events lie inside the range.
    """
    return (
        events.groupBy(STREAM, FILE)
        .agg(
            F.min(IDX).alias("log_event_idx_start"),
            (F.max(IDX) + 1).alias("log_event_idx_end"),
            F.count("*").alias("log_event_count"),
        )
        .withColumn(
            "is_contiguous",
            F.col("log_event_idx_end") - F.col("log_event_idx_start") == F.col("log_event_count"),
        )
        .withColumnRenamed(FILE, "file_name")
        .orderBy(STREAM, "log_event_idx_start")
    )


def file_names(events: DataFrame) -> DataFrame:
    """Source file names, in the order of their ranges."""
    return file_infos(events).select(STREAM, "file_name", "log_event_idx_start")


PIECE = "_from bigint, _to bigint, _start bigint, _end bigint, file_name string"
SPAN_BITS = 18


def sweep(table: pa.Table, *keys: str) -> pa.Table:
    """Disjoint pieces (_from, _to) of the ranges (_low, _high) of one group, each with its owner's _start, _end, file_name.

    One ordered pass over the end points. The open ranges wait in a heap by the owner's rule; one that has
    ended is dropped when it comes to the top. So n ranges cost n log n and give at most 2 n - 1 pieces.
    """
    low, high, start, end, name = (table.column(c).to_pylist() for c in ("_low", "_high", "_start", "_end", "file_name"))
    order = sorted(range(len(low)), key=low.__getitem__)
    waiting: list[tuple] = []
    pieces: list[tuple] = []
    next_open = 0
    for at, after in itertools.pairwise(sorted({*low, *high})):
        while next_open < len(order) and low[order[next_open]] <= at:
            i = order[next_open]
            heapq.heappush(waiting, (-start[i], end[i], name[i] is None, name[i] or "", high[i], i))
            next_open += 1
        while waiting and waiting[0][4] <= at:
            heapq.heappop(waiting)
        if waiting:
            owner = waiting[0][5]
            if pieces and pieces[-1][1] == at and pieces[-1][2] == owner:
                pieces[-1] = (pieces[-1][0], after, owner)
            else:
                pieces.append((at, after, owner))
    owners = [p[2] for p in pieces]
    columns = [pa.array([p[k] for p in pieces], pa.int64()) for k in (0, 1)]
    columns += [pa.array([c[i] for i in owners], pa.int64()) for c in (start, end)]
    columns.append(pa.array([name[i] for i in owners], pa.string()))
    group = [pa.array([table.column(k)[0].as_py()] * len(pieces), table.schema.field(k).type) for k in keys]
    return pa.table([*group, *columns], names=[*keys, "_from", "_to", "_start", "_end", "file_name"])


def _swept(ranges: DataFrame, key: str) -> DataFrame:
    return ranges.groupBy(STREAM, key).applyInArrow(lambda table: sweep(table, STREAM, key), f"{STREAM} string, {key} bigint, {PIECE}")


def _cut(ranges: DataFrame, key: str, bits: int, only_ends: bool) -> DataFrame:
    """The parts of ranges (_low, _high) in groups of 2**bits; with only_ends, in the first and last group of each alone."""
    first, last = chunk_of(F.col("_low"), bits), chunk_of(F.col("_high") - 1, bits)
    groups = F.array_distinct(F.array(first, last)) if only_ends else F.sequence(first, last)
    cut = ranges.withColumn(key, F.explode(groups))
    low = F.greatest("_low", F.shiftleft(F.col(key), bits))
    return cut.withColumns({"_low": low, "_high": F.least("_high", F.shiftleft(F.col(key) + 1, bits))})


def _pieces(ranges: DataFrame, bits: int) -> DataFrame:
    """Disjoint (stream, chunk, start, end, file_name) pieces of possibly overlapping ranges.

    A range enters the sweeps of its first and its last chunk. The chunks between, which it covers whole, stay one
    range over chunk numbers; those ranges are swept by themselves, and give each chunk the one owner that covers it.
    So the rows are two for each range and one for each chunk, however many files span a stream.
    """
    ranges = ranges.withColumns({"_low": F.col("_start"), "_high": F.col("_end")})
    ends = _cut(ranges, "_chunk", bits, only_ends=True)
    whole = ranges.withColumns({"_low": chunk_of(F.col("_start"), bits) + 1, "_high": chunk_of(F.col("_end") - 1, bits)})
    covers = _swept(_cut(whole.where(F.col("_low") < F.col("_high")), "_span", SPAN_BITS, only_ends=False), "_span")
    covers = covers.withColumn("_chunk", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1))).select(
        STREAM, "_chunk", "_start", "_end", "file_name",
        F.shiftleft("_chunk", bits).alias("_low"), F.shiftleft(F.col("_chunk") + 1, bits).alias("_high"),
    )
    touched = ends.select(STREAM, "_chunk").distinct()
    swept = ends.unionByName(covers.join(touched, [STREAM, "_chunk"], "left_semi"))
    alone = covers.join(touched, [STREAM, "_chunk"], "left_anti")
    return (
        _swept(swept, "_chunk")
        .select(STREAM, "_chunk", F.col("_from").alias("_start"), F.col("_to").alias("_end"), "file_name")
        .unionByName(alone.select(STREAM, "_chunk", F.col("_low").alias("_start"), F.col("_high").alias("_end"), "file_name"))
    )


def attach_file(
    events: DataFrame,
    infos: DataFrame,
    bits: int = CHUNK_BITS,
    broadcast_ranges: int = BROADCAST_RANGES,
) -> DataFrame:
    """Add file_name to events from position ranges; null where no range holds the event.

    Where ranges overlap, the one that starts last holds the event, of several the one that ends first,
    then the first name. Ranges are cut to disjoint pieces within chunks by that rule. Few pieces are
    broadcast, so the lookup is a hash join. Otherwise events and the pieces' starts meet in (stream,
    chunk) groups and each event takes the last start at or before it: one shuffle, at most 2**bits
    events per group. Both ways give the same names.
    """
    ranges = infos.select(
        STREAM,
        "file_name",
        F.col("log_event_idx_start").alias("_start"),
        F.col("log_event_idx_end").alias("_end"),
    ).where(F.col("_end") > F.col("_start"))
    ranges = settle(ranges, "file-ranges")
    cut = settle(_pieces(ranges, bits), "file-pieces")
    located = events.withColumn("_chunk", chunk_of(F.col(IDX), bits))
    if small_enough(cut, broadcast_ranges):
        e, r = located.alias("e"), F.broadcast(cut).alias("r")
        inside = (
            (F.col(f"e.{STREAM}") == F.col(f"r.{STREAM}"))
            & (F.col("e._chunk") == F.col("r._chunk"))
            & (F.col(f"e.{IDX}") >= F.col("r._start"))
            & (F.col(f"e.{IDX}") < F.col("r._end"))
        )
        return e.join(r, inside, "left").select("e.*", "r.file_name").drop("_chunk")
    starts = cut.select(
        STREAM,
        "_chunk",
        F.col("_start").alias(IDX),
        F.struct("_end", "file_name").alias("_range"),
        F.lit(0).alias("_is_event"),
    )
    merged = located.withColumn("_is_event", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    up_to = (
        Window.partitionBy(STREAM, "_chunk")
        .orderBy(IDX, "_is_event")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        merged.withColumn("_range", F.last("_range", ignorenulls=True).over(up_to))
        .where(F.col("_is_event") == 1)
        .withColumn("file_name", F.when(F.col(IDX) < F.col("_range._end"), F.col("_range.file_name")))
        .drop("_range", "_chunk", "_is_event")
    )
