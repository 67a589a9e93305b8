"""Pages of events by position, rendered only after the page is cut."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import render_structured, render_unstructured
from eventloom.operators.bitmaps import offsets, unpack
from eventloom.operators.chunks import CHUNK_BITS, chunk_of
from eventloom.operators.filters import match_offsets, number_hits
from eventloom.operators.indexing import event_number
from eventloom.schema import IDX, LEVEL, LOGTYPE, OFFSET, STREAM, STRUCTURED, TS, VARS
from eventloom.session import settle

PAGE_CHUNKS = 10_000
PAGE_RANGES = 64  # index ranges that a scan condition names one by one


def within(ranges: list[tuple[str, int, int]]) -> Column:
    """A scan condition for (stream, low, high), ends included; too many are taken as one range."""
    if len(ranges) > PAGE_RANGES:
        return F.col(IDX).between(min(low for _, low, _ in ranges), max(high for _, _, high in ranges))
    tests = [(F.col(STREAM) == stream) & F.col(IDX).between(low, high) for stream, low, high in ranges]
    return functools.reduce(operator.or_, tests)


def decode(events: DataFrame, stream_type: str = STRUCTURED) -> DataFrame:
    """Events as result rows: number, level, rendered message (valid UTF-8), timestamp, offset."""
    if stream_type == STRUCTURED:
        message = render_structured()
    else:
        message = render_unstructured(F.col(LOGTYPE), F.col(VARS))
    return events.select(
        STREAM,
        event_number(F.col(IDX)).alias("log_event_num"),
        LEVEL,
        F.make_valid_utf8(message).alias("message"),
        TS,
        OFFSET,
    )


def page(
    events: DataFrame,
    begin: int,
    end: int,
    stream_type: str = STRUCTURED,
    strict: bool = False,
) -> DataFrame:
    """Events [begin, end) of each stream. A stream without that many events has no page at all.

    Positions are dense, so a page exists exactly where the event at end - 1 does: the check is one
    more index range for the scan, not a count of the table. strict=True raises if any stream, or
    the only one, has no such page.
    """
    if begin < 0 or begin > end:
        if strict:
            raise ValueError(f"invalid event range [{begin}, {end})")
        return decode(events.where(F.lit(False)), stream_type)
    if end == 0:
        return decode(events.where(F.lit(False)), stream_type)
    reach = events.where(F.col(IDX) == end - 1).select(STREAM)
    if strict:
        lacking = events.where(F.col(IDX) == 0).select(STREAM).join(reach, STREAM, "left_anti")
        if not reach.limit(1).count() or lacking.limit(1).count():
            raise ValueError(f"event range [{begin}, {end}) exceeds a stream")
    rows = events.where((F.col(IDX) >= begin) & (F.col(IDX) < end)).join(reach, STREAM, "left_semi")
    return decode(rows, stream_type).orderBy(STREAM, "log_event_num")


def page_filtered(
    events: DataFrame,
    condition: Column | None,
    begin: int,
    end: int,
    stream_type: str = STRUCTURED,
    strict: bool = False,
    bits: int = CHUNK_BITS,
    counted: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Matches [begin, end) of each stream's filtered list, with their whole-stream numbers.

    `counted` is what match_offsets gave for this filter and `bits`, kept from an earlier page.

    No page where the filter is not active (see filter_summary) or the list is too short. The first
    pass counts matches per chunk of positions, reading only what the condition needs; the page's keys
    are then numbered in the few chunks it falls into. Whole events are read last, for those keys
    only, by an index range the scan can skip with, and are not shuffled unless the page is huge.
    """
    empty = decode(events.where(F.lit(False)), stream_type)
    if condition is None or begin < 0 or begin > end:
        if strict:
            raise ValueError("no active filter" if condition is None else f"invalid range [{begin}, {end})")
        return empty
    before, totals = counted or match_offsets(events, condition, stream_type, bits)
    long_enough = totals.where(F.col("_matches") >= end)
    if strict:
        lacking = events.where(F.col(IDX) == 0).select(STREAM).join(long_enough, STREAM, "left_anti")
        if lacking.limit(1).count():
            raise ValueError(f"no filtered page [{begin}, {end}): filter not active or list too short")
    wanted = (
        before.where((F.col("_before") < end) & (F.col("_before") + F.col("_n") > begin))
        .join(long_enough, STREAM, "left_semi")
        .select(STREAM, "_chunk", "_before")
    )
    # The page's chunks, at most one per event asked for and stream, fetched if they are few.
    found = wanted.limit(PAGE_CHUNKS + 1).collect()
    if not found:
        return empty
    hits = events.where(condition).select(STREAM, IDX)
    if len(found) <= PAGE_CHUNKS:
        wanted = F.broadcast(events.sparkSession.createDataFrame(found, wanted.schema))
        hits = hits.where(
            within([(r[STREAM], r["_chunk"] << bits, ((r["_chunk"] + 1) << bits) - 1) for r in found])
        )
    hits = hits.withColumn("_chunk", chunk_of(F.col(IDX), bits)).join(
        wanted.select(STREAM, "_chunk"), [STREAM, "_chunk"], "left_semi"
    )
    inside = (F.col("filtered_idx") >= begin) & (F.col("filtered_idx") < end)
    return events_at(events, number_hits(hits, wanted).where(inside), stream_type)


def page_kept(
    events: DataFrame,
    bitmaps: DataFrame,
    begin: int,
    end: int,
    stream_type: str = STRUCTURED,
    strict: bool = False,
    counted: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """page_filtered for a filter kept as bitmaps: its predicate is not evaluated again.

    Only the bitmaps of the chunks that hold the page are unpacked; of the events only the page is read.
    """
    if begin < 0 or begin > end:
        if strict:
            raise ValueError(f"invalid range [{begin}, {end})")
        return decode(events.where(F.lit(False)), stream_type)
    before, totals = counted or offsets(bitmaps, stream_type)
    long_enough = totals.where(F.col("_matches") >= end)
    if strict and bitmaps.select(STREAM).distinct().join(long_enough, STREAM, "left_anti").limit(1).count():
        raise ValueError(f"no filtered page [{begin}, {end}): filter not active or list too short")
    wanted = before.where((F.col("_before") < end) & (F.col("_before") + F.col("_n") > begin))
    keys = unpack(bitmaps, wanted.join(long_enough, STREAM, "left_semi"))
    return events_at(events, keys.where((F.col("filtered_idx") >= begin) & (F.col("filtered_idx") < end)), stream_type)


def events_at(events: DataFrame, keys: DataFrame, stream_type: str = STRUCTURED) -> DataFrame:
    """The decoded events at (stream_id, log_event_idx), in order, read by index ranges that the scan can skip with."""
    empty = decode(events.where(F.lit(False)), stream_type)
    keys = settle(keys.select(STREAM, IDX), "page-keys")
    ends = [F.min(IDX).alias("low"), F.max(IDX).alias("high")]
    spans = keys.groupBy(STREAM).agg(*ends).limit(PAGE_RANGES + 1).collect()
    if not spans:
        return empty
    if len(spans) > PAGE_RANGES:
        whole = keys.agg(*ends).first()
        rows = events.where(F.col(IDX).between(whole["low"], whole["high"]))
    else:
        rows = events.where(within([(r[STREAM], r["low"], r["high"]) for r in spans]))
    # The keys' size is known from their files, so Spark itself decides whether to broadcast them.
    rows = rows.join(keys, [STREAM, IDX], "left_semi")
    return decode(rows, stream_type).orderBy(STREAM, "log_event_num")
