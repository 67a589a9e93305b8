"""Filters by level and by key-value predicate, and the map of positions they leave."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.chunks import CHUNK_BITS, carry_before, chunk_of
from eventloom.schema import IDX, LEVEL, STREAM, STRUCTURED, UNSTRUCTURED
from eventloom.session import settle


def filter_condition(
    levels: Iterable[int] | None = None,
    predicate: Column | None = None,
    stream_type: str = STRUCTURED,
) -> Column | None:
    """Both filters as one condition; None when there is nothing to filter by.

    No levels (None) means no level filter, an empty list keeps nothing. Unstructured events have no
    key-value pairs: a predicate on them is ignored with a warning.
    """
    if predicate is not None and stream_type == UNSTRUCTURED:
        warnings.warn("key-value predicates do not apply to unstructured streams; ignored", stacklevel=2)
        predicate = None
    condition = None
    if levels is not None:
        condition = F.col(LEVEL).isin(sorted(set(levels)))
    if predicate is not None:
        condition = predicate if condition is None else condition & predicate
    return condition


def filter_events(
    events: DataFrame,
    levels: Iterable[int] | None = None,
    predicate: Column | None = None,
    stream_type: str = STRUCTURED,
) -> DataFrame:
    condition = filter_condition(levels, predicate, stream_type)
    return events if condition is None else events.where(condition)


def filter_summary(
    events: DataFrame, condition: Column | None, stream_type: str = STRUCTURED
) -> DataFrame:
    """Per stream: events, matches, and whether the filter counts as active.

    A structured stream's filter that keeps every event is no filter at all; an unstructured
    stream's stays active.
    """
    matches = F.count("*") if condition is None else F.count_if(condition)
    counted = events.groupBy(STREAM).agg(
        F.count("*").alias("n_events"), matches.alias("n_matches")
    )
    if condition is None:
        active = F.lit(False)
    elif stream_type == STRUCTURED:
        active = F.col("n_matches") != F.col("n_events")
    else:
        active = F.lit(True)
    return counted.withColumn("is_active", active)


def match_offsets(
    events: DataFrame, condition: Column, stream_type: str = STRUCTURED, bits: int = CHUNK_BITS
) -> tuple[DataFrame, DataFrame]:
    """(matches before each chunk of positions, totals of the streams whose filter is active).

    One scan of the key columns and what the condition reads, combined to one row per chunk.
    """
    counts = settle(
        events.groupBy(STREAM, chunk_of(F.col(IDX), bits).alias("_chunk")).agg(
            F.count_if(condition).alias("_n"), F.count("*").alias("_all")
        ),
        "match-counts",
    )
    before = carry_before(counts, [STREAM], "_chunk", "_n", "sum", "_before")
    return before.where(F.col("_n") > 0), active_totals(counts, stream_type)


def active_totals(counts: DataFrame, stream_type: str = STRUCTURED) -> DataFrame:
    """Matches and events of the streams whose filter is active, from counts per chunk."""
    totals = counts.groupBy(STREAM).agg(
        F.sum("_n").alias("_matches"), F.sum("_all").alias("_events")
    )
    if stream_type == STRUCTURED:
        totals = totals.where(F.col("_matches") != F.col("_events"))
    return totals


def filtered_index_map(
    events: DataFrame,
    condition: Column,
    stream_type: str = STRUCTURED,
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """(stream_id, filtered_idx, log_event_idx): the n-th match of a stream -> its whole-stream index.

    A stream whose filter is not active has no map; filter_summary tells it from an empty one. Only
    the key columns of matching events are shuffled.
    """
    before, totals = match_offsets(events, condition, stream_type, bits)
    return index_map(events, condition, before, totals, bits)


def index_map(
    events: DataFrame, condition: Column, before: DataFrame, totals: DataFrame, bits: int = CHUNK_BITS
) -> DataFrame:
    """The map, from what match_offsets has already counted."""
    hits = events.where(condition).select(STREAM, IDX, chunk_of(F.col(IDX), bits).alias("_chunk"))
    return number_hits(hits, before.join(totals, STREAM, "left_semi")).select(
        STREAM, "filtered_idx", IDX
    )


def number_hits(hits: DataFrame, before: DataFrame) -> DataFrame:
    """Add filtered_idx to matching events, given the number of matches before each chunk."""
    within = Window.partitionBy(STREAM, "_chunk").orderBy(IDX)
    return (
        hits.withColumn("_place", F.row_number().over(within))
        .join(before.select(STREAM, "_chunk", "_before"), [STREAM, "_chunk"])
        .withColumn("filtered_idx", F.col("_before") + F.col("_place") - 1)
        .drop("_place", "_before", "_chunk")
    )
