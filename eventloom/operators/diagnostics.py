"""Checks on loaded events: order, offset changes, missing keys, malformed values, key census."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.keypaths import string_at, type_at
from eventloom.functions.levels import level_from_name
from eventloom.operators.chunks import CHUNK_BITS, carry_before, chunk_of
from eventloom.schema import AUTO, IDX, OFFSET, STREAM, TS, USER, ReaderOptions
from eventloom.session import settle


def _chunk_tails(events: DataFrame, value: str, bits: int) -> DataFrame:
    """Per chunk: its number of events and its last event's value."""
    tails = events.groupBy(STREAM, chunk_of(F.col(IDX), bits).alias("_chunk")).agg(
        F.count("*").alias("_n"), F.max_by(value, IDX).alias("_tail")
    )
    return settle(tails, "chunk-tails")


def _steps(
    events: DataFrame,
    value: str,
    reports: Callable[[Column, Column], Column],
    tails: DataFrame,
    bits: int,
) -> DataFrame:
    """Events whose (previous, own) value pair is reported, with the previous value in "_prev".

    Neighbours are compared inside chunks; only a chunk's first event needs the value carried over
    from the chunk before it.
    """
    narrow = events.select(STREAM, IDX, value, chunk_of(F.col(IDX), bits).alias("_chunk"))
    order = Window.partitionBy(STREAM, "_chunk").orderBy(IDX)
    seen = narrow.withColumn("_prev", F.lag(value).over(order))
    before = carry_before(tails, [STREAM], "_chunk", "_tail", "last", "_before").drop("_tail", "_n")
    own = F.col(value)
    return (
        seen.where(F.col("_prev").isNull() | reports(F.col("_prev"), own))
        .join(before, [STREAM, "_chunk"])
        .withColumn("_prev", F.coalesce("_prev", "_before"))
        .where(reports(F.col("_prev"), own))
        .select(STREAM, IDX, value, "_prev")
    )


def offset_changes(events: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """Events whose UTC offset differs from the one before them in their stream."""
    tails = _chunk_tails(events, OFFSET, bits)
    changed = _steps(events, OFFSET, lambda prev, own: prev != own, tails, bits)
    return changed.withColumnRenamed("_prev", "previous_utc_offset")


def chronology_check(events: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """Per stream: how many events are earlier than their predecessor, and the first such index."""
    tails = _chunk_tails(events, TS, bits)
    backward = _steps(events, TS, lambda prev, own: own < prev, tails, bits)
    found = backward.groupBy(STREAM).agg(
        F.count("*").alias("n_inversions"), F.min(IDX).alias("first_bad_idx")
    )
    return (
        tails.groupBy(STREAM)
        .agg(F.sum("_n").alias("n_events"))
        .join(found, STREAM, "left")
        .select(
            STREAM,
            "n_events",
            F.coalesce("n_inversions", F.lit(0)).alias("n_inversions"),
            "first_bad_idx",
            F.col("n_inversions").isNull().alias("is_chronological"),
        )
    )


def missing_keys(events: DataFrame, options: ReaderOptions) -> DataFrame:
    """(stream, option, namespace, key path) where no event of the stream has that key and type."""
    named = options.items()
    if not named:
        no_text = [F.lit("").alias(c) for c in ("option", "namespace", "key_path")]
        return events.select(STREAM, *no_text).where(F.lit(False))
    seen = [
        F.bool_or(F.coalesce(type_at(path) == kind, F.lit(False))).alias(f"_{name}")
        for name, path, kind in named
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("option"),
                F.lit(path.namespace).alias("namespace"),
                F.lit("/".join(path.parts)).alias("key_path"),
                F.col(f"_{name}").alias("found"),
            )
            for name, path, _ in named
        ]
    )
    return (
        events.groupBy(STREAM)
        .agg(*seen)
        .select(STREAM, F.inline(rows))
        .where(~F.col("found"))
        .drop("found")
    )


def protocol_errors(events: DataFrame, options: ReaderOptions) -> DataFrame:
    """(stream, option, reason, n_events) for values that are present but unusable.

    Reasons: 'empty' (JSON null), 'wrong_type', and for the level 'unknown_name'. Absent is no error.
    """
    counts, rows = [], []
    for name, path, kind in options.items():
        found = type_at(path)
        reasons = {
            "empty": found == "VOID",
            "wrong_type": ~found.isin("VOID", kind),
        }
        if name == "log_level":
            text = string_at(path)
            reasons["unknown_name"] = text.isNotNull() & (level_from_name(text) == 0)
        for reason, test in reasons.items():
            column = f"_{name}_{reason}"
            counts.append(F.count_if(test).alias(column))
            rows.append(
                F.struct(
                    F.lit(name).alias("option"),
                    F.lit(reason).alias("reason"),
                    F.col(column).alias("n_events"),
                )
            )
    if not rows:
        no_text = [F.lit("").alias(c) for c in ("option", "reason")]
        no_count = F.lit(0).cast("bigint").alias("n_events")
        return events.select(STREAM, *no_text, no_count).where(F.lit(False))
    return (
        events.groupBy(STREAM)
        .agg(*counts)
        .select(STREAM, F.inline(F.array(*rows)))
        .where(F.col("n_events") > 0)
    )


def _kind(value: Column) -> Column:
    """Type of a VARIANT without its parameters: DECIMAL(3,1) -> DECIMAL, OBJECT<...> -> OBJECT."""
    return F.regexp_extract(F.schema_of_variant(value), r"\A[A-Z]+", 0)


LEVELS = 4


def _open_levels(events: DataFrame, levels: int) -> DataFrame:
    """(namespace, path, type, more, n_events): leaves found by opening objects `levels` deep, in one scan of the events.

    `more` marks objects at the last level that are not empty, and so no leaves yet.
    """
    spaces = F.array(
        *[F.struct(F.lit(ns).alias("namespace"), F.col(c).alias("v")) for ns, c in (("auto", AUTO), ("user", USER))]
    )
    nodes = (
        events.select(F.inline(spaces)).where("v is not null").withColumn("path", F.array().cast("array<string>"))
    )
    as_map = lambda: F.col("v").try_cast("map<string,variant>")
    for _ in range(levels):
        # Leaves pass through: only objects open, and an empty object has nothing to open.
        opened = nodes.select("namespace", "path", "v", F.explode_outer(as_map()).alias("_key", "_child"))
        is_leaf = F.col("_key").isNull()
        nodes = opened.select(
            "namespace",
            F.when(is_leaf, F.col("path")).otherwise(F.concat("path", F.array("_key"))).alias("path"),
            F.when(is_leaf, F.col("v")).otherwise(F.col("_child")).alias("v"),
        )
    return (
        nodes.where(F.size("path") > 0)
        .groupBy("namespace", "path", _kind(F.col("v")).alias("type"), F.coalesce(F.size(as_map()) > 0, F.lit(False)).alias("more"))
        .agg(F.count("*").alias("n_events"))
    )


def schema_census(events: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(namespace, path, type, n_events): every leaf key of the events and how often it occurs.

    A path seen with two types is two leaves. Leaves are counted where they are read: what is shuffled is one row
    per leaf and task. Objects are opened `levels` deep in one scan; only where deeper ones are found, the census is
    taken again with twice as many.
    """
    while True:
        census = settle(_open_levels(events, levels), "leaf-counts")
        if not census.where("more").limit(1).count():
            return census.drop("more")
        levels *= 2
