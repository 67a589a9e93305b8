"""Ordered work on long streams without ever putting a whole stream into one task.

A position (event index, or time in ms) is cut into aligned chunks of 2**bits. Rows are grouped by
(stream, chunk), so a stream holding a third of the table still spreads over as many tasks as it has
chunks, and a chunk of unique positions can hold at most 2**bits rows. What a chunk needs to know
about the ones before it comes from a summary of one row per chunk, see carry_before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 18
SPAN_BITS = 10
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def chunk_of(position: Column, bits: int = CHUNK_BITS) -> Column:
    return F.shiftright(position, bits)


def carry_before(
    summary: DataFrame,
    keys: Sequence[str],
    chunk: str,
    value: str,
    how: str,
    name: str,
    *,
    span_bits: int = SPAN_BITS,
    flat_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add to each row of a per-chunk summary the sum, or the last non-null value, of all earlier ones.

    A summary counted to be small takes one window per key. A longer one takes two levels: inside
    spans of 2**span_bits chunks, and over one row per span, so that neither window sees more than a
    small part of a long stream's summary. `flat_rows` is the line between them.
    """
    keys = list(keys)
    if small_enough(summary, flat_rows):
        earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
        if how == "sum":
            return summary.withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        return summary.withColumn(name, F.last(value, ignorenulls=True).over(earlier))
    spanned = summary.withColumn("_span", F.shiftright(F.col(chunk), span_bits))
    inside = Window.partitionBy(*keys, "_span").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    if how == "sum":
        per_span = spanned.groupBy(*keys, "_span").agg(F.sum(value).alias("_v"))
        here, earlier = F.sum(value).over(inside), F.sum("_v").over(across)
        total = F.coalesce(F.col("_inside"), F.lit(0)) + F.coalesce(F.col("_across"), F.lit(0))
    else:
        per_span = spanned.where(F.col(value).isNotNull()).groupBy(*keys, "_span").agg(
            F.max_by(value, chunk).alias("_v")
        )
        # Spans without any value still need the one carried over them.
        per_span = spanned.select(*keys, "_span").distinct().join(per_span, [*keys, "_span"], "left")
        here = F.last(value, ignorenulls=True).over(inside)
        earlier = F.last("_v", ignorenulls=True).over(across)
        total = F.coalesce(F.col("_inside"), F.col("_across"))
    spans = per_span.select(*keys, "_span", earlier.alias("_across"))
    return (
        spanned.withColumn("_inside", here)
        .join(spans, [*keys, "_span"])
        .withColumn(name, total)
        .drop("_span", "_inside", "_across")
    )


def required(key: Column, what: str) -> Column:
    """A key that joins rely on; a null one is an error rather than a lost row."""
    return F.when(key.isNotNull(), key).otherwise(F.raise_error(F.lit(f"{what} is null")))


def small_enough(frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame is proven small, in rows and in bytes of text; looks at max_rows + 1 rows."""
    text = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in frame.dtypes if kind == "string"]
    size = F.sum(sum(text, F.lit(0)))
    seen = frame.limit(max_rows + 1).agg(F.count("*").alias("rows"), size.alias("bytes")).first()
    return seen["rows"] <= max_rows and (seen["bytes"] or 0) <= BROADCAST_BYTES


def broadcast_if_small(frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint behind a size check; beyond it the join stays a shuffle join."""
    return F.broadcast(frame) if small_enough(frame, max_rows) else frame
