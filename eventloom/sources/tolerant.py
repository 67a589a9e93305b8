"""Loads that survive a cut-off last record and refuse broken ones elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.chunks import CHUNK_BITS, carry_before, chunk_of
from eventloom.schema import IDX, STREAM
from eventloom.session import settle


class CorruptStreamError(ValueError):
    """A record that is not the last of its stream cannot be read."""


def load_report(records: DataFrame, broken: Column) -> DataFrame:
    """Per stream: records, readable events, whether the tail is cut off, broken records elsewhere.

    Three aggregates combined before the shuffle; the records themselves are not moved.
    """
    found = records.groupBy(STREAM).agg(
        F.count("*").alias("n_records"),
        F.count_if(broken).alias("_broken"),
        F.max(IDX).alias("_last"),
        F.max(F.when(broken, F.col(IDX))).alias("_last_broken"),
    )
    cut_off = F.coalesce(F.col("_last_broken") == F.col("_last"), F.lit(False))
    return found.select(
        STREAM,
        "n_records",
        (F.col("n_records") - F.col("_broken")).alias("n_events"),
        cut_off.alias("is_incomplete"),
        (F.col("_broken") - cut_off.cast("bigint")).alias("n_corrupt"),
    )


def split_broken(records: DataFrame, broken: Column, strict: bool = True) -> DataFrame:
    """The readable records. strict=True raises if a stream is broken anywhere but at its end.

    With strict=False the broken ones are left out and load_report tells where.
    """
    broken = F.coalesce(broken, F.lit(False))
    if strict:
        bad = load_report(records, broken).where(F.col("n_corrupt") > 0).limit(1).collect()
        if bad:
            raise CorruptStreamError(f"stream {bad[0][STREAM]!r}: {bad[0]['n_corrupt']} broken records")
    return records.where(~broken)


def load_tolerant(records: DataFrame, broken: Column, bits: int = CHUNK_BITS) -> tuple[DataFrame, DataFrame]:
    """(events, errors): the readable records at dense positions, and one row per broken record.

    Events keep their place in the input as record_idx and are numbered anew without gaps, as pages
    need it. Errors are (stream_id, record_idx, problem): "incomplete" for a stream's last record,
    "corrupt" for any other. Only chunks of positions that hold broken records are shuffled; all
    other records move by a number that the counts per chunk tell.
    """
    marked = records.withColumns(
        {"_chunk": chunk_of(F.col(IDX), bits), "_broken": F.coalesce(broken, F.lit(False)), "record_idx": F.col(IDX)}
    )
    counts = settle(
        marked.groupBy(STREAM, "_chunk").agg(F.count_if("_broken").alias("_n"), F.max(IDX).alias("_last")),
        "broken-counts",
    )
    before = settle(carry_before(counts, [STREAM], "_chunk", "_n", "sum", "_before").drop("_last"), "broken-before")
    placed = marked.join(before, [STREAM, "_chunk"])
    earlier = Window.partitionBy(STREAM, "_chunk").orderBy(IDX)
    whole = placed.where("_n = 0").withColumn("_inside", F.lit(0).cast("bigint"))
    mended = placed.where("_n > 0").withColumn("_inside", F.count_if("_broken").over(earlier)).where("not _broken")
    names = [c for c in dict.fromkeys([*records.columns, "record_idx"]) if c != IDX]
    events = whole.unionByName(mended).select((F.col(IDX) - F.col("_before") - F.col("_inside")).alias(IDX), *names)
    ends = counts.groupBy(STREAM).agg(F.max("_last").alias("_last"))
    problem = F.when(F.col(IDX) == F.col("_last"), "incomplete").otherwise("corrupt")
    errors = marked.where("_broken").join(ends, STREAM).select(STREAM, "record_idx", problem.alias("problem"))
    return events, errors


def broken_json(text: Column) -> Column:
    """A record that has text which is not JSON."""
    return text.isNotNull() & F.try_parse_json(text).isNull()
