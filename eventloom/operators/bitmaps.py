"""Filters kept as bitmaps: one bit per event, so that a filter is evaluated once and combined without the events.

A row is one (stream, chunk of 2**15 positions): how many events the chunk has, how many match, and 4 KiB of bits (null
where nothing matches; parquet compresses sparse ones). A filter over 10**12 events is 3 * 10**7 rows at most. Bits are
unpacked in position order inside a row, so the place of a match in its chunk needs neither a window nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.chunks import carry_before, chunk_of
from eventloom.operators.filters import active_totals
from eventloom.schema import IDX, STREAM, STRUCTURED
from eventloom.session import settle

BITS = 15  # what Spark's bitmap aggregates hold: 2**15 positions
BYTES = 1 << (BITS - 3)


def match_bitmaps(events: DataFrame, condition: Column) -> DataFrame:
    """(stream_id, _chunk, _all, _n, _bits): one scan of the key columns and of what the condition reads.

    Positions must be unique in their stream, as in every event table. A condition that is null does not match.
    """
    place = F.when(condition, F.col(IDX).bitwiseAND((1 << BITS) - 1))
    bitmaps = events.groupBy(STREAM, chunk_of(F.col(IDX), BITS).alias("_chunk")).agg(
        F.count("*").alias("_all"), F.count(place).alias("_n"), F.bitmap_construct_agg(place).alias("_bits")
    )
    return settle(bitmaps.withColumn("_bits", F.when(F.col("_n") > 0, F.col("_bits"))), "match-bitmaps")


def both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bitmaps of the events that match two filters of the same table; no event is read."""
    met = left.unionByName(right).groupBy(STREAM, "_chunk").agg(
        F.max("_all").alias("_all"), F.when(F.count("_bits") == 2, F.bitmap_and_agg("_bits")).alias("_bits")
    )
    return settle(_counted(met), "match-bitmaps")


def either(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bitmaps of the events that match at least one of two filters of the same table."""
    met = left.unionByName(right).groupBy(STREAM, "_chunk").agg(
        F.max("_all").alias("_all"), F.when(F.count("_bits") > 0, F.bitmap_or_agg("_bits")).alias("_bits")
    )
    return settle(_counted(met), "match-bitmaps")


def _counted(bitmaps: DataFrame) -> DataFrame:
    n = F.coalesce(F.bitmap_count("_bits"), F.lit(0)).cast("bigint")
    return bitmaps.select(STREAM, "_chunk", "_all", n.alias("_n"), F.when(n > 0, F.col("_bits")).alias("_bits"))


def offsets(bitmaps: DataFrame, stream_type: str = STRUCTURED) -> tuple[DataFrame, DataFrame]:
    """What filters.match_offsets gives, from the kept counts, in chunks of 2**15 positions."""
    counts = bitmaps.select(STREAM, "_chunk", "_n", "_all")
    before = carry_before(counts, [STREAM], "_chunk", "_n", "sum", "_before")
    return before.where(F.col("_n") > 0), active_totals(counts, stream_type)


def _places() -> Column:
    """The set bits of a row as sorted places, bytes without any left out."""
    at = lambda i: F.instr(F.lit("0123456789ABCDEF"), F.substring("_hex", i, F.lit(1))) - 1
    byte = lambda i: at(2 * i + 1) * 16 + at(2 * i + 2)
    bytes_set = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(BYTES - 1)), lambda i: F.struct(i.alias("i"), byte(i).alias("v"))),
        lambda b: b["v"] != 0,
    )
    bits = F.array(*[F.lit(k) for k in range(8)])
    return F.flatten(
        F.transform(
            bytes_set,
            lambda b: F.transform(
                F.filter(bits, lambda k: F.getbit(b["v"].cast("bigint"), k) == 1), lambda k: b["i"] * 8 + k
            ),
        )
    )


def unpack(bitmaps: DataFrame, before: DataFrame) -> DataFrame:
    """(stream_id, filtered_idx, log_event_idx) of the matches in the chunks that `before` names."""
    rows = bitmaps.where(F.col("_n") > 0).select(STREAM, "_chunk", F.hex("_bits").alias("_hex"))
    return (
        rows.join(before.select(STREAM, "_chunk", "_before"), [STREAM, "_chunk"])
        .select(STREAM, "_chunk", "_before", F.posexplode(_places()).alias("_k", "_place"))
        .select(
            STREAM,
            (F.col("_before") + F.col("_k")).alias("filtered_idx"),
            (F.shiftleft("_chunk", BITS) + F.col("_place")).alias(IDX),
        )
    )


def kept_index_map(bitmaps: DataFrame, stream_type: str = STRUCTURED) -> DataFrame:
    """filters.filtered_index_map from kept bitmaps: no event is read and no match is sorted."""
    before, totals = offsets(bitmaps, stream_type)
    return unpack(bitmaps, before.join(totals, STREAM, "left_semi"))
